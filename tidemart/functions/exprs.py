"""Column expressions with the aggregate and scalar semantics the marts need.

All are plain ``pyspark.sql.functions`` compositions, so they stay inside
whole-stage codegen and take part in partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.schemas import D184


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- aggregates -------------------------------------------------------------

def count_rows() -> Column:
    """``count()``: joined rows, as a long."""
    return F.count(F.lit(1))


def count_if(cond: Column) -> Column:
    """``countIf(cond)``; 0 when never true."""
    return F.count_if(cond)


def sum_or_zero(x, dtype: T.DataType | None = None) -> Column:
    """``sum(x)`` that gives 0 (not NULL) on an empty or all-NULL input."""
    s = F.sum(_c(x))
    zero = F.lit(0) if dtype is None else F.lit(0).cast(dtype)
    return F.coalesce(s, zero)


def sum_if(x, cond: Column, dtype: T.DataType | None = None) -> Column:
    """``sumIf(x, cond)``: 0 when cond is never true."""
    return sum_or_zero(F.when(cond, _c(x)), dtype)


def avg_if(x, cond: Column) -> Column:
    """``avgIf(x, cond)``; NULL when no row qualifies (the reference gives NaN)."""
    return F.avg(F.when(cond, _c(x)))


def rate_if(cond: Column) -> Column:
    """``avg(if(cond, 1, 0))``."""
    return F.avg(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def uniq(x) -> Column:
    """``uniq(x)``: exact distinct count (the reference's is approximate)."""
    return F.count_distinct(_c(x))


def uniq_approx(x, rsd: float = 0.01) -> Column:
    """HyperLogLog++ distinct count for very large groups."""
    return F.approx_count_distinct(_c(x), rsd)


def top1(x) -> Column:
    """``topK(1)(x)[1]``: most frequent value; ties go to the smallest value.

    ``mode`` keeps one counter per distinct value of the group (bounded by the
    column's cardinality, not by the row count) and merges partial maps.
    """
    return F.mode(_c(x), deterministic=True)


def top1_approx(x, name: str | None = None) -> Column:
    """``topK(1)(x)[1]`` with a bounded-memory sketch (``approx_top_k``), for
    columns whose cardinality per group is too large for an exact ``mode``."""
    col = x if isinstance(x, str) else name
    if col is None:
        raise ValueError("top1_approx needs a column name")
    return F.expr(f"approx_top_k(`{col}`, 1)")[0]["item"]


INT38 = T.DecimalType(38, 0)


def shifted(x: Column, places: int) -> Column:
    """A decimal with at most ``places`` fraction digits as the integer x * 10^places."""
    return F.try_multiply(x, F.lit(10 ** places).cast(T.DecimalType(places + 1, 0))).cast(INT38)


def dec_div(num, den, scale: int = 4) -> Column:
    """``num / den`` for a decimal ``num`` (4 fraction digits at most) and a
    non-negative integer ``den`` of any size, rounded half-up once to
    ``Decimal(18, 4)``; NULL for ``den`` 0.

    Integer arithmetic on up to 38 digits, (2 |n| + d) div 2 d, so nothing is
    rounded on the way. A sum that leaves 38 digits gives NULL, not an error.
    """
    d = _c(den).cast(INT38)
    n = shifted(_c(num).cast(T.DecimalType(38, scale)), scale)
    q = F.call_function("div", F.try_add(F.try_multiply(F.abs(n), F.lit(2).cast(T.DecimalType(1, 0))), d),
                        F.when(d != 0, F.try_multiply(d, F.lit(2).cast(T.DecimalType(1, 0)))))
    units = F.sign(n.cast("double")).cast("long") * q
    return F.try_multiply(units.cast(T.DecimalType(19, 0)), F.lit(0.0001).cast(T.DecimalType(5, 4))).try_cast(D184)


def dec_avg(x, scale: int = 4) -> Column:
    """``avg(x)`` of a decimal column into ``Decimal(18, scale)``, half-up."""
    return dec_div(F.sum(_c(x)), F.count(_c(x)), scale)


def ratio(num: Column, den: Column) -> Column:
    """``if(den > 0, num / den, 0)`` as a double (guards ANSI division)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


# --- scalar -----------------------------------------------------------------

def day(ts) -> Column:
    """``toDate(ts)``."""
    return F.to_date(_c(ts))


def hour_boundaries(a, b) -> Column:
    """``dateDiff('hour', a, b)``: hour boundaries crossed between a and b.

    Differs from ``timestampdiff(HOUR, a, b)`` (00:59 -> 02:01 is 2, not 1).
    """
    ha = F.date_trunc("hour", _c(a))
    hb = F.date_trunc("hour", _c(b))
    return F.timestamp_diff("HOUR", ha, hb)


def yyyymm(d) -> Column:
    """``toYYYYMM(d)`` as an int."""
    return (F.year(_c(d)) * 100 + F.month(_c(d))).cast("int")


def greatest0(x) -> Column:
    """``greatest(x, 0)``."""
    return F.greatest(_c(x), F.lit(0))


# The unit words of a readable quantity, in order of magnitude.
_QUANTITY_UNITS = [
    (1e15, "quadrillion"), (1e12, "trillion"), (1e9, "billion"),
    (1e6, "million"), (1e3, "thousand"),
]


def readable_quantity(x) -> Column:
    """``formatReadableQuantity(n)`` of a count: 1660 -> '1.66 thousand'.

    Hundredths are rounded half-up in integer arithmetic (no float ties).
    """
    n = _c(x).cast("long")
    expr = F.concat(n.cast("string"), F.lit(".00"))
    for base, word in reversed(_QUANTITY_UNITS):
        b = int(base)
        hundredths = F.floor((n * F.lit(100) + F.lit(b // 2)) / F.lit(b)).cast("long")
        txt = F.concat((hundredths / 100).cast("long").cast("string"), F.lit("."),
                       F.lpad((hundredths % 100).cast("string"), 2, "0"), F.lit(" " + word))
        expr = F.when(n >= F.lit(b), txt).otherwise(expr)
    return expr


_SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]


def pretty_size(x) -> Column:
    """``pg_size_pretty(bytes)``: 10 kB steps rounded, as in the monitor script."""
    v = _c(x).cast("double")
    expr = F.concat(F.format_string("%.0f", v), F.lit(" bytes"))
    for i, unit in enumerate(_SIZE_UNITS[1:], start=1):
        base = float(1024 ** i)
        expr = F.when(F.abs(v) >= F.lit(10 * base),
                      F.concat(F.format_string("%.0f", F.round(v / F.lit(base))), F.lit(" " + unit))
                      ).otherwise(expr)
    return expr
