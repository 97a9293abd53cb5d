"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the input tables.

Results are returned in a portable form so that any consumer (pandas, Arrow,
another engine) reads identical values: Decimal columns as DOUBLE (an exact
conversion of the Decimal(18,4) value), dates as ``yyyy-MM-dd`` and timestamps
as ``yyyy-MM-dd HH:mm:ss`` strings. The typed mart tables written by
``tidemart.plans.refresh`` keep Decimal/DATE columns.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.plans import marts as M
from tidemart.plans import marts_strict as S
from tidemart.plans.landing import Landing

AS_OF = _dt.date(2001, 8, 1)          # test orders end 2001-08-01
AS_OF_EVENTS = _dt.date(2024, 1, 30)  # test events end 2024-01-30

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _mart(name: str, plan: str | None = None, strict: bool = False) -> Query:
    fn = S.STRICT_MARTS[name] if strict else M.MARTS[name]
    as_of = AS_OF_EVENTS if name == "agg_daily_engagement" else AS_OF

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        L = Landing.materialized(spark, sf_dir)
        df = fn(L, as_of, plan=plan) if plan else fn(L, as_of)
        return portable(df)

    run.__name__ = f"q_{name}" + (f"_{plan}" if plan else "") + ("_strict" if strict else "")
    return run


def mart_queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _mart(name) for name in M.MARTS}
    for name in sorted(M.FACTORISED):
        # the chained default-filling joins themselves (J1-J13): rows grow as the product of a key's
        # sides, so the factorised plan is the default and this one is its counterpart
        out[f"{name}_joins"] = _mart(name, "joins")
    for name in M.MARTS:
        out[f"{name}_strict"] = _mart(name, strict=True)
    return out


def all_queries() -> dict[str, Query]:
    from tidemart.plans import cdc_queries, stateful_queries
    q = mart_queries()
    q.update(cdc_queries.queries())
    q.update(stateful_queries.queries())
    return q


def all_oracle_sql() -> dict[str, str]:
    from tidemart.plans import cdc_queries, stateful_queries
    from tidemart.plans.oracle_sql import MART_SQL, STRICT_SQL
    out = dict(MART_SQL)
    for name in sorted(M.FACTORISED):
        out[f"{name}_joins"] = MART_SQL[name]
    for name in M.MARTS:
        out[f"{name}_strict"] = STRICT_SQL[name]
    out.update(cdc_queries.oracle_sql())
    out.update(stateful_queries.oracle_sql())
    return out
