"""tidemart: change-data landing and procurement marts on Spark.

    from tidemart import Landing, mart
    L = Landing.from_path(spark, "s3://.../landing")          # or from_fixtures
    df = mart(L, "agg_daily_buyer", as_of=date(2001, 8, 1))    # literal, factorised
    df = mart(L, "agg_daily_buyer", as_of, semantics="strict")
"""

from __future__ import annotations

import datetime as _dt

__all__ = ["Landing", "mart", "MART_NAMES"]


def __getattr__(name):
    if name == "Landing":
        from tidemart.plans.landing import Landing
        return Landing
    if name == "MART_NAMES":
        from tidemart.plans.marts import MARTS
        return list(MARTS)
    raise AttributeError(name)


def mart(L, name: str, as_of: _dt.date, semantics: str = "literal", plan: str = "factorised", **options):
    """One mart as a DataFrame.

    ``semantics="literal"`` reproduces the reference (default-filled LEFT
    JOINs, fan-out, tombstones filtered on the driving table only);
    ``plan`` picks the factorised (default) or the chained-join plan for the
    marts that fan out. ``semantics="strict"`` is the fan-out-free reading.
    ``options`` go to the mart (e.g. ``approx=True`` for the engagement mart).
    """
    from tidemart.plans import marts as M
    from tidemart.plans import marts_strict as S
    if semantics == "strict":
        return S.STRICT_MARTS[name](L, as_of, **options)
    if semantics != "literal":
        raise ValueError(f"unknown semantics {semantics!r}")
    fn = M.MARTS[name]
    return fn(L, as_of, plan=plan, **options) if name in M.FACTORISED else fn(L, as_of, **options)
