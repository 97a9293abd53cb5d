"""Join helpers: default-filling LEFT JOIN."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.sources.schemas import type_default


def prefixed(df: DataFrame, prefix: str, cols: Iterable[str] | None = None) -> DataFrame:
    """Rename columns to ``<prefix><name>`` so chained joins stay unambiguous."""
    names = list(cols) if cols is not None else df.columns
    return df.select(*[F.col(c).alias(prefix + c) for c in names])


def left_join_default(left: DataFrame, right: DataFrame, on: Column,
                      right_cols: Iterable[str] | None = None) -> DataFrame:
    """LEFT JOIN whose unmatched right columns take the type default
    (0, '', 1970-01-01), not NULL — the landing store's non-nullable columns.

    The defaults are filled right after the join, so a later join that uses a
    right column as its key compares with the default (a PO id 0, say).
    """
    rcols = list(right_cols) if right_cols is not None else right.columns
    joined = left.join(right, on, "left")
    rtypes = {f.name: f.dataType for f in right.schema.fields}
    return joined.select(
        *[F.col(c) for c in left.columns],
        *[F.coalesce(F.col(c), type_default(rtypes[c])).alias(c) for c in rcols],
    )
