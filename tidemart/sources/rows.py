"""Landing tables from a handful of inline rows (hand-made edge cases)."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.sources.schemas import EPOCH_DATE, EPOCH_TS, LANDING

DEFAULT_SYNCED = _dt.datetime(2024, 2, 1)


def _default(dt: T.DataType):
    if isinstance(dt, T.StringType):
        return ""
    if isinstance(dt, T.DateType):
        return EPOCH_DATE
    if isinstance(dt, T.TimestampType):
        return EPOCH_TS
    if isinstance(dt, T.DecimalType):
        return Decimal(0)
    if isinstance(dt, T.DoubleType):
        return 0.0
    return 0


def _coerce(v, dt: T.DataType):
    if isinstance(dt, T.DecimalType):
        return Decimal(str(v))
    if isinstance(dt, T.DoubleType):
        return float(v)
    if isinstance(dt, T.DateType) and isinstance(v, str):
        return _dt.date.fromisoformat(v)
    if isinstance(dt, T.TimestampType) and isinstance(v, str):
        return _dt.datetime.fromisoformat(v)
    return v


def landing_rows(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    """Rows of ``table`` with unspecified columns at their defaults and
    metadata version 1, live, synced 2024-02-01 unless given."""
    schema = LANDING[table].schema
    meta = {"_cdc_synced_at": DEFAULT_SYNCED, "_cdc_is_deleted": 0, "_cdc_version": 1}
    data = []
    for r in rows:
        unknown = set(r) - {f.name for f in schema.fields}
        if unknown:
            raise KeyError(f"{table}: unknown columns {sorted(unknown)}")
        data.append(tuple(
            _coerce(r[f.name], f.dataType) if f.name in r else meta.get(f.name, _default(f.dataType))
            for f in schema.fields))
    return spark.createDataFrame(data, schema)
