"""Readers for the input tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class TableSource:
    """Reads ``<root>/<name>.parquet`` and prunes to the named columns.

    Naming the columns here keeps every scan's ReadSchema minimal even before
    Catalyst prunes the rest of the plan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*cols) if cols else df
