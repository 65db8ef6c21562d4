"""Lazy access to the parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, dir).orders`` reads ``dir/orders.parquet`` once per
    attribute; Catalyst prunes columns and pushes filters into each scan."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]
