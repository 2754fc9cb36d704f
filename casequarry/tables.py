"""Lazy access to a folder of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casequarry.session import prepare
from casequarry.skew import spread


class Tables:
    """``Tables(spark, folder).orders`` reads ``folder/orders.parquet``.

    Text tables are used for costly per-row work, so they come spread over all
    cores.
    """

    TEXT = ("documents", "pages", "conversations")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        scan = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(scan) if name in self.TEXT else scan
