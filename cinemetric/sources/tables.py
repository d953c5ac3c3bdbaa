"""Lazy access to the parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class ParquetTables:
    """``tables.lineitem`` etc.  Each read is lazy; Catalyst prunes columns and pushes
    filters into the scan, so callers simply ``select``/``filter`` what they need."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            df = self.read(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLE_NAMES
