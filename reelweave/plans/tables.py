"""Lazy access to the conformed tables of one catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelweave.schemas import TABLES
from reelweave.sources.readers import read_or_empty, read_table


class Tables:
    """``tables.films`` loads the table ``films`` on first use."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self._load(name)
        setattr(self, name, table)
        return table

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        def load(name: str) -> DataFrame:
            if name in TABLES:
                return read_or_empty(spark, f"{root.rstrip('/')}/{name}", TABLES[name])
            return read_table(spark, root, name)

        return cls(load)
