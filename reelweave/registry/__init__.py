"""Registered queries: each reads the given Parquet tables; most have an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelweave.functions.measures import decimals_to_double
from reelweave.registry.catalogue import Catalogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(catalogue) -> DataFrame`` under a name; decimal results are published as doubles."""

    def register(fn: Callable[[Catalogue], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(Catalogue(spark, sf_dir)))

        run.__module__ = fn.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    from reelweave.registry import catalogue_queries, document_queries, key_queries, sink_queries, source_queries, text_queries  # noqa: F401
