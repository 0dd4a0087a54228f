"""Helpers that several operators share: caches, row packing, connected components."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave.session import fresh_folder, handoff


class TwoGenerations(dict):
    """A bounded cache: when the young half is full it becomes the old half, and the former old half is dropped.

    Between ``missing`` and ``age`` all keys asked for are in the dictionary itself. At most twice ``size`` entries, and
    those of one batch, are held.
    """

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def missing(self, keys: set) -> set:
        """Keys that must be added; known ones are moved to the young half."""
        absent = keys - self.keys()
        known = absent & self.old.keys()
        self.update({k: self.old[k] for k in known})
        return absent - known

    def age(self) -> None:
        """Call between batches."""
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()


def packed(df: DataFrame) -> DataFrame:
    """Each row as one struct ``row``, so that helper columns cannot clash with columns of the input."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def _rows_and_hash(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the undirected edges ``a, b``; the component is its smallest node.

    Alternates large-star and small-star steps: each step is a grouped minimum with map-side combining and a join of
    the edges with those minima. Both join inputs are plain exchanges of written tables, so AQE can split the rows of
    a hot node. Rows stay in Spark; the driver sees only a row count and a sum of hashes per round. Loops, repeated
    edges and null ends are ignored.
    """
    seen = edges.where(F.col("a") != F.col("b"))
    current = handoff(seen.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _rows_and_hash(current)
    if state[0] == 0:
        return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = handoff(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = handoff(large.where(F.col("u") != F.col("v")).distinct())
        lowest = handoff(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where(F.col("u") != F.col("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        current = handoff(small.distinct())
        reached = _rows_and_hash(current)
        if reached == state:
            break
        state = reached
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """The rows as a Parquet table below the shared folder: compressed, read back by column, and safe from lost executors."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from the folder it was loaded from, where it is not installed on them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
