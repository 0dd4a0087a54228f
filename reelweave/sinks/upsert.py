"""Upserts: the merged rows as DataFrames, and their write into a partitioned Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave.operators.keys import first_per_key
from reelweave.session import handoff
from reelweave.sources.readers import read_or_empty


def latest_per_key(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Last write per key; the sequence columns order the writes."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in sequence])


def upsert_update(target: DataFrame, changes: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Newest row per key of both sides. A replayed older change loses against the stored sequence."""
    return latest_per_key(target.unionByName(changes), keys, sequence)


def insert_absent(target: DataFrame, incoming: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Target plus the first incoming row of every key it does not have; null keys compare as equal."""
    first = first_per_key(incoming, keys, order).alias("new")
    known = target.select(*keys).alias("old")
    condition = [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in keys]
    return target.unionByName(first.join(known, condition, "left_anti"))


def upsert_coalesce(
    target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], sequence: list[str] | None = None
) -> DataFrame:
    """Incoming values win where they are not null; the others keep the stored value.

    Of changes that repeat a key, each column takes its last value that is not null, in the order of the sequence
    columns; without them in the order of all columns.
    """
    order = F.struct(*(sequence or columns))
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    changes = changes.groupBy(*keys).agg(*latest)
    old, new = target.alias("old"), changes.alias("new")
    condition = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    merged = [F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in [*keys, *columns]]
    return old.join(new, condition, "full_outer").select(*merged)


def upsert_columns(
    target: DataFrame, changes: DataFrame, keys: list[str], update: list[str], sequence: list[str]
) -> DataFrame:
    """Existing rows take only the given columns from the newest change; keys that are new are added whole."""
    newest = latest_per_key(changes, keys, sequence).withColumn("_new", F.lit(True))
    old, new = target.withColumn("_old", F.lit(True)).alias("old"), newest.alias("new")
    condition = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    known, changed = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()

    def pick(column: str):
        take_new = changed if column in update else changed & ~known
        return F.when(take_new, F.col(f"new.{column}")).otherwise(F.col(f"old.{column}")).alias(column)

    return old.join(new, condition, "full_outer").select(*[pick(c) for c in target.columns])


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a job has finished writing the folder."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_partitions(df: DataFrame, path: str, partition: str, mode: str) -> None:
    """Partitioned write; the rebalance splits a hot partition value over several tasks and merges small ones."""
    df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
        partition
    ).parquet(path)


def upsert_table(
    spark: SparkSession,
    table: str,
    staging: str,
    changes: DataFrame,
    schema: str,
    keys: list[str],
    sequence: list[str],
    partition: str,
) -> None:
    """Merges changes into a partitioned Parquet table, rewriting only the partitions they touch.

    The merged partitions go to ``staging`` first and replace the old ones from there. ``staging`` names one batch of
    changes: when a job dies during the replacement, the retry finds the staged rows complete and only repeats the
    replacement, so stored rows cannot get lost between the two writes.
    """
    if not is_complete(spark, staging):
        changes = handoff(changes)
        touched = changes.select(partition).distinct()
        stored = read_or_empty(spark, table, schema, enforce=True).join(touched, partition, "left_semi")
        merged = upsert_update(stored, changes.select(stored.columns), keys, sequence)
        write_partitions(merged, staging, partition, "static")
    staged = spark.read.schema(schema).parquet(staging)
    write_partitions(staged, table, partition, "dynamic")


def drop_staged(spark: SparkSession, staging: str, schema: str) -> None:
    """Empties the staged rows of a batch that is known to be in the table; the folder stays complete."""
    spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staging)
