"""Ledger of landed offsets: which records of each topic and partition have arrived, as sets of ranges that can be merged.

A range is ``first, last, records`` beside its keys; more records than offsets mean repeats. Sets of ranges of several batches
merge into one, whatever their order and overlap. Ranges are cut into slices of the offset axis and merged slice by slice, so a
hot partition is spread over as many tasks as it has slices; a slice has at most one row per offset in it when it is merged.
Only ranges that touch the edges of their slice, at most two per slice, are then merged over the whole partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEYS = ["topic", "partition"]
SLICE = 1 << 20  # offsets of a partition that are merged in one group
RANGES = "topic STRING, partition INT, first BIGINT, last BIGINT, records BIGINT"


def _islands(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges that overlap or touch, as one; ``keys`` name what is merged on its own."""
    rows = ranges.groupBy(*keys, "first").agg(F.max("last").alias("last"), F.sum("records").alias("records"))
    order = W.partitionBy(*keys).orderBy("first")
    reached = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_begins", F.when(F.col("first") <= reached + 1, 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_begins").over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = rows.groupBy(*keys, "_island")
    return merged.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("records").alias("records")).drop("_island")


def merge_ranges(ranges: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """Disjoint ranges that do not touch, with the records of all ranges they were made of.

    Null topics and partitions are keys of their own. Rows without both ends, or that end before they begin, count for nothing.
    """
    rows = ranges.select(*KEYS, "first", "last", "records").where("first <= last")
    low, high = F.expr(f"first - pmod(first, {slice_size})"), F.expr(f"last - pmod(last, {slice_size})")
    begins = F.explode(F.sequence(low, high, F.lit(slice_size).cast("bigint")))
    pieces = rows.withColumn("_slice", begins).select(
        *KEYS, "_slice", F.greatest("first", "_slice").alias("first"),
        F.least(F.col("last"), F.col("_slice") + slice_size - 1).alias("last"),
        F.when(F.col("first") >= F.col("_slice"), F.col("records")).otherwise(0).alias("records"),
    )
    islands = _islands(pieces, [*KEYS, "_slice"])
    at_edge = (F.col("first") == F.col("_slice")) | (F.col("last") == F.col("_slice") + slice_size - 1)
    columns = [*KEYS, "first", "last", "records"]
    across = _islands(islands.where(at_edge).select(columns), KEYS)
    return islands.where(~at_edge).select(columns).unionByName(across.select(columns))


def ranges_of(messages: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """Ranges of the records of a batch, by their ``_kafka_topic``, ``_kafka_partition`` and ``_kafka_offset``."""
    at = F.col("_kafka_offset").cast("bigint")
    rows = messages.select(
        F.col("_kafka_topic").alias("topic"), F.col("_kafka_partition").cast("int").alias("partition"), at.alias("first"), at.alias("last")
    )
    return merge_ranges(rows.withColumn("records", F.lit(1).cast("bigint")), slice_size)


def write_batch(messages: DataFrame, path: str, batch: int, slice_size: int = SLICE) -> None:
    """Stores the ranges of one batch; the same batch again replaces what it stored before."""
    ranges_of(messages, slice_size).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_ledger(spark: SparkSession, path: str, slice_size: int = SLICE) -> DataFrame:
    """The merged ranges of all batches below a path."""
    return merge_ranges(spark.read.schema(RANGES).parquet(path), slice_size)


def track_offsets(messages: DataFrame, path: str, work: str) -> StreamingQuery:
    """Keeps the ledger of a stream: one folder per micro-batch, replaced if the micro-batch is repeated."""
    return (
        messages.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, path, batch))
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def missing_ranges(ledger: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """``topic, partition, first, last`` of what lies between the ranges of a partition but has not landed.

    The range after a range is looked up in its slice, and for the last one of a slice in the first of the next slice in use.
    """
    rows = ledger.select(*KEYS, "first", "last").withColumn("_slice", F.expr(f"first - pmod(first, {slice_size})"))
    starts = rows.groupBy(*KEYS, "_slice").agg(F.min("first").alias("_start"))
    starts = starts.withColumn("_start", F.lead("_start").over(W.partitionBy(*KEYS).orderBy("_slice")))
    starts = starts.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("_slice").alias("_of"), "_start")
    same = F.col("_slice") == F.col("_of")
    for key in KEYS:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    following = F.lead("first").over(W.partitionBy(*KEYS, "_slice").orderBy("first"))
    rows = rows.withColumn("_next", following).join(starts, same)
    return rows.select(*KEYS, (F.col("last") + 1).alias("first"), (F.coalesce("_next", "_start") - 1).alias("last")).where("first <= last")


def commit_points(ledger: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """``topic, partition, next_offset, highest, records, repeats``: up to where each partition has landed without a gap.

    ``committed`` (``topic, partition, offset``) names the next offset to read as last committed; it moves on only over a range
    that holds it. Partitions without such a row, or without ``committed``, begin at the smallest offset that has landed.
    """
    begin = F.min("first")
    rows = ledger
    if committed is not None:
        known = committed.groupBy(*KEYS).agg(F.max("offset").alias("_from")).select(
            *[F.col(k).alias(f"_{k}") for k in KEYS], "_from"
        )
        same = F.lit(True)
        for key in KEYS:
            same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
        rows = ledger.join(known, same, "left")
        begin = F.coalesce(F.max("_from"), begin)
        holds = F.max(F.when((F.col("first") <= F.col("_from")) & (F.col("_from") <= F.col("last")), F.col("last") + 1))
        reached = F.when(F.max("_from").isNull(), F.min_by("last", "first") + 1).otherwise(F.coalesce(holds, begin))
    else:
        reached = F.min_by("last", "first") + 1
    return rows.groupBy(*KEYS).agg(
        reached.alias("next_offset"), F.max("last").alias("highest"), F.sum("records").alias("records"),
        F.sum(F.col("records") - (F.col("last") - F.col("first") + 1)).alias("repeats"),
    )
