"""Keys, deduplication, dimension and junction building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.session import ensure_checkpoint_dir, written

ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower 33 bits
ROWS = 500_000  # rows that a task sorts to number them


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key, the first in the given order.

    The rank filter is applied on the map side as well, so a hot key sends one row per task into the shuffle.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def surrogate_key(*columns: Column | str) -> Column:
    """64-bit hash of the natural key: stable between runs, needs no shuffle. Nulls count as a value."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*[part for c in cols for part in (c, c.isNull())])


def dense_index(df: DataFrame, order: list, name: str = "id", start: Column | int = 1) -> DataFrame:
    """Gapless numbers in the given order without sorting everything in one task.

    Rows are range-partitioned and sorted; each partition then adds the number of rows before it. The checkpoint
    fixes the partition bounds, which both steps need.

    Rows are written first, as they are read twice, to find the bounds and to be dealt out. They are dealt out by number, ``ROWS``
    or so to a task: merged by bytes, a task's rows would grow with the input.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = written(df, packed=True)
    placed = (
        df.repartitionByRange(1 + df.count() // ROWS, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_at", ROW_BITS))
    )
    # one row per partition
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    start = F.lit(start) if isinstance(start, int) else start
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (start + F.col("_before") + row).cast("bigint"))
        .drop("_part", "_at", "_before")
    )


def slug_ids(df: DataFrame, slug: Column, order: list, name: str = "id") -> DataFrame:
    """``slug-n`` ids, n counting all rows from zero in the given order."""
    numbered = dense_index(df, order, "_n", start=0)
    return numbered.withColumn(name, F.concat_ws("-", slug, F.col("_n"))).drop("_n")


def get_or_create_ids(dimension: DataFrame, values: DataFrame, name: str = "name") -> DataFrame:
    """The dimension plus one new row, numbered after the largest id, for each value it does not have yet."""
    missing = values.select(name).filter(F.col(name).isNotNull()).distinct().join(dimension, name, "left_anti")
    start = F.coalesce(dimension.agg(F.max("id")).scalar(), F.lit(0)) + F.lit(1)
    created = dense_index(missing, [F.col(name)], "id", start)
    return dimension.select("id", name).unionByName(created.select("id", name))


def resolve_lookup(
    df: DataFrame, dimension: DataFrame, value: Column, name: str, default: str | None = None
) -> DataFrame:
    """Adds the id of a lookup value; unmatched values take the id of the default row, if one is named."""
    pairs = dimension.select(F.col("id").alias(name), F.col("name").alias("_lookup"))
    joined = df.withColumn("_value", value).join(pairs, F.col("_value") == F.col("_lookup"), "left")
    if default is not None:
        fallback = dimension.filter(F.col("name") == default).agg(F.min("id")).scalar()
        joined = joined.withColumn(name, F.coalesce(name, fallback))
    return joined.drop("_value", "_lookup")


def build_dim(df: DataFrame, key: str, attributes: list[str] | None = None, order: list | None = None) -> DataFrame:
    """Dimension of the distinct non-empty keys, with a surrogate key; attributes come from the first row."""
    attributes = attributes or []
    rows = df.select(key, *attributes, *[c for c in (order or []) if isinstance(c, str) and c not in (key, *attributes)])
    rows = rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    if attributes:
        rows = first_per_key(rows, [key], order or attributes)
    else:
        rows = rows.select(key).distinct()
    return rows.select(surrogate_key(key).alias("id"), key, *attributes)


def build_junction(df: DataFrame, keys: list[str], columns: list[str], order: list) -> DataFrame:
    """Junction rows with all keys present, one per key combination."""
    present = df.filter(F.col(keys[0]).isNotNull())
    for key in keys[1:]:
        present = present.filter(F.col(key).isNotNull())
    kept = first_per_key(present, keys, order)
    return kept.select(surrogate_key(*keys).alias("id"), *keys, *columns)


def split_orphans(df: DataFrame, parent: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a parent row, and the rejected rows without one."""
    keys = parent.select(*on).distinct()
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")
