"""Substring search over a stored index of three-letter grams.

The index is three tables: ``postings`` has a row per gram and key, ``counts`` the number of keys of each gram, ``rows`` the
searched texts. Postings and counts are partitioned by a hash bucket of the gram and sorted by gram, rows by a bucket of the key,
so a search reads the buckets it needs, and in them the row groups whose range holds its grams. A posting is a row and no list:
those of a frequent gram are split over files and tasks like any other rows.

A search intersects the postings of its rarest grams by counting them per key, and verifies the texts of the keys that have
all of them. Texts of fewer than three letters have no gram and are looked for in all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave.sinks.upsert import write_partitions

SIZE = 3
BUCKETS = 64
RAREST = 3  # grams of a search text whose postings are read
GRAM_BUCKET, KEY_BUCKET = "gram_bucket", "key_bucket"


def _grams(text: Column) -> Column:
    """The grams of a text in lower case, in the order of the text; none for null and for texts of fewer letters than a gram.

    One pass of a pattern that looks ahead a gram and goes on by one letter.
    """
    pattern = F.lit(f"(?s)(?=(.{{{SIZE}}})).")
    return F.coalesce(F.regexp_extract_all(F.lower(text), pattern, F.lit(1)), F.array().cast("array<string>"))


def grams_of(*texts: Column) -> Column:
    """The different grams of all given texts."""
    return F.array_distinct(F.concat(*[_grams(text) for text in texts]))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def build_index(df: DataFrame, key: str, columns: list[str], path: str, buckets: int = BUCKETS) -> None:
    """Writes the index of the text columns below ``path``. Rows without a key are left out; keys may repeat."""
    rows = df.select(F.col(key).alias("key"), *columns).where(F.col("key").isNotNull())
    placed = rows.withColumn(KEY_BUCKET, _bucket(F.col("key"), buckets))
    write_partitions(placed, f"{path}/rows", KEY_BUCKET, "static")
    postings = rows.select("key", F.explode(grams_of(*[F.col(c) for c in columns])).alias("gram")).withColumn(GRAM_BUCKET, _bucket(F.col("gram"), buckets))
    sorted_postings = postings.hint("rebalance", GRAM_BUCKET).sortWithinPartitions(GRAM_BUCKET, "gram", "key")
    sorted_postings.write.mode("overwrite").partitionBy(GRAM_BUCKET).parquet(f"{path}/postings")
    spark = df.sparkSession
    counts = spark.read.schema(postings.schema).parquet(f"{path}/postings").groupBy(GRAM_BUCKET, "gram").agg(F.count("*").alias("n"))
    write_partitions(counts, f"{path}/counts", GRAM_BUCKET, "static")


def _contains(columns: list[str], wanted: str) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.lower(F.col(c)).contains(wanted), F.lit(False)) for c in columns])


def search(spark: SparkSession, path: str, columns: list[str], wanted: str, buckets: int = BUCKETS) -> DataFrame:
    """``key`` and the columns of all indexed rows that contain the text in any column, letter case aside.

    ``columns`` and ``buckets`` are those of the index. The driver sees a count for each gram of the search text, and the numbers
    of the row buckets that hold a candidate.
    """
    rows = spark.read.parquet(f"{path}/rows")
    wanted = spark.range(1).select(F.lower(F.lit(wanted))).first()[0]  # letter case as in the index
    found = _contains(columns, wanted)
    grams = sorted({wanted[k : k + SIZE] for k in range(len(wanted) - SIZE + 1)})
    if not grams:
        return rows.where(found).select("key", *columns)

    def only(table: str, chosen: list[str]) -> DataFrame:
        numbers = [r[0] for r in spark.createDataFrame([(g,) for g in chosen], "g STRING").select(_bucket(F.col("g"), buckets)).collect()]
        read = spark.read.parquet(f"{path}/{table}")
        return read.where(F.col(GRAM_BUCKET).isin(sorted(set(numbers))) & F.col("gram").isin(chosen))

    counts = {r["gram"]: r["n"] for r in only("counts", grams).select("gram", "n").collect()}
    if len(counts) < len(grams):  # a gram that no row has
        return rows.where(F.lit(False)).select("key", *columns)
    rarest = sorted(grams, key=lambda g: (counts[g], g))[:RAREST]
    held = only("postings", rarest).groupBy("key").agg(F.count_distinct("gram").alias("n"))
    candidates = held.where(F.col("n") == len(rarest)).select("key", _bucket(F.col("key"), buckets).alias(KEY_BUCKET))
    places = sorted(r[0] for r in candidates.select(KEY_BUCKET).distinct().collect())
    near = rows.where(F.col(KEY_BUCKET).isin(places)).join(candidates.select("key"), "key", "left_semi")
    return near.where(found).select("key", *columns)
