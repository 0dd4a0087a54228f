"""Daily, weekly and total box-office facts, kept current batch by batch.

A batch of daily changes names the films it touches, and nothing else is computed again: their daily rows are merged, their
release date, weekly rows and totals follow from these, also when an earlier report moves the release and with it every week.
The three tables are partitioned by a hash bucket of the film. A batch reads and replaces the buckets of its films only, by a
static partition filter; the numbers of these buckets, at most ``BUCKETS``, are all that comes to the driver.

Every replacement goes through a staged copy that is named by the batch, as in ``sinks.upsert``: a batch that is repeated after a
failure at any point ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelweave.plans import boxoffice as bo
from reelweave.plans.graph import conform
from reelweave.schemas import TABLES
from reelweave.session import handoff
from reelweave.sinks.upsert import drop_staged, is_complete, latest_per_key, upsert_update, write_partitions
from reelweave.sources.readers import read_or_empty
from reelweave.streaming.revenue import DAILY_KEYS, DAILY_SCHEMA, SEQUENCE, classify, quarantined_rows, valid_rows

BUCKETS = 256
BUCKET = "film_bucket"
SCHEMAS = {
    "daily": f"{DAILY_SCHEMA}, {BUCKET} INT",
    "weekly": f"{TABLES['box_office_weekly']}, {BUCKET} INT",
    "total": f"{TABLES['box_office_total']}, {BUCKET} INT",
}


def bucket_of(film: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(film), F.lit(buckets)).cast("int")


def facts_of(daily: DataFrame, titles: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Weekly and total facts of daily rows (film_id, report_date, state_code, revenue). ``titles`` (film_id, film_title,
    film_year) names the films; unknown films keep a null title."""
    films = daily.select("film_id").distinct()
    if titles is None:
        named = films.select("film_id", F.lit(None).cast("string").alias("film_title"), F.lit(None).cast("int").alias("film_year"))
    else:
        named = films.join(titles.select("film_id", "film_title", "film_year"), "film_id", "left")
    days = bo.release_calendar(bo.reduce_reports(daily, ["film_id"]), ["film_id"], attributes=named, reduced=True)
    return conform(bo.weekly_facts(days), "box_office_weekly"), conform(bo.film_facts(days), "box_office_total")


def update_facts(
    spark: SparkSession, root: str, staging: str, changes: DataFrame, titles: DataFrame | None = None, buckets: int = BUCKETS
) -> None:
    """Merges daily changes (columns of ``DAILY_SCHEMA``) into the tables daily, weekly and total below ``root``.

    The number of buckets belongs to the tables: all batches must give the same one. Of changes that repeat a key the last
    in sequence counts; a change older than the stored row changes nothing. Without changes nothing is written.
    """
    changes = handoff(latest_per_key(changes, DAILY_KEYS, SEQUENCE).withColumn(BUCKET, bucket_of(F.col("film_id"), buckets)))
    touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())
    if not touched:
        return
    films = handoff(changes.select("film_id").distinct())

    def stored(table: str) -> DataFrame:
        rows = read_or_empty(spark, f"{root}/{table}", SCHEMAS[table], enforce=True)
        return rows.where(F.col(BUCKET).isin(touched))

    def replace(table: str, rows: Callable[[], DataFrame]) -> None:
        stage = f"{staging}/{table}"
        if not is_complete(spark, stage):
            write_partitions(rows(), stage, BUCKET, "static")
        write_partitions(spark.read.schema(SCHEMAS[table]).parquet(stage), f"{root}/{table}", BUCKET, "dynamic")

    def with_others(table: str, fresh: DataFrame) -> DataFrame:
        """The new rows of the touched films, and the stored rows of the others in their buckets."""
        others = stored(table).join(films, "film_id", "left_anti")
        placed = fresh.withColumn(BUCKET, bucket_of(F.col("film_id"), buckets))
        return others.unionByName(placed)

    replace("daily", lambda: upsert_update(stored("daily"), changes, DAILY_KEYS, SEQUENCE))
    weekly, total = facts_of(stored("daily").join(films, "film_id", "left_semi"), titles)
    replace("weekly", lambda: with_others("weekly", weekly))
    replace("total", lambda: with_others("total", total))


def keep_facts(
    messages: DataFrame, root: str, quarantine: str, work: str, titles: DataFrame | None = None, buckets: int = BUCKETS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Streams revenue messages into the three tables; rejected messages go to the quarantine folder with a reason."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        classified = classify(batch).persist()
        try:
            rejected = quarantined_rows(classified).withColumn("batch_id", F.lit(batch_id))
            rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine)
            update_facts(spark, root, f"{work}/staged/batch-{batch_id}", valid_rows(classified), titles, buckets)
            for table, schema in SCHEMAS.items():  # batches follow each other, so the one before is in the tables
                if batch_id and is_complete(spark, f"{work}/staged/batch-{batch_id - 1}/{table}"):
                    drop_staged(spark, f"{work}/staged/batch-{batch_id - 1}/{table}", schema)
        finally:
            classified.unpersist()

    return (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
