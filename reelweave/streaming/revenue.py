"""Revenue events -> daily fact, kept current by an idempotent upsert per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelweave.functions.measures import MONEY
from reelweave.functions.text import iso_date
from reelweave.schemas import REVENUE_EVENT
from reelweave.session import handoff
from reelweave.sinks.upsert import drop_staged, latest_per_key, upsert_table
from reelweave.sources.streams import decode

DAILY_KEYS = ["film_id", "report_date", "state_code"]
# an event time first, then the position in the topic, so that a replayed older event never wins
SEQUENCE = ["event_time", "_kafka_offset", "_kafka_partition"]
DAILY_SCHEMA = (
    f"film_id BIGINT, report_date DATE, state_code STRING, revenue {MONEY}, event_time TIMESTAMP, "
    "_kafka_partition INT, _kafka_offset BIGINT"
)
REASONS = ["malformed", "missing_key", "bad_date", "missing_revenue"]
CORRUPT = "_corrupt_record"


def reject_reason(record: Column) -> Column:
    """Why a message cannot be stored; null for a good one."""
    report_date = record["report_date"]
    no_key = record["film_id"].isNull() | record["state_code"].isNull() | report_date.isNull()
    return (
        F.when(record.isNull() | record[CORRUPT].isNotNull(), "malformed")
        .when(no_key, "missing_key")
        .when(iso_date(report_date).isNull(), "bad_date")
        .when(record["revenue"].isNull(), "missing_revenue")
    )


def classify(messages: DataFrame) -> DataFrame:
    """Messages with their parsed record and the reject reason."""
    decoded = decode(messages, f"{REVENUE_EVENT}, {CORRUPT} STRING")
    return decoded.withColumn("reason", reject_reason(F.col("record")))


def valid_rows(classified: DataFrame) -> DataFrame:
    """Daily rows of the good messages."""
    return classified.filter(F.col("reason").isNull()).select(
        F.col("record.film_id").alias("film_id"),
        iso_date(F.col("record.report_date")).alias("report_date"),
        F.col("record.state_code").alias("state_code"),
        F.col("record.revenue").cast(MONEY).alias("revenue"),
        F.col("record.timestamp").alias("event_time"),
        "_kafka_partition",
        "_kafka_offset",
    )


def quarantined_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).select(
        "value", "reason", "_kafka_topic", "_kafka_partition", "_kafka_offset"
    )


def upsert_daily(
    messages: DataFrame, table: str, quarantine: str, work: str, trigger: dict | None = None
) -> StreamingQuery:
    """Streams messages into the daily table; rejected ones go to the quarantine folder with a reason.

    Each batch first keeps the newest row per key, then merges it into the touched days. Both writes can be repeated
    for the same batch without changing the result, so a replay after a failure is harmless.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        classified = classify(batch).persist()
        try:
            write_batch = quarantined_rows(classified).withColumn("batch_id", F.lit(batch_id))
            write_batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "batch_id"
            ).parquet(quarantine)
            changes = latest_per_key(valid_rows(classified), DAILY_KEYS, SEQUENCE)
            upsert_table(
                spark, table, f"{work}/staged/batch-{batch_id}", changes, DAILY_SCHEMA, DAILY_KEYS, SEQUENCE,
                "report_date",
            )
            if batch_id:  # batches follow each other, so the one before is in the table
                drop_staged(spark, f"{work}/staged/batch-{batch_id - 1}", DAILY_SCHEMA)
        finally:
            classified.unpersist()

    return (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def with_week_number(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Week of release, from the first report of each film."""
    first = handoff(daily.groupBy(*keys).agg(F.min("report_date").alias("_first")))
    week = F.floor(F.date_diff("report_date", "_first") / 7).cast("int") + 1
    return daily.join(first, keys).withColumn("week_number", week).drop("_first")
