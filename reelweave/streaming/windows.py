"""Extension: running totals per event-time window. Rows later than the watermark are not counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelweave.sinks.upsert import drop_staged, upsert_table


def windowed_totals(rows: DataFrame, time: str, keys: list[str], value: str, width: str, lateness: str) -> DataFrame:
    """Totals by window and key; partial sums are combined before the shuffle."""
    return (
        rows.withWatermark(time, lateness)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.sum(value).alias("total"), F.count("*").alias("reports"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "total", "reports")
    )


def write_windows(totals: DataFrame, path: str, work: str, trigger: dict | None = None) -> StreamingQuery:
    """Keeps the current total of every window, open ones too, in a table partitioned by the window's date."""
    keys = [c for c in totals.columns if c not in ("window_end", "total", "reports")]
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in totals.schema.fields]
    schema = ", ".join([*columns, "batch BIGINT", "window_date DATE"])

    def store(batch: DataFrame, batch_id: int) -> None:
        changes = batch.withColumns({"batch": F.lit(batch_id).cast("bigint"), "window_date": F.to_date("window_start")})
        upsert_table(
            batch.sparkSession, path, f"{work}/staged/batch-{batch_id}", changes, schema, keys, ["batch"], "window_date"
        )
        if batch_id:  # batches follow each other, so the one before is in the table
            drop_staged(batch.sparkSession, f"{work}/staged/batch-{batch_id - 1}", schema)

    return (
        totals.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{work}/checkpoint")
        .outputMode("update")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
