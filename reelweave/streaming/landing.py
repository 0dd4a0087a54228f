"""Raw landing of topics as NDJSON, by topic and UTC processing date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelweave.sources.readers import apply_hook


def land_topics(
    messages: DataFrame,
    path: str,
    work: str,
    trigger: dict | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Appends messages as JSON lines below ``topic=…/ingest_date=…``.

    One query serves any number of topics. The size of a flush is set by the source (``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger``), its interval by the trigger, e.g. ``{"processingTime": "5 seconds"}``.
    """
    landed = apply_hook(messages, transform).withColumns(
        {"topic": F.col("_kafka_topic"), "ingest_date": F.to_date(F.to_utc_timestamp("_consumed_at", F.current_timezone()))}
    )
    return (
        landed.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", f"{work}/checkpoint")
        .partitionBy("topic", "ingest_date")
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
