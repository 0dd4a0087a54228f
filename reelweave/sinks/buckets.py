"""Conformed tables laid out in buckets of the keys they are joined on, so that recurring joins need no exchange.

A bucket is read by one task, whole. So only tables with few rows per key are laid out: a film has one total, some weekly rows and
one title. Raw daily rows, where one film may hold a third of all rows, stay as they are: their joins shuffle, and AQE splits the
hot film. While a table is written, a bucket that is larger than others may be several files, written by several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from reelweave.plans.tables import Tables

#: The key each table is laid out by: films meet media on ``media_id``, totals and weekly rows meet each other on ``film_id``.
LAYOUT = {
    "media": "id",
    "films": "media_id",
    "games": "media_id",
    "soundtracks": "media_id",
    "box_office_total": "film_id",
    "box_office_weekly": "film_id",
}
BUCKETS = 64


def write_bucketed(
    spark: SparkSession, tables: Tables, root: str, database: str, layout: Mapping[str, str] = LAYOUT, buckets: int = BUCKETS
) -> Tables:
    """Writes the tables of the layout below ``root``, registers them in ``database``, and gives the catalogue that reads them.

    A table that is there is replaced. Tables outside the layout are those of ``tables``. Null keys share a bucket, tables
    without rows have no files and read as empty. ``buckets`` should divide the tables so that a bucket fits a task; tables
    that meet must be laid out with the same number.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}'")
    for name, key in layout.items():
        spread = getattr(tables, name).hint("rebalance", key)
        writer = spread.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{root.rstrip('/')}/{name}").saveAsTable(f"{database}.{name}")

    def load(name: str):
        return spark.table(f"{database}.{name}") if name in layout else getattr(tables, name)

    return Tables(load)
