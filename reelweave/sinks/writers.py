"""Batch writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave.functions.text import key_text


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replaces the whole table with snappy Parquet."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Writes only when there is at least one row."""
    if df.isEmpty():
        return False
    write_table(df, path)
    return True


def export_mart(df: DataFrame, path: str, files: int | None = None) -> None:
    """Mart for a reader of its own, in as many files as Spark's tasks write, or in the given number of files.

    A single file (``files=1``) passes through one task: the caller knows that the mart is small.
    """
    rows = df if files is None else df.repartition(files)
    rows.write.mode("overwrite").option("compression", "snappy").parquet(path)


def to_keyed_json(df: DataFrame, *key: Column, separator: str = "_", fold: bool = True) -> DataFrame:
    """(key, value) messages: the joined natural key and the record as JSON."""
    return df.select(key_text(*key, separator=separator, fold=fold).alias("key"), F.to_json(F.struct("*")).alias("value"))


def film_messages(films: DataFrame) -> DataFrame:
    key = F.concat_ws("_", key_text(F.col("title")), F.col("year"))
    return films.select(key.alias("key"), F.to_json(F.struct("*")).alias("value"))


def character_messages(characters: DataFrame) -> DataFrame:
    return to_keyed_json(characters, F.col("name"), F.col("franchise"))


def box_office_messages(events: DataFrame) -> DataFrame:
    return to_keyed_json(events, F.col("film_title"), F.col("report_date"), F.col("state_code"), fold=False)


def revenue_messages(events: DataFrame) -> DataFrame:
    return to_keyed_json(
        events, F.col("film_id"), F.col("report_date"), F.col("state_code"), separator="-", fold=False
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
