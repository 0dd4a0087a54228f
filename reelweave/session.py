"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that the plans in this package rely on: AQE turns joins into broadcasts only after it has measured the
# side, splits skewed partitions of sort-merge joins and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "reelweave", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; Spark's own scratch folder only where it is unset and
    driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(spark.conf.get("spark.local.dir", "/tmp"), "reelweave-checkpoints")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is ever written twice to the same one."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def handoff(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, for a table that several later steps read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, packed: bool = False) -> DataFrame:
    """Like ``handoff``, as a table whose size the planner takes from its own files.

    A checkpoint keeps the size estimated from the files that its rows came from, however many rows a flattening has made of
    them: tables too large for the driver would be broadcast. The files are plain, as packed ones look many times too small;
    ``packed`` ones are for rows that meet no join before they are written again, or only joins told to sort (``sorting``).
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, "written")
    layout = {"compression": "zstd"} if packed else {"compression": "uncompressed", "parquet.enable.dictionary": "false"}
    df.write.options(**layout).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def sorting(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the catalogue and whose size the planner cannot know: the join sorts and never broadcasts."""
    return df.hint("merge")
