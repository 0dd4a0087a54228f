"""Ordered load of the conformed tables with a row-count report."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelweave.plans import boxoffice as bo
from reelweave.plans import builders as b
from reelweave.plans import marts
from reelweave.plans.tables import Tables
from reelweave.schemas import RAW_BOX_OFFICE, RAW_CHARACTERS, RAW_FILMS
from reelweave.sinks.writers import export_mart, write_table
from reelweave.sources import readers

Stage = tuple[str, Callable[[], DataFrame]]


def run_stages(
    spark: SparkSession, stages: list[Stage], root: str, skip: Collection[str] = (), dry_run: bool = False
) -> DataFrame:
    """Writes each stage's table below ``root`` in order; returns (position, table, rows, state).

    Rows are counted while they are written, so no plan runs twice. A dry run counts without writing.
    """
    report = []
    for position, (name, build) in enumerate(stages):
        if name in skip:
            report.append((position, name, None, "skipped"))
            continue
        counted = Observation(f"rows-{position}")
        table = build().observe(counted, F.count(F.lit(1)).alias("rows"))
        if dry_run:
            table.write.format("noop").mode("overwrite").save()
        else:
            write_table(table, f"{root.rstrip('/')}/{name}")
        report.append((position, name, counted.get["rows"], "counted" if dry_run else "written"))
    return spark.createDataFrame(report, "position INT, table STRING, rows BIGINT, state STRING")


def catalogue_stages(spark: SparkSession, raw: str, root: str) -> list[Stage]:
    """Raw NDJSON below ``raw`` -> star schema below ``root``. Every stage reads the tables of the stages before."""
    t = Tables.from_parquet(spark, root)

    def films() -> DataFrame:
        return readers.read_ndjson(spark, f"{raw}/films", RAW_FILMS)

    def people() -> DataFrame:
        return readers.read_ndjson(spark, f"{raw}/characters", RAW_CHARACTERS)

    def box_office() -> DataFrame:
        return readers.read_ndjson(spark, f"{raw}/boxoffice", RAW_BOX_OFFICE)

    return [
        ("studios", lambda: b.build_studios(films())),
        ("franchises", lambda: b.build_franchises(films())),
        ("media", lambda: b.build_media(films().withColumn("media_type", F.lit("film")), t.franchises)),
        ("films", lambda: b.build_films(films(), t.media, t.studios)),
        ("roles", lambda: readers.roles(spark)),
        ("genders", lambda: readers.genders(spark)),
        ("talent", lambda: b.build_talent(people())),
        ("characters", lambda: b.build_characters(people(), t.roles, t.genders, franchises=t.franchises)),
        ("character_appearances", lambda: b.build_appearances(people(), t.media, t.roles)),
        ("box_office_daily", lambda: bo.build_daily(box_office(), t.films, t.media)),
        ("box_office_weekly", lambda: bo.build_weekly(t.box_office_daily)),
        ("box_office_total", lambda: bo.build_total(t.box_office_daily)),
    ]


def export_marts(spark: SparkSession, root: str, exports: str, names: Collection[str] | None = None) -> None:
    t = Tables.from_parquet(spark, root)
    for mart in (marts.films_complete, marts.characters_complete, marts.boxoffice_summary, marts.studio_stats):
        if names is None or mart.__name__ in names:
            export_mart(mart(t), f"{exports.rstrip('/')}/{mart.__name__}")
