"""Batch readers. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelweave import fixed_values as fv
from reelweave.operators.documents import is_catalogue_file, parse_documents
from reelweave.schemas import TABLES


def source_path() -> Column:
    """The path of the file a row was read from, as written on disk: the metadata has it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_ndjson(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """NDJSON below ``root/<date>/``; the plain date folder becomes ``ingest_date``."""
    rows = spark.read.schema(schema).json(f"{root.rstrip('/')}/*/*.json")
    date = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return rows.withColumn("ingest_date", F.try_to_date(F.nullif(date, F.lit(""))))


def json_files(spark: SparkSession, root: str) -> DataFrame:
    """(value, path) of all JSON files below ``root``, each whole."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root, wholetext=True)
    return files.select("value", source_path().alias("path"))


def file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def document_files(spark: SparkSession, root: str) -> DataFrame:
    """The files that hold one catalogue document each: without summary and soundtrack files."""
    return json_files(spark, root).filter(is_catalogue_file(file_name()))


def soundtrack_files(spark: SparkSession, root: str) -> DataFrame:
    """The files that hold the soundtracks of a studio, a JSON array of films each."""
    name = F.lower(file_name())
    return json_files(spark, root).filter(name.contains("soundtracks") & ~name.contains("summary"))


def read_documents(spark: SparkSession, root: str, skip_dirs: tuple[str, ...] = ()) -> DataFrame:
    """All JSON objects below ``root``, one per file, without summary files and the skipped folders."""
    docs = parse_documents(document_files(spark, root))
    return docs.filter(~F.col("source_dir").isin(*skip_dirs)) if skip_dirs else docs


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A conformed table, or a single Parquet file of that name."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def read_or_empty(spark: SparkSession, path: str, schema: str, enforce: bool = False) -> DataFrame:
    """The Parquet data at the path, or no rows of the given schema when there is none.

    Only a missing or empty folder counts as absent input; every other error is raised. ``enforce`` reads with the
    given schema instead of the one in the files.
    """
    reader = spark.read.schema(schema) if enforce else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def register_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> None:
    """Temporary views over the conformed Parquet tables; absent tables become empty views."""
    for name in names or list(TABLES):
        read_or_empty(spark, f"{root.rstrip('/')}/{name}", TABLES[name]).createOrReplaceTempView(name)


def create_external_tables(spark: SparkSession, root: str, database: str, names: list[str] | None = None) -> None:
    """Catalogue tables over the Parquet folders; existing ones stay as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names or list(TABLES):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({TABLES[name]}) USING parquet "
            f"LOCATION '{root.rstrip('/')}/{name}'"
        )


def with_source(df: DataFrame) -> DataFrame:
    """File, folder and extraction time of rows read from files."""
    path = source_path()
    return df.select(
        "*",
        F.element_at(F.split(path, "/"), -1).alias("source_file"),
        F.element_at(F.split(path, "/"), -2).alias("source_dir"),
        F.current_timestamp().alias("extracted_at"),
    )


def apply_hook(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    return df if transform is None else df.transform(transform)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows as a local relation: its size is known, so a join with it is planned as a broadcast."""
    fields = T._parse_datatype_string(schema).fields
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(fields)}
    types = [(f.name, {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[f.dataType.simpleString()]) for f in fields]
    return spark.createDataFrame(pa.table(columns, schema=pa.schema(types)))


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return small_table(spark, list(enumerate(names, start=1)), "id BIGINT, name STRING")


def roles(spark: SparkSession) -> DataFrame:
    return _names(spark, fv.ROLES)


def genders(spark: SparkSession) -> DataFrame:
    return _names(spark, fv.GENDERS)


def platforms(spark: SparkSession) -> DataFrame:
    return _names(spark, fv.PLATFORMS)


def credit_types(spark: SparkSession) -> DataFrame:
    return _names(spark, fv.CREDIT_TYPES)


def award_bodies(spark: SparkSession) -> DataFrame:
    return _names(spark, fv.AWARD_BODIES)


def award_categories(spark: SparkSession) -> DataFrame:
    bodies = {name: i for i, name in enumerate(fv.AWARD_BODIES, start=1)}
    rows = [(i, bodies[body], name, level) for i, (body, name, level) in enumerate(fv.AWARD_CATEGORIES, start=1)]
    return small_table(spark, rows, "id BIGINT, award_body_id BIGINT, name STRING, is_media_level BOOLEAN")


def species(spark: SparkSession) -> DataFrame:
    """Canonical species; a child refers to its parent."""
    ids = {name: i for i, name in enumerate(fv.SPECIES, start=1)}
    rows = [(i, name, ids.get(fv.SPECIES_PARENTS.get(name))) for name, i in ids.items()]
    return small_table(spark, rows, "id BIGINT, name STRING, parent_species_id BIGINT")


def species_with_parent(species_table: DataFrame) -> DataFrame:
    parent = species_table.select(F.col("id").alias("parent_species_id"), F.col("name").alias("parent_name"))
    return species_table.join(parent, "parent_species_id", "left").select("id", "name", "parent_name")
