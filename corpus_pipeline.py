"""The corpus pipeline over ``documents``: five stages, each of which works on all rows that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave.llm import bpe, line_spread, mixture, simhash, toxicity
from reelweave.llm.common import packed, ship_package, stored, unpacked
from reelweave.llm.queries import read, vocabulary

#: SQL cannot train and run the network of the first stage; tests compare the stages with plain Python instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a network trained on the labels that are not held out."""
    ship_package(spark)
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without further occurrences of lines that stand in many sources."""
    ship_package(spark)
    return unpacked(line_spread.remove_spread_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints; of equal rows one."""
    ship_package(spark)
    groups = simhash.near_duplicates(docs)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    rows = packed(docs)
    rows = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return unpacked(rows.dropDuplicates(["row"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order, once per copy taken."""
    ship_package(spark)
    return mixture.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    ship_package(spark)
    return bpe.round_trip(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_spread", drop_spread_lines),
    ("simhash", drop_near_duplicates),
    ("mixing", mix),
    ("bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents; the result of each is written once and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
