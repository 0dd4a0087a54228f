"""Removal of lines that stand on many sites, with DataFrame functions only.

Method: per hash of a normalised line, a HyperLogLog sketch of its sites is merged by aggregation. Lines whose estimate is
clearly beside the threshold are decided by it; those near it get an exact count of distinct sites. Of a line that stands on
enough sites one occurrence stays, the one in the document with the smallest id; all others are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave.llm.common import packed, stored

MIN_SITES = 5
LOG_BUCKETS = 12
#: Half width of the band in which lines are counted exactly: over five times the sketch's standard error of 1.6 %.
BAND = 0.08


def normalised(line: Column) -> Column:
    return F.lower(F.trim(line))


def line_occurrences(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """One row per line that is not blank: document, line number from 0, 128-bit hash of the line, site."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(whole).alias("text_hash"),
        F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("")).alias("site"),
        F.posexplode(F.split(whole, "\n", -1)).alias("line_no", "line"),
    ).withColumn("line", normalised(F.col("line")))
    return lines.where(F.col("line") != "").select(
        "key", "text_hash", "site", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")
    )


def spread_lines(occurrences: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h1, h2, first`` of the lines on at least ``min_sites`` sites; ``first`` is the occurrence that stays."""
    sketched = occurrences.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", F.lit(LOG_BUCKETS)).alias("sketch"),
        F.min(F.struct("key", "text_hash", "line_no")).alias("first"),
    )
    estimate = F.hll_sketch_estimate("sketch")
    width = max(1.0, BAND * min_sites)
    likely = stored(
        sketched.select("h1", "h2", "first", estimate.alias("estimate")).where(F.col("estimate") >= min_sites - width), "spread"
    )
    near = likely.where(F.col("estimate") <= min_sites + width).select("h1", "h2")
    sites = occurrences.join(near, ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = sites.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("h1", "h2")
    sure = likely.where(F.col("estimate") > min_sites + width).select("h1", "h2")
    return likely.drop("estimate").join(sure.unionByName(exact), ["h1", "h2"], "left_semi")


def remove_spread_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """``row`` (the input's row, its text without the removed lines), ``n_lines`` and ``n_removed`` of every document.

    Lines end at line feeds and are compared without outer spaces and letter case; blank lines are never removed. A null
    site is a site of its own. A null text stays null with no lines, an empty text has one blank line. Rows with equal key
    and text count as one document, whose lines stay or go together. Of a line that repeats inside its first document only
    the first stays. Null keys come first.
    """
    occurrences = stored(line_occurrences(docs, key, text, site), "lines")
    spread = stored(spread_lines(occurrences, min_sites), "spread")
    kept = (
        F.col("first.key").eqNullSafe(F.col("key"))
        & (F.col("first.text_hash") == F.col("text_hash"))
        & (F.col("first.line_no") == F.col("line_no"))
    )
    removed = (
        occurrences.join(spread, ["h1", "h2"])
        .where(~kept)
        .groupBy(F.col("key").alias("_key"), F.col("text_hash").alias("_text_hash"))
        .agg(F.collect_set("line_no").alias("_removed"))
    )
    rows = packed(docs)
    whole = F.col(f"row.`{text}`")
    rows = rows.select("row", F.col(f"row.`{key}`").alias("_k"), F.xxhash64(F.coalesce(whole, F.lit(""))).alias("_h"))
    joined = rows.join(removed, F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_h") == F.col("_text_hash")), "left")
    lines = F.split(whole, "\n", -1)
    rest = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("_removed", i)), "\n")
    return joined.select(
        F.col("row").withField(f"`{text}`", F.when(F.col("_removed").isNull(), whole).otherwise(rest)).alias("row"),
        F.coalesce(F.when(whole.isNotNull(), F.size(lines)), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("bigint").alias("n_removed"),
    ).withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("bigint")))


def counted_rows(removed: DataFrame) -> DataFrame:
    """The columns of the documents with ``n_lines`` and ``n_removed`` behind them; document columns of these names give way."""
    made = ("n_lines", "n_removed")
    kept = [F.col(f"row.`{c}`") for c in removed.schema["row"].dataType.names if c.lower() not in made]
    return removed.select(*kept, *made)
