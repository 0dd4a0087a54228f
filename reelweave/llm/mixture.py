"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Method: every source has a weight schedule over training time 0 to 1, a line through given knots. Its integral says how much
of the source's target has been used up to a time. A document takes a range of its source's words; inverting the integral at
the begin of that range gives the document's training position, and documents are range-sorted by position.

The words before a document in its source are found without bringing a source into one task: documents are ordered by a hash
of their id, cut into ranges of that hash, the ranges are summed, and each document adds the sum before its range to the sum
before it in the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.llm.common import packed, stored
from reelweave.session import handoff

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # by code point order of the sources, repeating
#: Knots (time, weight) by the same cycle: heavy sources come early, light ones late. Only the shape counts.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
ROWS_PER_RANGE = 2000


def integral(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """The segments of a schedule as (time, weight, slope, area before)."""
    out, area = [], 0.0
    for (t, w), (after, w_after) in zip(knots, knots[1:], strict=False):
        if not after > t or min(w, w_after) < 0 or w + w_after == 0:
            raise ValueError("a schedule needs rising times and weights of at least 0, not both 0 at the ends of a segment")
        out.append((t, w, (w_after - w) / (after - t), area))
        area += (w + w_after) / 2 * (after - t)
    return [*out, (knots[-1][0], knots[-1][1], 0.0, area)]


def position_at(fraction: Column, schedule: Column, schedules: Sequence) -> Column:
    """The time at which a schedule has used the given fraction of its area."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        *segments, (_, _, _, total) = integral(knots)
        time = F.lit(None).cast("double")
        for t, w, slope, before in segments:
            rest = fraction * F.lit(total) - F.lit(before)
            root = F.sqrt(F.lit(w * w) + F.lit(2.0 * slope) * rest)
            inside = F.lit(t) + F.lit(2.0) * rest / (F.lit(w) + root)
            time = F.when(rest > 0, inside).when(rest == 0, F.lit(t)).otherwise(time)
        out = F.when(schedule == k, time).otherwise(out)
    return out


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """One row per source: its size, rows, schedule and target.

    ``share`` of all words is dealt out by weight; no source gets more than ``epochs`` times its size, and what is too much
    for one goes to the others by weight. With the sources sorted by limit per weight, those that reach their limit come
    first, and the words per weight of the others are the largest quotient of what is left and the weights that are left.
    The window has one row per source: the list of sources is the configuration of a mix.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = (rank % len(weights)).cast("int")
    sources = sources.withColumn("cycle", cycle).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("cycle") + 1)
    )
    order = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    everything = F.sum("source_size").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    sources = sources.withColumn("limit", F.col("source_size") * epochs)
    sources = sources.withColumn("quotient", (F.lit(share) * everything - before) / left)
    best = F.max("quotient").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    sources = sources.withColumn("target", F.least(F.col("limit").cast("double"), best * F.col("weight")))
    return sources.select("source", "source_size", "n_rows", "cycle", "target")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence = SCHEDULES,
    share: float = 1.5,
    epochs: int = 2,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per document: ``key, text_hash, source, size, source_size, target, taken, position_1 … position_epochs``.

    ``taken`` counts the words that the mix takes, repeats included: whole copies, and at most one cut document per source,
    where the target falls. Positions are null for copies that are not taken. A null or empty text has size 0 and takes
    nothing; a null source is a source of its own, the last one; null keys come first in the order. Rows with equal keys
    are told apart by source and text, and fully equal rows share their words in some order. Without rows the result is
    empty. Other columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    sized = stored(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.regexp_count(whole, F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(whole).alias("text_hash"),
            digest.alias("digest"),
        ),
        "sizes",
    )
    targets = handoff(source_targets(sized, weights, share, epochs))
    spot = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint")
    ranges = F.ceil(F.col("n_rows") / rows_per_range)
    placed = (
        sized.withColumnRenamed("source", "_source")
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .drop("_source")
        .withColumn("range", F.shiftright(spot * ranges, 32))
    )
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    up_to = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"), F.col("range").alias("_range"), F.coalesce(F.sum("in_range").over(up_to), F.lit(0)).alias("before")
    )
    order = W.partitionBy("source", "range").orderBy("digest", "key", "size", "text_hash")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    begun = (
        placed.withColumn("inside", inside)
        .join(handoff(sums), F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")))
        .withColumn("begin", F.col("before") + F.col("inside"))
    )
    taken, positions = F.lit(0).cast("bigint"), []
    for epoch in range(epochs):
        offset = F.col("begin") + F.col("source_size") * epoch
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - offset))
        taken = taken + words
        fraction = offset / F.col("target")
        positions.append(F.when(words > 0, position_at(fraction, F.col("cycle"), schedules)).alias(f"position_{epoch + 1}"))
    return begun.select(
        F.col("key").alias(key), "text_hash", F.col("source"), "size", "source_size", "target", taken.alias("taken"), *positions
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix in training order, with the input's columns: a document comes once per copy taken.

    The one document per source that its target cuts ends with a copy of its first words, joined by spaces. Documents of
    which the mix takes no word are left out, those without words among them. All columns of the input are kept.
    """
    plan = plan_mix(docs, key=key, text=text, source=source, **options)
    names = [c for c in plan.columns if c.startswith("position_")]
    copies = F.array(*[F.struct(F.col(c).alias("at"), F.lit(k).alias("epoch")) for k, c in enumerate(names)])
    same = W.partitionBy("k", "s", "h").orderBy("first_at")
    plan = plan.select(
        F.col(key).alias("k"), F.col("source").alias("s"), F.col("text_hash").alias("h"), "size", "taken",
        F.filter(copies, lambda c: c["at"].isNotNull()).alias("copies"), F.col(names[0]).alias("first_at"),
    ).withColumn("n", F.row_number().over(same))
    rows = packed(docs).select(
        "row",
        F.col(f"row.`{key}`").alias("k"),
        F.col(f"row.`{source}`").cast("string").alias("s"),
        F.xxhash64(F.coalesce(F.col(f"row.`{text}`"), F.lit(""))).alias("h"),
    )
    rows = rows.withColumn("n", F.row_number().over(W.partitionBy("k", "s", "h").orderBy("k")))
    plan = plan.where(F.col("taken") > 0).select(*[F.col(c).alias(f"_{c}") for c in ("k", "s", "h", "n", "size", "taken", "copies")])
    on = F.col("k").eqNullSafe(F.col("_k")) & F.col("s").eqNullSafe(F.col("_s")) & (F.col("h") == F.col("_h")) & (F.col("n") == F.col("_n"))
    mixed = rows.join(plan, on).withColumn("copy", F.explode("_copies"))
    words = F.least(F.col("_size"), F.col("_taken") - F.col("_size") * F.col("copy.epoch")).cast("int")
    whole = F.col(f"row.`{text}`")
    first = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(f"({WORD})")), 1, words), " ")
    cut = F.when(words >= F.col("_size"), whole).otherwise(first)
    at = F.col("copy.at")
    mixed = mixed.select(F.col("row").withField(f"`{text}`", cut).alias("row"), at.alias("at"))
    return mixed.repartitionByRange("at").sortWithinPartitions("at").select("row.*")
