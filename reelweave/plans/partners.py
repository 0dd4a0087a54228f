"""The characters that share most titles with a character, without all pairs inside a title.

Titles with a small cast are paired by character: an appearance meets at most ``small`` others, so these pairs grow with the
appearances; they are made where they are counted and never shuffled. Titles with a larger cast are never paired by character. There characters are put together by the *set* of large
titles they appear in: two characters share as many large titles as their sets do, so only sets meet, and of each set only its
first ``k + 1`` characters can be among anybody's first ``k``. One title with all characters is one more element of every set.

A set is known by its size and two 64-bit hashes, combined by exclusive or, so no list of titles is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.session import handoff, written

SMALL = 256  # largest cast that is paired by character
HOT = 4096  # small titles of one character from which its pairs are shuffled as pairs
PAIRS = 1 << 21  # pairs that one task makes and counts, on average
BLOCK = 1024  # sets of one title that are joined in one group
SET = ["set_size", "set_low", "set_high"]


def _first(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first rows of each key; Spark applies the limit before the shuffle as well."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def _sets(large: DataFrame) -> DataFrame:
    """One row per character of a large title: the set of its large titles."""
    return large.groupBy("character_id").agg(
        F.count("*").alias("set_size"),
        F.bit_xor(F.xxhash64("media_id")).alias("set_low"),
        F.bit_xor(F.xxhash64(F.lit("high"), "media_id")).alias("set_high"),
    )


def _renamed(names: list[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{c}") for c in names]


def _overlaps(large: DataFrame, sets: DataFrame) -> DataFrame:
    """How many titles two sets share, both ways and each set with itself; sets that share none have no row.

    A title that many sets hold is cut into blocks of about ``BLOCK`` sets: a group is one block against the title's sets.
    """
    held = handoff(large.join(sets, "character_id").select("media_id", *SET).distinct())
    blocks = held.groupBy("media_id").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = held.join(blocks, "media_id")
    left = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    block = F.pmod(F.xxhash64(*SET), F.col("blocks")).cast("int")
    right = placed.select("media_id", block.alias("block"), *_renamed(SET, "other_"))
    met = left.join(right, ["media_id", "block"])
    return met.groupBy(*SET, *[f"other_{c}" for c in SET]).agg(F.count("*").alias("shared"))


def _titles(few: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """One row per small title: ``plain`` and ``held``, its members without and with large titles; ``cast``, all of them with
    the flags ``held`` and ``hot``; ``bound``, the id of the last of its first ``k + 1`` members."""
    held = sets.select("character_id", F.lit(True).alias("held"))
    often = few.groupBy("character_id").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    flagged = few.join(held, "character_id", "left").join(often, "character_id", "left").select(
        "media_id", "character_id", F.col("held").isNotNull().alias("held"), F.col("n").isNotNull().alias("hot")
    )
    member = F.col("character_id")
    grouped = flagged.groupBy("media_id").agg(
        F.collect_list(F.when(~F.col("held"), member)).alias("plain"), F.collect_list(F.when(F.col("held"), member)).alias("held"),
        F.array_sort(F.collect_list(F.struct("character_id", "held", "hot"))).alias("cast"),
    )
    bound = F.element_at("cast", F.least(F.size("cast"), F.lit(k + 1)))["character_id"]
    return grouped.select("plain", "held", "cast", bound.alias("bound"))


def _alone(titles: DataFrame) -> DataFrame:
    """Links of small titles whose two ends share no large one, without those that can be in nobody's first ``k``.

    The members of a title travel to each of them as one array; pairs are made and counted where the character's arrays are,
    and only characters in more than ``HOT`` titles are shuffled by pairs. Who shares one title only, and is behind more than
    ``k`` members of it by id, is behind ``k`` others who share it too.
    """
    sent = titles.select("plain", "held", "bound", F.explode("cast").alias("m")).select(
        F.col("m.character_id").alias("character_id"), F.col("m.hot").alias("hot"), "bound",
        F.when(F.col("m.held"), F.col("plain")).otherwise(F.concat("plain", "held")).alias("partners"),
    )

    def counted(rows: DataFrame) -> DataFrame:
        pairs = rows.select("character_id", "bound", F.explode("partners").alias("partner_id"))
        pairs = pairs.where(F.col("character_id") != F.col("partner_id"))
        return pairs.groupBy("character_id", "partner_id").agg(
            F.count("*").alias("shared_titles"), F.max(F.col("partner_id") <= F.col("bound")).alias("early")
        )

    # a few bytes become many pairs, so the partitions are cut by pairs: merged by bytes, one would outgrow its task
    pairs = titles.agg(F.sum(F.size("cast") * F.size("cast"))).first()[0] or 0
    placed = sent.where(~F.col("hot")).select("character_id", "bound", "partners").repartition(1 + pairs // PAIRS, "character_id")
    both = counted(placed).unionByName(counted(sent.where("hot")))
    return both.where((F.col("shared_titles") > 1) | F.col("early")).drop("early")


def top_partners(appearances: DataFrame, k: int = 5, small: int = SMALL) -> DataFrame:
    """``character_id, rank, partner_id, shared_titles``: the ``k`` characters that share most titles, ties to smaller ids.

    Characters that share no title have no row. Null ids take no part, repeated appearances count once, and without rows the
    result is empty; other columns are ignored. ``small`` moves work between the two ways and never changes the result.

    Why the sets suffice: a character outside the first ``k + 1`` of all sets by shared large titles, and without a small title
    in common, is behind at least ``k`` others, whose full counts are not smaller than their counts of large titles.
    """
    known = F.col("character_id").isNotNull() & F.col("media_id").isNotNull()
    cast = handoff(appearances.where(known).select("character_id", "media_id").distinct())
    sizes = cast.groupBy("media_id").agg(F.count("*").alias("cast_size"))
    sized = cast.join(sizes, "media_id")
    few = sized.where(F.col("cast_size").between(2, small)).select("media_id", "character_id")
    large = handoff(sized.where(F.col("cast_size") > small).drop("cast_size"))
    sets = handoff(_sets(large))
    overlaps = handoff(_overlaps(large, sets))
    titles = written(_titles(few, sets, k))
    alone = _alone(titles)

    both = titles.select(F.explode("cast.character_id").alias("character_id"), "held")
    both = both.where(F.array_contains("held", F.col("character_id"))).select("character_id", F.explode("held").alias("partner_id"))
    both = both.where(F.col("character_id") != F.col("partner_id"))
    linked = both.groupBy("character_id", "partner_id").agg(F.count("*").alias("few"))
    linked = linked.join(sets, "character_id").join(
        sets.select(F.col("character_id").alias("partner_id"), *_renamed(SET, "other_")), "partner_id"
    )
    linked = linked.join(overlaps, [*SET, *[f"other_{c}" for c in SET]], "left")
    linked = linked.select("character_id", "partner_id", (F.col("few") + F.coalesce("shared", F.lit(0))).alias("shared_titles"))

    members = _first(sets, SET, k + 1, F.asc("character_id"))
    members = members.select(F.col("character_id").alias("partner_id"), *_renamed(SET, "other_"))
    order = [F.desc("shared"), F.asc("partner_id")]
    per_set = _first(overlaps.join(members, [f"other_{c}" for c in SET]), SET, k + 1, *order)
    by_set = sets.join(per_set.select(*SET, "partner_id", "shared"), SET).where(F.col("character_id") != F.col("partner_id"))
    by_set = by_set.select("character_id", "partner_id", F.col("shared").alias("shared_titles"))
    found = alone.unionByName(linked).unionByName(by_set)

    best = found.groupBy("character_id", "partner_id").agg(F.max("shared_titles").alias("shared_titles"))
    ranked = _first(best, ["character_id"], k, F.desc("shared_titles"), F.asc("partner_id"))
    return ranked.select("character_id", "rank", "partner_id", "shared_titles")
