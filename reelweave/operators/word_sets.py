"""Exact distinct counts that merge: sets of numbers as 64-bit words.

A set is rows of (word number, bits): number 130 is bit 2 of word 2. Words of equal number are merged by ``bit_or``, so the sets of
films merge into those of studios and of everything without another look at the facts, and several distinct counts share one
aggregation, which plain ``count(DISTINCT …)`` of two columns answers by laying every row out once per column.

Only words that occur are rows, so a film's week with one report costs one row of two words, where ``bitmap_construct_agg`` keeps 4 KB.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64


def set_words(df: DataFrame, keys: Collection[str], numbers: dict[str, Column]) -> DataFrame:
    """``keys`` and, for each named number, ``<name>_word`` and ``<name>_bits``; one row per combination of words that occurs.

    Partial words are made before the shuffle: a hot key sends one row per combination of words and task. Null numbers belong to
    no set; null keys are keys. Numbers may be negative; they are best dense, as each word that occurs is a row.
    """
    at = {f"{name}_word": F.shiftright(number.cast("bigint"), 6) for name, number in numbers.items()}  # 64 is 2 ** 6
    one = F.lit(1).cast("bigint")
    bits = [
        F.bit_or(F.call_function("shiftleft", one, F.pmod(number, F.lit(WORD_BITS)).cast("int"))).alias(f"{name}_bits")
        for name, number in numbers.items()
    ]
    return df.withColumns(at).groupBy(*keys, *at).agg(*bits)


def merged_counts(words: DataFrame, keys: Collection[str], counts: dict[str, str]) -> DataFrame:
    """``keys`` and for each output name the size of the named set, over all words of a key. Without rows there are no keys,
    but for the one row of an empty list of ``keys``."""

    def stood(place: int, name: str) -> Column:
        return F.struct(F.lit(place).alias("_set"), F.col(f"{name}_word").alias("word"), F.col(f"{name}_bits").alias("bits"))

    # the sets below each other, so that all are merged in one aggregation and no results are joined
    below = words.select(*keys, F.inline(F.array(*[stood(k, name) for k, name in enumerate(counts.values())])))
    merged = below.groupBy(*keys, "_set", "word").agg(F.bit_or("bits").alias("bits"))
    sizes = [F.sum(F.when(F.col("_set") == k, F.bit_count("bits"))) for k in range(len(counts))]
    return merged.groupBy(*keys).agg(
        *[F.coalesce(size, F.lit(0)).cast("bigint").alias(output) for size, output in zip(sizes, counts, strict=True)]
    )
