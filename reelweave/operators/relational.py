"""Filters, top-k, ranking, shares, lists and joins that several plans use."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.functions.text import contains_any_case
from reelweave.operators.keys import first_per_key
from reelweave.session import sorting


def point_lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def rows_of(df: DataFrame, foreign_key: str, value: object, *order: Column) -> DataFrame:
    return df.filter(F.col(foreign_key) == F.lit(value)).orderBy(*order)


def search(df: DataFrame, columns: list[str], query: str, order: list, limit: int = 100) -> DataFrame:
    """Substring search over several columns; an empty query returns the first rows of all."""
    hits = df.filter(contains_any_case([F.col(c) for c in columns], query)) if query else df
    return hits.orderBy(*order).limit(limit)


def facet_filter(df: DataFrame, search_column: str, query: str = "", **facets: str) -> DataFrame:
    """Text search plus equality facets; the facet value ``all`` switches a facet off."""
    rows = df.filter(contains_any_case([F.col(search_column)], query)) if query else df
    return reduce(
        lambda d, facet: d if facet[1] == "all" else d.filter(F.col(facet[0]) == facet[1]), facets.items(), rows
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The order must end in a unique column, so that ties are cut the same way every time."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: list[str], order: Column, k: int, rank_name: str = "rank") -> DataFrame:
    """Rows with rank <= k inside their group, ties included. Ranks are limited before the shuffle too."""
    rank = F.rank().over(W.partitionBy(*group).orderBy(order))
    return df.withColumn(rank_name, rank).filter(F.col(rank_name) <= k)


def distinct_list(df: DataFrame, group: list[str], value: str, name: str, separator: str = ", ") -> DataFrame:
    """Distinct values of each group as one sorted text. Pairs are made distinct before they are collected."""
    pairs = df.select(*group, value).filter(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(*group).agg(F.concat_ws(separator, F.sort_array(F.collect_list(value))).alias(name))


def lookup_left(df: DataFrame, dimension: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Left join on ``df[key] = dimension.id`` bringing in renamed columns."""
    picked = dimension.select(F.col("id").alias(key), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(picked, key, "left")


def lookup_inner(df: DataFrame, dimension: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    picked = dimension.select(F.col("id").alias(key), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(picked, key)


def composite_lookup(
    df: DataFrame,
    other: DataFrame,
    on: dict[str, str],
    columns: dict[str, str],
    how: str = "left",
    any_case: Collection[str] = (),
    large: bool = False,
) -> DataFrame:
    """Join on several columns of different names; null keys never match. Columns in ``any_case`` ignore letter case.

    Neither side of a ``large`` lookup is broadcast (``sorting``); its keys should not repeat often.
    """
    picked = other.select(
        *[(F.lower(theirs) if ours in any_case else F.col(theirs)).alias(f"_on_{theirs}") for ours, theirs in on.items()],
        *[F.col(c).alias(n) for c, n in columns.items()],
    )
    pairs = [(F.lower(ours) if ours in any_case else F.col(ours), F.col(f"_on_{theirs}")) for ours, theirs in on.items()]
    condition = reduce(lambda a, b: a & b, [ours == theirs for ours, theirs in pairs])
    return df.join(sorting(picked) if large else picked, condition, how).drop(*[f"_on_{theirs}" for theirs in on.values()])


def with_child_count(parent: DataFrame, child: DataFrame, foreign_key: str, name: str) -> DataFrame:
    """Number of child rows per parent, zero included. Children are counted before the join."""
    counts = child.groupBy(F.col(foreign_key).alias("id")).agg(F.count("*").alias(name))
    return parent.join(counts, "id", "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


def with_branch_counts(parent: DataFrame, branches: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Counts of several independent child tables; each is aggregated alone, so the branches never multiply."""
    return reduce(lambda d, b: with_child_count(d, b[1][0], b[1][1], b[0]), branches.items(), parent)


def members_of(df: DataFrame, json_array: str, dimension: DataFrame, key: str) -> DataFrame:
    """Join through an array kept as JSON text: one row per member that exists in the dimension."""
    members = df.withColumn(key, F.explode(F.from_json(json_array, "array<string>")))
    return members.join(dimension, key)


def gender_split(df: DataFrame, group: list[str], with_total: bool = False) -> DataFrame:
    """Male, female and other counts by group."""
    gender = F.col("gender")
    measures = [
        F.count_if(gender == "male").alias("male"),
        F.count_if(gender == "female").alias("female"),
        F.count_if(~F.coalesce(gender.isin("male", "female"), F.lit(False))).alias("other"),
    ]
    if with_total:
        measures.append(F.count("*").alias("total"))
    return df.groupBy(*group).agg(*measures)


def concat_extracts(*parts: DataFrame) -> DataFrame:
    """All rows of extracts with different column sets."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_first(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Set union by key: the earliest part that has a key provides its row."""
    numbered = [part.withColumn("_part", F.lit(i)) for i, part in enumerate(parts)]
    rows = concat_extracts(*numbered)
    others = [c for c in rows.columns if c not in (*keys, "_part")]
    return first_per_key(rows, keys, ["_part", *others]).drop("_part")
