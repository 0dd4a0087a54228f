"""Constraint checks that return the violations as rows (rule, key, rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def duplicate_keys(df: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; two nulls count as equal."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
    return counted.select(F.lit(rule).alias("rule"), _key(keys).alias("key"), "rows")


def colliding_ids(df: DataFrame, rule: str, column: str, natural_key: list[str]) -> DataFrame:
    """Ids that stand for several natural keys, with their number: hashed ids must not merge two things."""
    pairs = df.filter(F.col(column).isNotNull()).select(column, *natural_key).distinct()
    counted = pairs.groupBy(column).agg(F.count("*").alias("rows")).filter("rows > 1")
    return counted.select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("key"), "rows")


def missing_values(df: DataFrame, rule: str, column: str, keys: list[str]) -> DataFrame:
    bad = df.filter(F.col(column).isNull())
    return bad.groupBy(_key(keys).alias("key")).agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), "key", "rows")


def orphans(df: DataFrame, rule: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent row; counted before the join, so a hot key is one row."""
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    lost = used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
    return lost.select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("key"), "rows")


def not_allowed(df: DataFrame, rule: str, column: str, allowed: list[str]) -> DataFrame:
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(allowed))
    counted = bad.groupBy(F.col(column).cast("string").alias("key")).agg(F.count("*").alias("rows"))
    return counted.select(F.lit(rule).alias("rule"), "key", "rows")


def violations(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def contract_violations(df: DataFrame, contract: dict, keys: list[str]) -> DataFrame:
    """Checks a record contract: required columns and closed value sets."""
    checks = [missing_values(df, f"required:{c}", c, keys) for c in contract["required"]]
    checks += [not_allowed(df, f"allowed:{c}", c, values) for c, values in contract["allowed"].items()]
    return violations(*checks)


def broken_rules(contract: dict) -> Column:
    """The rules of a record contract that a row breaks, in the contract's order."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"required:{c}")) for c in contract["required"]]
    rules += [
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(values), F.lit(f"allowed:{c}"))
        for c, values in contract["allowed"].items()
    ]
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def split_by_contract(df: DataFrame, contract: dict) -> tuple[DataFrame, DataFrame]:
    """Rows that keep a record contract, and the others with the rules they break (``broken_rules``)."""
    judged = df.withColumn("broken_rules", broken_rules(contract))
    return judged.filter(F.size("broken_rules") == 0).drop("broken_rules"), judged.filter(F.size("broken_rules") > 0)
