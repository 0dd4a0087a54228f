"""Measures shared by the aggregates: exact means, guarded ratios, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.session import handoff

MONEY = "decimal(14,2)"


def mean(col: Column | str) -> Column:
    """Average as sum over count, so that decimal input gives the same double on any number of partitions."""
    return F.sum(col).cast("double") / F.count(col)


def ratio(top: Column, bottom: Column) -> Column:
    """Division in double; null when the divisor is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    value = F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def sum_where(condition: Column, value: Column | str) -> Column:
    """Sum over the matching rows, zero when none matches."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def filtered_sum(condition: Column, value: Column | str) -> Column:
    """Sum over the matching rows, null when none matches."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, value))


def set_size(value: Column | str) -> Column:
    """Exact distinct count from a set kept for each group, for values of which a group has few, such as days or states.

    Two plain distinct counts lay every row out three times and shuffle that; sets are merged where the rows are.
    """
    return F.size(F.collect_set(value)).cast("bigint")


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def with_share(
    df: DataFrame,
    value: str,
    name: str,
    within: list[str] | None = None,
    digits: int | None = 2,
) -> DataFrame:
    """Adds each row's percentage of the total, over all rows or within the given columns.

    Meant for rows that are already aggregated. The overall total is a scalar subquery, since a window over everything
    would bring all groups into one task; the rows are written once, so that the total does not aggregate them again.
    """
    if within:
        total = F.sum(value).over(W.partitionBy(*within))
    else:
        df = handoff(df)
        total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, percent(F.col(value), total, digits))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, the type of the published tables."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
