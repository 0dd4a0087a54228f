"""Joins of bucketed tables: no exchange below them, and the rows of the plain tables."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from reelweave.plans import boxoffice
from reelweave.plans.tables import Tables
from reelweave.session import fresh_folder
from reelweave.sinks.buckets import write_bucketed

LAYOUT = {"media": "id", "films": "media_id", "box_office_total": "film_id"}


@pytest.fixture(scope="module")
def plain(spark):
    n = F.col("id")

    def table(name):
        return {
            "media": spark.range(500).select(n, F.concat(F.lit("t"), n).alias("title"), (n % 60 + 1950).cast("int").alias("year")),
            "films": spark.range(0, 500, 2).select(n, n.alias("media_id"), (n % 7).alias("studio_id"), F.lit("hybrid").alias("animation_type")),
            "studios": spark.range(7).select(n, F.concat(F.lit("s"), n).alias("name"), F.lit("active").alias("status")),
            "box_office_total": spark.range(0, 500, 4).select(
                n.alias("film_id"), n.cast("decimal(24,2)").alias("total_revenue"), n.cast("decimal(24,2)").alias("opening_week_revenue"),
                F.lit(3).alias("weeks_in_release")),
        }[name]

    return Tables(table)


@pytest.fixture
def bucketed(spark, plain):
    name = f"layout_{uuid.uuid4().hex}"
    yield write_bucketed(spark, plain, fresh_folder(spark, "buckets"), name, LAYOUT, 4)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_films_meet_media_without_an_exchange(plain, bucketed, no_broadcast):
    def joined(t):
        return t.films.join(t.media.withColumnRenamed("id", "media_id"), "media_id")

    assert len(exchanges(joined(plain))) == 2
    assert exchanges(joined(bucketed)) == []
    assert joined(bucketed).count() == 250


def test_revenue_by_studio_exchanges_films_once(plain, bucketed, no_broadcast):
    """Films, laid out by title, are moved to the buckets of their totals; neither titles nor totals are moved."""
    plan = boxoffice._film_revenue(bucketed)
    assert exchanges(plan) == ["film_id"]
    assert len(exchanges(boxoffice._film_revenue(plain))) > 1


def test_same_rows(plain, bucketed):
    mine = boxoffice.revenue_by_studio(bucketed).collect()
    assert sorted(map(str, mine)) == sorted(map(str, boxoffice.revenue_by_studio(plain).collect()))


def test_written_twice_and_empty(spark, plain):
    name, root = f"layout_{uuid.uuid4().hex}", fresh_folder(spark, "buckets")
    none = Tables(lambda table: getattr(plain, table).where("false"))
    write_bucketed(spark, plain, root, name, LAYOUT, 2)
    assert write_bucketed(spark, plain, root, name, LAYOUT, 2).films.count() == 250
    assert write_bucketed(spark, none, root, name, LAYOUT, 2).films.count() == 0
    spark.sql(f"DROP DATABASE {name} CASCADE")
