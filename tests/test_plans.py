"""Properties of the physical plans that decide whether a query survives a larger input."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelweave.operators import keys
from reelweave.registry.catalogue import Catalogue

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_two_columns_and_pushes_the_filter(spark):
    films = Catalogue(spark, FOLDER).films.filter("id = 101").select("studio_id")
    text = films._jdf.queryExecution().toString()
    assert re.search(r"ReadSchema: struct<p_partkey:bigint,p_brand:string>", text)
    assert "EqualTo(p_partkey,101)" in text


def test_first_per_key_limits_before_the_shuffle(spark):
    t = Catalogue(spark, FOLDER)
    text = plan(keys.first_per_key(t.raw("lineitem"), ["l_partkey"], ["l_shipdate", "l_orderkey"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["actor_careers"](spark, FOLDER))


def test_rank_limit_is_pushed_down(spark):
    assert plan(entry.queries()["top_films_per_studio"](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_no_window_over_the_raw_fact(spark):
    t = Catalogue(spark, FOLDER)
    assert "Window" not in plan(t.box_office_daily)


def test_literal_lookups_are_broadcast_without_a_hint(spark):
    t = Catalogue(spark, FOLDER)
    roles = t.roles.select(F.col("id").alias("role_id"), "name")
    assert "BroadcastHashJoin" in plan(t.characters.join(roles, "role_id", "left"))


def test_same_result_on_any_number_of_partitions(spark):
    def rows(name):
        return sorted(map(str, entry.queries()[name](spark, FOLDER).collect()))

    names = ["revenue_by_studio", "box_office_weekly", "build_appearances", "sequel_retention", "dense_ids"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = [rows(n) for n in names]
    try:
        for partitions in ("1", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert [rows(n) for n in names] == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
