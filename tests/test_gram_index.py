"""The gram index against a scan."""

import random

import pytest
from pyspark.sql import functions as F

from reelweave.operators import gram_index as gi

COLUMNS = ["name", "actor"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aAbBcÉé ß%_") for _ in range(rng.randint(0, 9)))
    made = [(k, word(), None if k % 7 == 0 else word()) for k in range(300)]
    return made + [(301, None, None), (302, "", "ab"), (None, "aaa", "aaa"), (303, "100% sure_thing", "x"), (303, "other", "y")]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    gi.build_index(spark.createDataFrame(rows, "id BIGINT, name STRING, actor STRING"), "id", COLUMNS, path, 8)
    return path


def plain(rows, wanted):
    return sorted(((k, n, a) for k, n, a in rows if k is not None and any(wanted.lower() in (t or "").lower() for t in (n, a) if t is not None)), key=str)


def test_same_rows_as_a_scan(spark, rows, index):
    rng = random.Random(5)
    texts = [t for _, n, a in rows for t in (n, a) if t]
    wanted = ["", "a", "ab", "zzz", "100%", "e_th", "E_TH", "sure_thing", "nowhere to be found", "100% sure_thing!"]
    for size in (1, 2, 3, 4, 5, 8):
        for _ in range(3):
            text = rng.choice([t for t in texts if len(t) >= size])
            at = rng.randint(0, len(text) - size)
            wanted.append(text[at : at + size].swapcase() if "ß" not in text else text[at : at + size])
    for text in wanted:
        found = [tuple(r) for r in gi.search(spark, index, COLUMNS, text, 8).collect()]
        assert sorted(found, key=str) == plain(rows, text), text


def test_only_the_buckets_of_the_grams_are_read(spark, index, tmp_path):
    plan = gi.search(spark, index, COLUMNS, "sure_thing", 8)._jdf.queryExecution().executedPlan().toString()
    assert "gram_bucket" in plan.split("PartitionFilters: [")[1] or "key_bucket" in plan.split("PartitionFilters: [")[1]
    assert plan.count("PartitionFilters: []") == 0
    assert "In(gram" in plan


def test_postings_of_a_frequent_gram_are_split(spark, tmp_path):
    path = str(tmp_path / "hot")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        many = spark.range(40_000).select("id", F.concat(F.lit("the "), F.col("id")).alias("name"))
        gi.build_index(many, "id", ["name"], path, 4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = spark.read.parquet(f"{path}/postings").where("gram = 'the'").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in hot) == 40_000 and len(hot) > 1
    assert [r.key for r in gi.search(spark, path, ["name"], "THE 39999", 4).collect()] == [39999]


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    gi.build_index(spark.createDataFrame([], "id BIGINT, name STRING"), "id", ["name"], path, 4)
