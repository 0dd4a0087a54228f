"""Source mixing: targets, words taken, positions, copies."""

import math
import re
from collections import defaultdict

import check_oracle
import pytest
from pyspark.sql import functions as F
from reelweave.llm import mixture
from reelweave.llm.queries import ORACLES, QUERIES


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Shares by weight, the excess over the limit reshared by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        dealt = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if dealt[s] > epochs * sizes[s]}
        if not above:
            return target | dealt
        target |= {s: epochs * sizes[s] for s in above}
        free -= above
    return target


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 1000, "c": 50, "d": 3, None: 7}, {"a": 1}, {"a": 0, "b": 0}, {"x": 500, "y": 500, "z": 500, "zz": 1}]
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source STRING, size BIGINT, one INT")
    found = {r.source: r.target for r in mixture.source_targets(rows, mixture.WEIGHTS, 1.5, 2).collect()}
    want = plain_targets(sizes)
    assert found.keys() == want.keys() and all(math.isclose(found[s], want[s], abs_tol=1e-9) for s in want)


def test_positions_invert_the_integral(spark):
    knots = ((0.0, 2.0), (0.25, 0.0), (0.75, 3.0), (1.0, 1.0))
    *segments, (_, _, _, total) = mixture.integral(knots)
    rows = spark.range(0, 101).select((F.col("id") / 100).alias("f"), F.lit(0).alias("k"))
    for r in rows.withColumn("t", mixture.position_at(F.col("f"), F.col("k"), [knots])).collect():
        t, w, slope, before = [s for s in segments if s[0] <= r.t][-1]
        assert abs(before + w * (r.t - t) + slope * (r.t - t) ** 2 / 2 - r.f * total) < 1e-9
    with pytest.raises(ValueError):
        mixture.integral(((0.0, 1.0), (0.0, 2.0)))


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert check_oracle.compare(spark, check_oracle.connect(folder), folder, "op5_mix_sources") == ""
    assert "op5_mix_sources" in QUERIES.keys() & ORACLES.keys()


def test_sums_meet_targets_in_any_number_of_ranges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = {r.doc_id: tuple(r) for r in mixture.plan_mix(docs).collect()}
    assert one == {r.doc_id: tuple(r) for r in mixture.plan_mix(docs.repartition(7), rows_per_range=3).collect()}
    taken, target = defaultdict(int), {}
    for r in mixture.plan_mix(docs).collect():
        assert 0 <= r.taken <= 2 * r["size"]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs.where(F.col("doc_id") == r.doc_id).first().text)) if r.doc_id < 3 else True
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 1 for s in target)


def test_odd_rows(table, values):
    rows = table(
        "doc_id BIGINT, text STRING, source STRING, target STRING, size STRING",
        (1, "a b", "s", "x", "x"), (1, "a b", "s", "x", "x"), (2, None, "s", "x", "x"), (3, " \t\x0b", None, "x", "x"),
        (None, "w w w", None, "x", "x"), (4, "", "t", "x", "x"), (1, "c", "s", "x", "x"),
    )
    found = mixture.plan_mix(rows)
    assert found.agg(F.sum("taken")).first()[0] == sum(math.floor(t) for t in plain_targets({"s": 5, "t": 0, None: 3}).values())
    assert values(found.where("doc_id = 2"), "size", "source_size", "taken", "position_1") == [(0, 5, 0, None)]
    assert found.count() == 7 and mixture.plan_mix(rows.limit(0)).count() == 0
    mixed = mixture.mixed_documents(rows)
    assert mixed.columns == rows.columns and mixture.mixed_documents(rows.limit(0)).count() == 0
    words = F.sum(F.size(F.regexp_extract_all("text", F.lit(f"({mixture.WORD})"))))
    assert mixed.agg(words).first()[0] == found.agg(F.sum("taken")).first()[0]


def test_documents_come_in_training_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = {r.doc_id: r for r in mixture.plan_mix(docs).collect()}
    copies = [r.doc_id for r in mixture.mixed_documents(docs).collect()]
    want = sorted((p, r.doc_id) for r in plan.values() for p in (r.position_1, r.position_2) if p is not None)
    assert copies == [d for _, d in want]


def test_plan_is_native_and_spread(spark):
    plan = mixture.plan_mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop"):
        assert operator not in plan
