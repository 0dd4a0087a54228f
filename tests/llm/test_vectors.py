"""Nearest vectors and embedding groups against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from reelweave.llm import embed_dedup, vptree
from reelweave.llm.queries import QUERIES
from reelweave.llm.vectors import cosines

NAN, INF = float("nan"), float("inf")


def plain_nearest(ids, rows, queries, k=5):
    out = {}
    for q in queries:
        at = ids.index(q)
        score = cosines(np.repeat(rows[at : at + 1], len(ids), axis=0), rows)
        order = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)[:k]
        out[q] = [(r, i, -s) for r, (s, i) in enumerate(order, 1)]
    return out


def frame(spark, ids, rows, labels=None):
    data = [(i, [float(x) for x in v], None if labels is None else labels[n]) for n, (i, v) in enumerate(zip(ids, rows, strict=True))]
    return spark.createDataFrame(data, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")


def found_by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_factor_one_is_exact(spark, clustered):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(900, 8))
    if clustered:
        rows = rng.normal(size=(30, 8))[rng.integers(0, 30, 900)] + 0.05 * rows
    rows[100:180] = rows[100]  # ties
    rows[200:210] = rows[100] * 3
    ids = rng.permutation(5000)[:900].tolist()
    vectors = frame(spark, ids, rows)
    queries = [i for i in ids if i % 7 == 0]
    index = vptree.build_index(vectors, shard_rows=200, leaf_rows=16)
    found = found_by_query(vptree.nearest(index, vectors.where("vec_id % 7 = 0"), factor=1.0, block_queries=50))
    want = plain_nearest(ids, rows, queries)
    assert found.keys() == want.keys()
    for q in queries:
        assert [r[:2] for r in found[q]] == [r[:2] for r in want[q]] or np.allclose([r[2] for r in found[q]], [r[2] for r in want[q]], atol=1e-12)
        assert np.allclose([r[2] for r in found[q]], [r[2] for r in want[q]], atol=1e-12, rtol=0)


def test_pruning_leaves_out_more_with_a_larger_factor():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(40, 6))[rng.integers(0, 40, 2000)] + 0.1 * rng.normal(size=(2000, 6))
    looked = {}
    for factor in (1.0, 3.0, 20.0):
        tree = vptree.VantageTree(rows, [np.array([k]) for k in range(2000)], 32)
        tree.search(rows[:100], np.arange(100), 5, factor)
        looked[factor] = sum(len(i) for i, _, _ in tree.found)
        visits = []
        tree._look_before = tree._look
        tree._look = lambda r, a: (visits.append(len(r) * len(a)), tree._look_before(r, a))  # noqa: B023
        tree.search(rows[:100], np.arange(100), 5, factor)
        looked[factor] = sum(visits)
    assert looked[20.0] < looked[3.0] < looked[1.0] < 100 * 2000


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, matrix = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64)
    found = found_by_query(QUERIES["op1_nearest_vectors"](spark, folder))
    want = plain_nearest(ids, matrix, [i for i in ids if i % 50 == 0])
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert found.keys() == want.keys() and hits >= 0.9 * 5 * len(want)


def test_nearest_odd_rows(spark):
    ids = [0, 50, 51, 52, 53, 54, 55, 56, 57, None, 58, 58, 59]
    vectors = [
        [1, 0], [0, 1], None, [0, 0], [NAN, 1], [INF, 1], [1, 1e200], [], [1, 2, 3], [1, 0], [2, 0], [0, 5], [1e-300, 0],
    ]
    data = [(i, v if v is None else [float(x) for x in v], "x") for i, v in zip(ids, vectors, strict=True)]
    data.append((60, [1.0, None], "x"))
    table = spark.createDataFrame(data, "vec_id BIGINT, embedding ARRAY<DOUBLE>, shard STRING")
    index = vptree.build_index(table)
    found = found_by_query(vptree.nearest(index, table.where("vec_id % 50 = 0"), k=3))
    assert [r[:2] for r in found[0]] == [(1, 58), (2, 59), (3, 55)]
    assert [r[:2] for r in found[50]] == [(1, 55), (2, 58), (3, 0)]
    assert vptree.nearest(index, table.limit(0)).count() == 0
    assert vptree.nearest(vptree.build_index(table.limit(0)), table).count() == 0


def plain_groups(ids, rows, labels, limit=0.93):
    usable = [n for n, v in enumerate(rows) if np.isfinite(v).all() and np.any(v) and labels[n] is not None]
    links, parent = {i: 0 for i in ids}, {i: i for i in ids}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x, a in enumerate(usable):
        for b in usable[x + 1 :]:
            if labels[a] == labels[b] and cosines(rows[a : a + 1], rows[b : b + 1])[0] >= limit:
                links[ids[a]] += 1
                links[ids[b]] += 1
                low, high = sorted((find(ids[a]), find(ids[b])))
                parent[high] = low
    return {i: (links[i], find(i), find(i) == i) for i in ids}


def test_groups_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(12, 6))[rng.integers(0, 12, 260)] + 0.35 * rng.normal(size=(260, 6))
    rows[40:60] = rows[40]
    rows[7] = 0
    rows[8, 2] = NAN
    ids = rng.permutation(4000)[:260].tolist()
    labels = [None if k % 17 == 0 else int(k % 3) for k in range(260)]
    table = frame(spark, ids, rows, labels)
    want = plain_groups(ids, rows, labels)
    assert len({c for _, c, _ in want.values()}) < 250
    for options in ({}, {"cell_rows": 10, "block": 8, "sample": 30}):
        found = embed_dedup.near_duplicate_vectors(table, **options).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == want and len(found) == 260


def test_border_of_the_limit(spark):
    """Cosines at the limit link, those just below do not."""
    rows = np.array([[1.0, 0.0], [0.93, np.sqrt(1 - 0.93**2)], [0.9299999, np.sqrt(1 - 0.9299999**2)]])
    assert cosines(rows[:1], rows[1:2])[0] >= 0.93
    table = frame(spark, [1, 2, 3], np.array([rows[0], rows[1], -rows[2]]), [1, 1, 1])
    found = {r.vec_id: r.n_links for r in embed_dedup.near_duplicate_vectors(table).collect()}
    assert found == {1: 1, 2: 1, 3: 0}


def test_groups_odd_rows(spark, values):
    data = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [1.0, None], 1),
        (7, [1.0, 0.0, 0.0], 1), (8, [INF, 0.0], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0], 2),
    ]
    table = spark.createDataFrame(data, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT").withColumn("node", F.lit("x"))
    found = values(embed_dedup.near_duplicate_vectors(table))
    assert found == [
        (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
        (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (None, 0, None, True),
    ]
    assert embed_dedup.near_duplicate_vectors(table.limit(0)).count() == 0


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = plain_groups([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64), [r.label for r in rows])
    found = QUERIES["op4_embedding_groups"](spark, folder).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == want


def test_parallel_vectors_are_found_like_any_other(spark):
    rng = np.random.default_rng(9)
    rows = np.repeat(rng.normal(size=(40, 16)), 30, axis=0) * rng.uniform(0.1, 9, size=(1200, 1))
    ids = rng.permutation(4000)[:1200].tolist()
    vectors = frame(spark, ids, rows)
    queries = [i for i in ids if i % 11 == 0]
    index = vptree.build_index(vectors, shard_rows=400, leaf_rows=16)
    want = plain_nearest(ids, rows, queries)
    for factor in (1.0, 4.0):
        found = found_by_query(vptree.nearest(index, vectors.where("vec_id % 11 = 0"), factor=factor))
        assert {q: [r[1:] for r in found[q]] for q in queries} == {q: [r[1:] for r in want[q]] for q in queries}
    with pytest.raises(Exception, match="up to 5 neighbours"):
        vptree.nearest(index, vectors, k=6).collect()
