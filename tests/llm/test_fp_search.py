"""Ranked search over document trees against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
from reelweave.llm import fp_search as fp
from reelweave.llm.queries import QUERIES

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERMS.findall(text or "")]


def plain(docs, items, most=10):
    """Rows (item, rank, key, score) by scoring every document for every item."""
    vectors = [(key, Counter(terms_of(text))) for key, text in docs]
    documents = sum(bool(v) for _, v in vectors)
    length = sum(sum(v.values()) for _, v in vectors)
    frequency = Counter(t for _, v in vectors for t in v)
    out = []
    for item, text in items:
        found = []
        for key, v in vectors:
            m = 100 - 90 + (90 * sum(v.values()) * documents) // length if v else 0
            score = 0
            for t in set(terms_of(text)) & set(v):
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency[t] + 1)))
                score += w * ((10**9 * v[t]) // (1000 * v[t] + 8 * m))
            if score > 0:
                found.append((-score, key is None, key if key is not None else 0, key))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:most], 1)]
    return out


def test_terms():
    texts = ["", "A-b_c9É é\x7f\u0080Ñ", "İK ß漢字😀x", None, "\x00a\x0bb"]
    for text in texts:
        assert [t.decode() for part in fp.parts_of_terms(text) for t in part] == terms_of(text)
    long = "ab, " * 700_000
    assert sum(map(len, fp.parts_of_terms(long))) == 700_000
    assert [len(p) for p in fp.parts_of_terms("x" * 3_000_000)] == [1]


def test_tree_finds_what_scoring_all_finds():
    rng = np.random.default_rng(3)
    for leaf, size in ((1, 60), (4, 300), (32, 900)):
        rows = [np.sort(rng.choice(40, rng.integers(0, 12), replace=False, p=(p := 1 / np.arange(1, 41)) / p.sum())) for _ in range(size)]
        rows += rows[:50] + [rows[0]] * 70
        sizes = np.array([len(r) for r in rows])
        ranks = np.concatenate(rows)
        counts, m = rng.integers(1, 9, len(ranks)), rng.integers(10, 300, len(rows))
        tree = fp.DocumentTree(sizes, ranks, counts, m, 40, leaf)
        covered = sorted(k for (a, b), (x, y) in zip(tree.spans, tree.children, strict=True) if x == y for k in range(a, b))
        assert covered == list(range(len(rows)))
        ends = np.cumsum(sizes)
        less = 0
        for _ in range(40):
            asked = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
            weights = rng.integers(0, 5000, len(asked))
            scores = []
            for k, r in enumerate(rows):
                has = dict(zip(r.tolist(), counts[ends[k] - sizes[k] : ends[k]].tolist(), strict=True))
                scores.append(sum(int(w) * ((10**9 * has[q]) // (1000 * has[q] + 8 * int(m[k]))) for q, w in zip(asked.tolist(), weights.tolist(), strict=True) if q in has))
            best = fp.Best(5)
            best.keys = list(range(len(rows)))
            less += tree.search(asked, weights, best) < len(rows)
            want = sorted(((-s, k) for k, s in enumerate(scores) if s > 0))[:5]
            assert sorted((-h.score, h.key) for h in best.heap) == want
        assert less > 10  # the bounds do leave out documents


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = [tuple(r) for r in QUERIES["op13_ranked_search"](spark, folder).collect()]
    assert sorted(found) == sorted(plain(docs, items))


def test_blocks_trees_and_odd_rows(table, values, monkeypatch):
    rng = random.Random(6)
    words = ["the", "The", "of", "über", "x1", "漢字", "rare", "q"]
    docs = [(k, " ".join(rng.choices(words[:6], k=rng.randint(0, 9)))) for k in range(60)]
    docs += [(70, "rare q"), (70, "rare q"), (None, "rare q"), (None, "rare"), (71, None), (72, ""), (73, "?!"), (5, "q " * 90_000), (-1, "rare q")]
    items = [("a", "the rare q"), ("b", None), ("c", ""), ("a", "the rare q"), (None, "of über"), ("d", "absent"), ("e", "x1-X1 漢字"), ("f", "The the THE")]
    rows = table("doc_id BIGINT, text STRING, q INT, n INT, key STRING, item_id STRING", *[(k, t, 1, 2, "k", "i") for k, t in docs])
    asked = table("item_id STRING, text STRING, rank INT, doc_id INT, key INT", *[(k, t, 1, 2, 3) for k, t in items])
    want = sorted(plain(docs, items), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert values(fp.search(rows, asked)) == want
    for name, value in (("TREE_DOCUMENTS", 16), ("BLOCK_ITEMS", 3), ("LEAF", 2), ("BLOCK_TERMS", 1), ("PART", 2)):
        monkeypatch.setattr(fp, name, value)
    assert values(fp.search(rows, asked)) == want
    assert fp.search(rows.limit(0), asked).count() == 0
    assert fp.search(rows, asked.limit(0)).count() == 0
    assert fp.search(rows.where("text = ''"), asked).count() == 0
    assert fp.search(rows, asked.where("item_id = 'd'")).count() == 0
