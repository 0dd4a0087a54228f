"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from reelweave.llm import spelling
from reelweave.llm.queries import QUERIES


def plain_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_near(words):
    """All near words by comparing words that share a text with one letter dropped or replaced by a mark."""
    lists = defaultdict(set)
    for w in words:
        lists[w].add(w)
        for k in range(len(w)):
            lists[w[:k] + w[k + 1 :]].add(w)
            lists[w[:k] + "*" + w[k + 1 :]].add(w)
    return {w: {v for k in range(len(w)) for t in (w, w[:k] + w[k + 1 :], w[:k] + "*" + w[k + 1 :]) for v in lists[t] if one_edit(v, w)} for w in words}


def plain(rows):
    words = plain_words(rows)
    near = plain_near(words)
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return out


def test_near_words_against_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    words = {"aaaaaaa", "aaaaaaaa", "aaaaaab", "bbbbbbb", "ÿÿÿÿÿÿÿ", "×÷àéîõü"}
    while len(words) < 500:
        w = list(rng.choice(sorted(words)))
        k = rng.randrange(len(w))
        w[k : k + 1] = rng.choice(["", "", "ab", "é", "b", "ca", "x" + w[k]])
        if len("".join(w)) >= 7:
            words.add("".join(w))
    frame = spark.createDataFrame([(w, 2) for w in sorted(words)], "word STRING, n BIGINT")
    want = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(want) > 500
    for groups, short in ((3, 48), (5, 48), (5, 0)):
        monkeypatch.setattr(spelling, "SHORT", short)
        found = [(r.word, r.near) for r in spelling.near_words(frame, groups).collect()]
        assert len(found) == len(set(found)) and set(found) == want


def test_query_against_a_plain_loop(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = [tuple(r) for r in QUERIES["op12_spelling_variants"](spark, folder).collect()]
    want = plain(rows)
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(r[1] is not None for r in want) > 5


def test_chains_ties_and_odd_rows(table, values):
    base = "window" + "s"
    texts = [
        (1, "abcdefgh " * 3000), (2, "abcdefghi " * 250), (3, "abcdefghij " * 22), (4, "Abcdefghijk abcdefghijK"), (None, None), (5, ""),
        (6, f"{base}x " * 30 + f"{base}y " * 30 + f"{base}z " * 3), (6, "1234567 ab cd"), (7, "ÀÉÎÕÜßÿ " * 20 + "àÉÎÕÜßÿ " * 2), (None, "nullness " * 40),
        (8, "q" * 1000 + " " + "q" * 1000), (9, "q" * 1000), (9, "q" * 1000),
    ]
    rows = table("doc_id BIGINT, text STRING, word STRING, n INT, key STRING", *[(i, t, "x", 1, "k") for i, t in texts])
    found = values(spelling.spelling_variants(rows))
    assert found == sorted(plain(texts), key=lambda r: tuple((v is None, str(v)) for v in r))
    by_word = {r[0]: r for r in found}
    assert by_word["abcdefghijk"][2] == "abcdefgh" and by_word["windowsz"][1] == "windowsx"
    assert spelling.spelling_variants(rows.limit(0)).count() == 0
    assert spelling.spelling_variants(rows.where(F.col("text") == "")).count() == 0


def test_very_long_runs(table, values):
    long = "qwertyuiopß" * 30_000
    rows = table("doc_id BIGINT, text STRING", (1, f"{long} {long} {long}x {long}x"))
    found = values(spelling.spelling_variants(rows).selectExpr("length(word)", "form", "n", "n_near"))
    assert found == [(330_000, None, 2, 1), (330_001, None, 2, 1)]


def test_plan_has_no_python_and_joins_by_signature(spark):
    words = spark.createDataFrame([("abcdefg", 2)], "word STRING, n BIGINT")
    signed = spelling.signatures(words, ["abc", "de", "fg", "", ""])
    assert signed.count() == 20
    assert "Python" not in signed._jdf.queryExecution().toString()
