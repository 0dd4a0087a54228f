"""Toxicity: gradients, held-out accuracy, windows, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from reelweave.llm import toxicity as tx
from reelweave.llm.queries import QUERIES


def test_gradients():
    rng = np.random.default_rng(0)
    net = tx.Network({"ab": 1, "cd": 2}, np.array([0.5, -0.3]))
    words, index = ["", "ab", "cd", "xyz"], rng.integers(0, 4, (6, 5))
    padded, labels = np.zeros((6, 5), bool), np.array([1, 0, 1, 0, 1.0])
    padded[4:, 2] = True
    _, grads = net.gradients(words, index, padded, labels)
    buckets = tx.trigram_means(["ab", "cd", "xyz"], net.p["char"])[1]
    for name, values in net.p.items():
        for _ in range(8):
            at = tuple(int(rng.integers(0, s)) for s in values.shape)
            at = (int(rng.choice(buckets)), at[1]) if name == "char" else (1 + at[0] % 2, at[1]) if name == "word" else at
            kept, loss = values[at], []
            for step in (1e-5, -1e-5):
                values[at] = kept + step
                loss.append(net.gradients(words, index, padded, labels)[0])
            values[at] = kept
            assert abs((loss[0] - loss[1]) / 2e-5 - grads[name][at]) < 1e-8


def network(size=60):
    plain = "the of and to in that it was for on with as".split()
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for k in range(size):
        words = rng.choice(plain, 80).tolist()
        if k % 3 == 0:
            words[rng.integers(0, 80)] = rng.choice(["Blockhead!", "nitwit,"])
        texts.append(" ".join(words))
        labels.append(int(k % 3 == 0))
    return tx.train(texts, labels)


@pytest.fixture(scope="module")
def small():
    return network()


def test_all_windows_count(small):
    scorer = tx.Scorer(small)
    for words in (1, 31, 32, 33, 47, 48, 49, 64, 500):
        for at in range(0, words, max(1, words // 40)):
            text = ["the"] * words
            text[at] = "nitwit"
            index, owner = scorer.windows([" ".join(text)])
            assert (index == scorer.rows["nitwit"]).any() and len(owner) == max(1, -(-(words - 32) // 16) + 1)
    toxic = scorer.scores(["the of " * 300 + "nitwit " + "in that " * 5000, "the of " * 300])
    assert toxic[0] > 0.5 > toxic[1]


def test_batches_and_caches_change_nothing(small, monkeypatch):
    texts = ["the nitwit of", "", "to in " * 50, "ein Blockhead", "... !!!", "of"]
    whole = tx.Scorer(small).scores(texts)
    monkeypatch.setattr(tx, "CACHE_WORDS", 3)
    scorer = tx.Scorer(small)
    for _ in range(2):
        assert np.allclose([scorer.scores([t])[0] for t in texts], whole, atol=1e-6)
    assert whole[1] == 0 and network(60).p["out"].tolist() == small.p["out"].tolist()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op3_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = [r.predicted == r.toxic for r in held]
    assert np.mean(right) > 0.93
    found = [r for r in held if r.toxic and r.predicted]
    assert len(found) >= 0.6 * sum(r.toxic for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_training_rows_are_never_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.select(F.col("doc_id"), F.lit(1).alias("toxic")).where(tx.held_out(F.col("doc_id")))
    assert held.count() and tx.training_rows(docs, held) == ([], [])


def test_odd_rows(spark, table, values):
    docs = table("doc_id BIGINT, text STRING, score STRING", (1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a", "x"), (3, "w" * 50_000, "x"))
    labels = table("doc_id BIGINT, toxic INT", (1, 1), (2, None), (None, 1), (3, 0), (3, 1))
    found = tx.classify(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 5
    assert values(found.where("doc_id = 2"), "score", "predicted") == [(0.0, 0), (0.0, 0)]
    assert tx.classify(docs.limit(0), labels).count() == 0 and tx.classify(docs, labels.limit(0)).count() == 5
    assert tx.keep_clean(docs, labels.limit(0)).columns == docs.columns


def test_the_sample_is_bounded_and_in_hash_order(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    labels = ids.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    docs = ids.select("doc_id", F.concat(F.lit("text "), "doc_id").alias("text"))
    sample = tx.Sample(20, 30, 100, 10_000)
    texts, marks = tx.training_rows(docs, labels, sample=sample)
    rows = ids.where(~tx.held_out(F.col("doc_id"))).select("doc_id", F.xxhash64("doc_id").alias("at")).orderBy("at", "doc_id").collect()
    toxic = [r.doc_id for r in rows if r.doc_id % 3 == 0][:20]
    clean = [r.doc_id for r in rows if r.doc_id % 3][:30]
    want = [r.doc_id for r in rows if r.doc_id in {*toxic, *clean}]
    assert texts == [f"text {k}" for k in want] and marks == [int(k % 3 == 0) for k in want]
    # one id many times is one text, and the bytes of all texts are bounded
    many = spark.range(2000).select(F.lit(toxic[0]).alias("doc_id"), F.concat(F.lit("copy "), "id").alias("text"))
    assert tx.training_rows(many, labels, sample=sample) == (["copy 0"], [1])
    assert len(tx.training_rows(docs, labels, sample=tx.Sample(20, 30, 100, 90))[0]) < 12


def plain_score(net, text):
    """The score of a text, one window, word and step at a time."""
    words = [w.lower().strip(tx.EDGES) for w in text.split()]
    if not words:
        return 0.0

    def vector(word):
        if not word:
            return net.p["blank"][0]
        letters, rows = f"<{word}>".encode(), []
        for a, b, c in zip(letters, letters[1:], letters[2:]):  # noqa: B905
            h = (a * 0x9E3779B1 & 0xFFFFFFFF) ^ (b * 0x85EBCA6B & 0xFFFFFFFF) ^ (c * 0xC2B2AE35 & 0xFFFFFFFF)
            rows.append(net.p["char"][((h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 20])
        return net.p["word"][net.vocabulary.get(word, 0)] + sum(rows) / len(rows)

    def states(window, way):
        h, out = np.zeros(tx.UNITS), []
        for word in window:
            x, g = vector(word) @ net.p[f"in_{way}"] + net.p[f"bias_{way}"], h @ net.p[f"re_{way}"]
            keep, reset = (1 / (1 + np.exp(-(x[k : k + tx.UNITS] + g[k : k + tx.UNITS]))) for k in (0, tx.UNITS))
            h = keep * h + (1 - keep) * np.tanh(x[2 * tx.UNITS :] + reset * g[2 * tx.UNITS :])
            out.append(h)
        return out

    starts = [0] if len(words) <= 32 else sorted({*range(0, len(words) - 32, 16), len(words) - 32})
    best = 0.0
    for start in starts:
        window = words[start : start + 32]
        both = [np.concatenate(s) for s in zip(states(window, "f"), states(window[::-1], "b")[::-1], strict=True)]
        attention = np.exp([np.tanh(s @ net.p["att"]) @ net.p["pick"] for s in both])
        pooled = sum(a * s for a, s in zip(attention / attention.sum(), both, strict=True))
        best = max(best, float(1 / (1 + np.exp(-(pooled @ net.p["out"] + net.p["base"][0])))))
    return best


def test_scores_against_a_plain_loop(small):
    rng = np.random.default_rng(4)
    words = ["the", "of", "nitwit", "Blockhead!", "...", "être", "x", "in", "«to»", "unseen-word"]
    texts = ["", "nitwit", "..."] + [" ".join(rng.choice(words, n)) for n in (2, 31, 32, 33, 40, 48, 64, 65, 100)]
    assert np.allclose(tx.Scorer(small).scores(texts), [plain_score(small, t) for t in texts], atol=1e-4)
