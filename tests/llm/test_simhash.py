"""SimHash fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from reelweave.llm import simhash
from reelweave.llm.common import connected_components
from reelweave.llm.queries import QUERIES


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """Smallest key of each key's component; prints: key -> fingerprint."""
    parent = {k: k for k in prints}

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def test_fingerprints_of_odd_texts():
    texts = ["", " \t\n", "One", "one two THREE", "a b c d", "a b c d e", "É É é Ä b\x0bc\x0cd", "x " * 40_000, "w" * 100_000, "a b c d e\x1ff"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {k: plain_fingerprint(t) for k, t in texts.items()}
    want = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, folder).collect()}
    assert got == {k: (f"{prints[k]:016x}", want[k]) for k in texts}
    assert any(want[k] != k for k in want)


def test_links_in_blocks_lose_nothing(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {0: 0, 1: (1 << 64) - 1, 2: 1 << 63}
    for k in range(3, 500):
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 4)):
            value ^= 1 << rng.randrange(64)
        prints[k] = value
    signed = {k: v - (1 << 64) if v >> 63 else v for k, v in prints.items()}
    frame = spark.createDataFrame([(v,) for v in sorted(set(signed.values()))], "fp BIGINT")
    names = {}
    for k, v in signed.items():
        names.setdefault(v, k)
    for block, listed in ((7, None), (100, 3), (4096, None), (4096, 4), (4096, 2)):
        links = simhash.fingerprint_links(frame, block=block, listed=listed)
        groups = {r.node: r.component for r in connected_components(links).collect()}
        found = {}
        for v in names:
            found.setdefault(groups.get(v, v), set()).add(v)
        want = plain_components({names[v]: prints[names[v]] for v in names})
        parts = {}
        for v, k in names.items():
            parts.setdefault(want[k], set()).add(v)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, parts.values()))


def test_lists_do_not_emit_pairs(spark):
    """A group of n near copies gives at most n - 1 edges per list, and each is in 56 lists; its links are n²/2."""
    frame = spark.range(1024).withColumnRenamed("id", "fp")
    assert simhash.fingerprint_links(frame).count() < 56 * 1024


def test_lists_are_not_broadcast(spark):
    """A fingerprint is in 56 lists, which the planner takes for as small as the fingerprints alone."""
    frame = spark.range(1024).withColumnRenamed("id", "fp")
    assert "Broadcast" not in simhash.fingerprint_links(frame)._jdf.queryExecution().executedPlan().toString()


def test_the_tally_rejects_pairs_of_a_list():
    """A pair in a list of three positions is rejected for its shared bytes alone, before any bit is counted."""
    prints = np.array([0, 0x0101010101 << 24, 0x01010101 << 32, 0xFF01 << 48, 1 << 63], np.uint64)
    shared = [sum((int(p) >> 8 * k) & 0xFF == 0 for k in range(8)) for p in prints]
    for minimum in (3, 4, 5):
        found = simhash.near_pairs(prints[:1, None], prints[None, :], minimum, 64)[0]
        assert found.tolist() == [n >= minimum for n in shared]
    assert shared[1] == 3 and not simhash.near_pairs(prints[0], prints[1:2], 4, 64)[0]
    assert simhash.near_pairs(prints[0], prints, 4, 4).tolist() == [True, False, True, False, True]


def test_links_of_other_widths(spark, table, values):
    frame = table("fp BIGINT", (0,), (1,), (3,), (255,), (-1,))
    assert values(connected_components(simhash.fingerprint_links(frame, max_bits=1))) == [(0, 0), (1, 0), (3, 0)]
    assert connected_components(simhash.fingerprint_links(frame, max_bits=7)).count() == 4
    with pytest.raises(ValueError):
        simhash.fingerprint_links(frame, listed=5)
    with pytest.raises(ValueError):
        simhash.fingerprint_links(frame, max_bits=8)


def test_frames(table, values):
    rows = table(
        "doc_id BIGINT, text STRING, fp STRING, component STRING",
        (5, None, "x", "x"), (3, "", "x", "x"), (9, " \n", "x", "x"), (None, "", "x", "x"), (4, "a b c d e", "x", "x"), (4, "a b c d e", "x", "x"),
    )
    found = simhash.near_duplicates(rows).select("doc_id", "component_id")
    assert values(found) == [(3, 3), (4, 4), (4, 4), (5, 3), (9, 3), (None, 3)]
    assert simhash.near_duplicates(rows.limit(0)).count() == 0
    alone = simhash.near_duplicates(rows.where("doc_id IS NULL")).select("doc_id", "component_id")
    assert values(alone) == [(None, None)]


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(2000, 2000), (5, 5), (3, 2)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert found == {**{k: 1 for k in range(1, 301)}, **{1000 + k: 1000 for k in range(200)}}
    assert np.all([v <= k for k, v in found.items()])
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0
