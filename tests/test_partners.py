"""Partners of characters against a brute-force count over all pairs."""

import collections
import itertools
import random

import pytest

from reelweave.plans.partners import top_partners

SCHEMA = "character_id BIGINT, media_id BIGINT"


def brute(rows, k):
    casts = collections.defaultdict(set)
    for character, media in rows:
        if character is not None and media is not None:
            casts[media].add(character)
    shared = collections.defaultdict(collections.Counter)
    for cast in casts.values():
        for a, b in itertools.permutations(cast, 2):
            shared[a][b] += 1
    out = []
    for a, partners in shared.items():
        best = sorted(partners.items(), key=lambda p: (-p[1], p[0]))[:k]
        out += [(a, rank, b, n) for rank, (b, n) in enumerate(best, start=1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("character_id", "rank", "partner_id", "shared_titles").collect())


@pytest.mark.parametrize("small", [0, 4, 1000])
def test_equal_to_brute_force(table, small):
    draw = random.Random(7)
    rows = [(draw.randrange(60), draw.choice([draw.randrange(40), draw.randrange(4)])) for _ in range(500)]
    rows += [(0, media) for media in range(40)]  # in every title
    rows += [(character, 100) for character in range(60)]  # a title with all characters
    rows += rows[:30] + [(None, 1), (2, None), (900, 901)]
    assert found(top_partners(table(SCHEMA, *rows), 5, small)) == brute(rows, 5)


def test_blocks_of_a_title_with_many_sets(table, monkeypatch):
    monkeypatch.setattr("reelweave.plans.partners.BLOCK", 3)
    draw = random.Random(8)
    rows = [(character, 0) for character in range(40)]
    rows += [(draw.randrange(40), media) for media in range(1, 8) for _ in range(15)]
    assert found(top_partners(table(SCHEMA, *rows), 3, 2)) == brute(rows, 3)


def test_one_title_with_all_characters_makes_no_pairs(spark, monkeypatch):
    """20,000 characters share one title: one set, whose first characters answer for all."""
    from pyspark.sql import functions as F

    from reelweave.plans import partners

    seen = []
    kept = partners._overlaps
    monkeypatch.setattr(partners, "_overlaps", lambda *args: seen.append(kept(*args)) or seen[0])
    cast = spark.range(20_000).select(F.col("id").alias("character_id"), F.lit(1).cast("bigint").alias("media_id"))
    rows = top_partners(cast, 2)
    assert seen[0].count() == 1
    assert rows.count() == 40_000
    assert found(rows.where("character_id IN (0, 1, 777)")) == [
        (0, 1, 1, 1), (0, 2, 2, 1), (1, 1, 0, 1), (1, 2, 2, 1), (777, 1, 0, 1), (777, 2, 1, 1)]


def test_pairs_of_small_titles_are_not_shuffled(table):
    """Arrays are dealt out by character, in partitions that are not merged by their bytes."""
    rows = [(character, media) for media in range(4) for character in range(media, media + 6)]
    plan = top_partners(table(SCHEMA, *rows), 2)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "partners" in plan


def test_hot_characters(table, monkeypatch):
    monkeypatch.setattr("reelweave.plans.partners.HOT", 3)
    draw = random.Random(9)
    rows = [(draw.randrange(50), draw.randrange(60)) for _ in range(400)] + [(0, media) for media in range(60)]
    assert found(top_partners(table(SCHEMA, *rows), 3, 9)) == brute(rows, 3)


def test_empty_and_clashing_columns(table):
    assert top_partners(table(SCHEMA)).count() == 0
    odd = table(SCHEMA + ", rank STRING, partner_id STRING, set_size INT, cast_size INT", (1, 1, "x", "y", 1, 1), (2, 1, None, None, 1, 1))
    assert found(top_partners(odd)) == [(1, 1, 2, 1), (2, 1, 1, 1)]
