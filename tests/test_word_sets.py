"""Mergeable sets against Python sets, and plans without a row laid out per column."""

import collections
import random

from pyspark.sql import functions as F

from reelweave.operators.word_sets import merged_counts, set_words

SCHEMA = "film STRING, week INT, day BIGINT, state BIGINT"
COUNTS = {"days": "day", "states": "state"}


def words_of(df):
    return set_words(df, ["film", "week"], {"day": F.col("day"), "state": F.col("state")})


def rows_of_films():
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", "c", None]), draw.randrange(5), draw.randrange(-200, 20_000), draw.randrange(150)) for _ in range(2000)]
    rows += [("hot", 1, day, day % 70) for day in range(1000)] * 2
    return rows + [("a", 1, None, 3), ("nothing", 1, None, None), (None, None, 5, None)]


def brute(rows, key):
    days, states = collections.defaultdict(set), collections.defaultdict(set)
    for row in rows:
        days[key(row)].update([row[2]] if row[2] is not None else [])
        states[key(row)].update([row[3]] if row[3] is not None else [])
    return {k: (len(days[k]), len(states[k])) for k in days}


def test_every_level_from_one_set_of_words(table):
    rows = rows_of_films()
    words = words_of(table(SCHEMA, *rows))
    weekly = merged_counts(words, ["film", "week"], COUNTS).collect()
    assert {(r.film, r.week): (r.days, r.states) for r in weekly} == brute(rows, lambda r: r[:2])
    films = merged_counts(words, ["film"], COUNTS).collect()
    assert {r.film: (r.days, r.states) for r in films} == brute(rows, lambda r: r[0])
    assert [tuple(r) for r in merged_counts(words, [], COUNTS).collect()] == [brute(rows, lambda r: 0)[0]]


def test_no_expand_and_few_words(table):
    rows = rows_of_films()
    words = words_of(table(SCHEMA, *rows))
    plan = merged_counts(words, ["film"], COUNTS)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert words.where("film = 'hot'").count() <= 2 * (1000 // 64 + 1)  # 70 states are two words


def test_levels_are_not_joined(table):
    """All sets of a level are sized in one aggregation; joined without a key they met in a nested loop."""
    words = words_of(table(SCHEMA, *rows_of_films()))
    for keys in ([], ["film"]):
        assert "Join" not in merged_counts(words, keys, COUNTS)._jdf.queryExecution().executedPlan().toString()


def test_empty(table):
    words = words_of(table(SCHEMA))
    assert merged_counts(words, ["film"], COUNTS).count() == 0
    assert [tuple(r) for r in merged_counts(words, [], COUNTS).collect()] == [(0, 0)]
