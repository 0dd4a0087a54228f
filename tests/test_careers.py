"""Careers of the most seen actors: distinct values are counted for them only, and appearances are dealt out by number."""

import collections
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelweave.plans import people
from reelweave.plans.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_actors_against_a_plain_count(spark):
    n = F.col("id")
    cast = [(i * i % 23, i % 31, i) for i in range(400)]  # talent, character, media; some of each are unknown below
    tables = {
        "character_appearances": spark.createDataFrame(cast, "talent_id LONG, character_id LONG, media_id LONG"),
        "characters": spark.range(29).select(n, F.when(n % 5 != 0, n % 4).cast("string").alias("franchise")),
        "media": spark.range(380).select(n, F.when(n % 7 != 0, n % 60 + 1950).cast("int").alias("year")),
        "talent": spark.range(22).select(n, F.concat(F.lit("t"), n).alias("name")),
    }
    found = people.actor_careers(Tables(tables.__getitem__), min_appearances=5, k=4)
    by_actor = collections.defaultdict(list)
    for actor, who, title in cast:
        if who < 29 and title < 380 and actor < 22:
            by_actor[f"t{actor}"].append((who, title, str(who % 4) if who % 5 else None, title % 60 + 1950 if title % 7 else None))
    best = sorted((a for a, rows in by_actor.items() if len(rows) >= 5), key=lambda a: (-len(by_actor[a]), a))[:4]
    expected = []
    for actor in best:
        who, title, franchise, year = ({x for x in column if x is not None} for column in zip(*by_actor[actor], strict=True))
        expected.append((actor, len(by_actor[actor]), len(who), len(title), len(franchise), min(year), max(year), max(year) - min(year)))
    names = ["voice_actor", "total_appearances", "unique_characters", "films_appeared", "franchises", "first_appearance",
             "last_appearance", "career_span_years"]
    assert [tuple(r) for r in found.select(names).collect()] == expected


def test_rows_are_not_laid_out_for_all_actors(spark):
    text = plan(entry.queries()["actor_careers"](spark, FOLDER))
    assert "LeftSemi" in text.split("Expand", 1)[1]
    assert "REPARTITION_BY_NUM" in text


def test_voices_and_titles_have_a_known_size(spark):
    """Rows of ``build_appearances`` were shuffled to meet titles and voices whose size was not known."""
    text = plan(entry.queries()["build_appearances"](spark, FOLDER))
    assert re.search(r"BroadcastHashJoin \[talent_id", text) and re.search(r"BroadcastHashJoin \[media_id", text)
    assert not re.search(r"hashpartitioning\(talent_id", text)
