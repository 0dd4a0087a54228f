"""Raw NDJSON -> star schema -> marts, as one run on invented records."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelweave.plans import marts, people, stages
from reelweave.plans.tables import Tables

FILMS = [
    {"title": "Sky", "year": 2001, "studio": "North", "studio_founded": 1990, "studio_status": "active", "franchise": "Sky", "animation_type": "fully_animated", "source_file": "a.json"},
    {"title": "SKY", "year": 2001, "studio": "South", "studio_founded": 1995, "studio_status": "closed", "franchise": "Sky", "animation_type": "hybrid", "source_file": "b.json"},
    {"title": "Moss", "year": 2003, "studio": "South", "studio_founded": 1995, "studio_status": "closed", "franchise": "Moss", "animation_type": "hybrid", "source_file": "b.json"},
]
PEOPLE = [
    {"name": "Ava", "franchise": "Sky", "role": "Main Protagonist", "gender": "F", "species": "human", "voice_actor": "Ann", "appearances": [{"title": "SKY", "year": 2001}, {"title": "Gone", "year": 1900}]},
    {"name": "Ava", "franchise": "Sky", "role": "hero", "gender": "F", "species": "human", "voice_actor": "Bob", "appearances": [{"title": "SKY", "year": 2001}]},
    {"name": "Pim", "franchise": "Moss", "role": "oracle", "gender": None, "species": "robot", "voice_actor": "", "appearances": [{"title": "Moss", "year": 2003}]},
    {"name": "Sol", "franchise": "Moss", "role": None, "gender": "M", "species": None, "voice_actor": "Ann", "appearances": []},
]
REPORTS = [("Moss", 2003, "2024-01-05", "CA", 10.5, 1, True), ("Moss", 2003, "2024-01-08", "NY", 2.0, 1, False), ("Moss", 2003, "2024-01-12", "CA", 6.25, 2, True), ("Gone", 1900, "2024-01-05", "CA", 1.0, 1, True)]
# other letter case than the film record
REPORTS[2] = ("MOSS", *REPORTS[2][1:])


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("tables"))
    reports = [dict(zip(("film_title", "film_year", "report_date", "state_code", "revenue", "week_number", "is_weekend"), r, strict=True)) for r in REPORTS]
    for topic, records in (("films", FILMS), ("characters", PEOPLE), ("boxoffice", reports)):
        folder = raw / topic / "2024-01-15"
        folder.mkdir(parents=True)
        (folder / "batch_1.json").write_text("\n".join(map(json.dumps, records)))
    report = stages.run_stages(spark, stages.catalogue_stages(spark, str(raw), out), out)
    counts = {r.table: r.rows for r in report.collect()}
    assert counts == {
        "studios": 2, "franchises": 2, "media": 2, "films": 2, "roles": 14, "genders": 5, "talent": 2, "characters": 3,
        "character_appearances": 2, "box_office_daily": 4, "box_office_weekly": 3, "box_office_total": 2}
    return out


def test_marts(spark, root, values, tmp_path):
    t = Tables.from_parquet(spark, root)
    assert values(marts.films_complete(t), "title", "studio_name", "franchise_name", "total_revenue", "weeks_in_release") == [
        ("Moss", "South", "Moss", Decimal("18.75"), 2),
        ("SKY", "North", "Sky", None, None)]
    assert values(marts.characters_complete(t), "name", "role", "gender", "appearance_count", "voice_actors_str") == [
        ("Ava", "hero", "female", 1, t.talent.join(t.character_appearances, F.col("talent_id") == t.talent.id).first().name),
        ("Pim", None, "n/a", 1, ""), ("Sol", "supporting", "male", 0, "")]
    stats = values(marts.studio_stats(t), "studio_name", "film_count", "character_count", "unique_voice_actors", "distinct_voice_actors")
    assert stats == [("North", 1, 1, 1, 1), ("South", 1, 2, 1, 0)]
    summary = values(marts.boxoffice_summary(t), "film_title", "studio_name", "days_in_release", "states_reached")
    assert summary == [("Gone", None, 1, 1), ("Moss", "South", 3, 2)]
    stages.export_marts(spark, root, str(tmp_path), ["films_complete"])
    assert spark.read.parquet(f"{tmp_path}/films_complete").count() == 2


def test_queries_on_stored_tables(spark, root, values):
    t = Tables.from_parquet(spark, root)
    assert values(people.top_characters(t), "name", "appearances") == [("Ava", 1), ("Pim", 1)]
    assert values(people.studio_film_counts(t), "name", "film_count") == [("North", 1), ("South", 1)]


def test_skip_and_dry_run(spark, tmp_path, values):
    plan = [("a", lambda: spark.range(3)), ("b", lambda: spark.range(4))]
    assert values(stages.run_stages(spark, plan, str(tmp_path), skip=["a"], dry_run=True)) == [(0, "a", None, "skipped"), (1, "b", 4, "counted")]
    assert not any(tmp_path.iterdir())
