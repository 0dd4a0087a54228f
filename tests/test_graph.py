"""The stage graph: order, skips, resuming after a failure, and a whole catalogue from files."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from reelweave.plans import builders, graph, marts, views
from reelweave.plans.catalogue_graph import graph_of_folder
from reelweave.plans.graph import Stage, dependants, in_order, run_graph
from reelweave.plans.tables import Tables
from reelweave.sources import readers

DOCUMENTS = {
    "pixar_characters/sky.json": {
        "franchise": "Sky", "films": ["Sky (2001)", "Sky 2 (2004)"],
        "categories": {"sky_one": {"year": 2001, "characters": [
            {"name": "Ava", "role": "hero", "species": "anthropomorphic cat", "gender": "Female", "voice_actor": "Ann", "notes": "first"},
            {"name": "Rok", "role": "villain", "species": "toy (doll)", "voice_actor": "Bob"}]}}},
    "a_games/race.json": {"franchise": "Race", "studio": "Big/Small", "games": ["Race (2010)"], "categories": {"r": {"year": 2010, "platform": "PC/Vectrex"}}},
    "b_games/race.json": {"franchise": "Race", "studio": "Other", "games": ["RACE (2010)"]},
    "pixar_characters/all_soundtracks.json": [{"film": "Sky", "film_year": 2001, "releases": [
        {"title": "Sky Songs", "label": "L", "album_awards": [{"award": "Oscar", "category": "Best Original Score", "year": 2002, "result": "won"}],
         "tracks": [{"title": "One", "composer": "Com", "performers": [{"name": "Ann"}], "awards": [{"award": "Oscar", "category": "Best Original Song", "year": 2002, "result": "nominated"}]}]}]}],
    "pixar_characters/00_studio_summary.json": {"franchise": "No", "films": ["No (2000)"]},
}
REPORTS = [("SKY", 2001, "2024-01-05", "CA", 10.5, 1, True), ("Sky", 2001, "2024-01-12", "NY", 2.0, 2, True), ("Sky", 2001, "2024-01-13", None, 9.0, 2, True), ("Gone", 1900, "2024-01-05", "CA", 1.0, 1, True)]


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name, body in DOCUMENTS.items():
        path = root / "documents" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(body))
    folder = root / "boxoffice" / "2024-01-15"
    folder.mkdir(parents=True)
    names = ("film_title", "film_year", "report_date", "state_code", "revenue", "week_number", "is_weekend")
    (folder / "batch.json").write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in REPORTS))
    return str(root)


def stage(name, reads, writes, build=None):
    return Stage(name, tuple(reads), tuple(writes), build)


def test_order_follows_the_tables():
    stages = [stage("c", ["b1", "a"], ["c"]), stage("z", [], ["z"]), stage("b", ["a"], ["b1", "b2"]), stage("a", ["given"], ["a"])]
    assert [s.name for s in in_order(stages, given=["given"])] == ["z", "a", "b", "c"]
    assert dependants(in_order(stages, ["given"]), "a") == {"b", "c"} and dependants(in_order(stages, ["given"]), "z") == set()
    with pytest.raises(ValueError, match="given"):
        in_order(stages)
    with pytest.raises(ValueError, match="wait for each other: .*x.*y"):
        in_order([stage("x", ["y"], ["x"]), stage("y", ["x"], ["y"])])
    with pytest.raises(ValueError, match="written by x and by y"):
        in_order([stage("x", [], ["t"]), stage("y", [], ["t"])])


def test_a_failed_run_goes_on_where_it_stopped(spark, tmp_path, values):
    calls, fail = [], [True]

    def build(name, rows):
        def run(t):
            calls.append(name)
            source = spark.range(rows) if name == "a" else t.a.select("id")
            if name == "c" and fail[0]:  # dies in a task, in the middle of the write
                source = source.select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"))
            return {name: source}

        return run

    stages = [stage(n, ["a"] if n != "a" else [], [n], build(n, 5)) for n in ("d", "c", "b", "a")]
    root = str(tmp_path)
    with pytest.raises(Exception, match="lost"):
        run_graph(spark, stages, root, run="one")
    assert calls == ["a", "d", "c"]
    fail[0] = False
    report = values(run_graph(spark, stages, root, run="one").drop("position"))
    assert calls == ["a", "d", "c", "c", "b"]
    assert report == [(n, n, 5, 0, "finished" if n in "ad" else "written") for n in "abcd"]
    assert spark.read.parquet(f"{root}/c").count() == 5
    assert {r.state for r in run_graph(spark, stages, root, run="one").collect()} == {"finished"}
    # another run writes everything again; a stage whose input is new is never taken as finished
    assert {r.state for r in run_graph(spark, stages, root, run="two").collect()} == {"written"}
    calls.clear()
    spark.createDataFrame([], graph.RECORD).write.mode("overwrite").parquet(f"{root}/_stages/a")
    run_graph(spark, stages, root, run="two")
    assert calls == ["a", "d", "c", "b"]


def test_stages_side_by_side(spark, tmp_path, values):
    """Two stages that do not wait for each other are under way together; a third waits for both; a failure stops the rest."""
    together, calls, fail = threading.Barrier(2, timeout=60), [], [False]

    def build(name):
        def run(t):
            if name in "ab":
                together.wait()
            if fail[0] and name == "b":
                raise ValueError("lost")
            calls.append(name)
            return {name: spark.range(3) if name in "ab" else t.a.join(t.b, "id")}

        return run

    stages = [stage("c", ["a", "b"], ["c"], build("c")), *[stage(n, [], [n], build(n)) for n in "ab"]]
    report = values(run_graph(spark, stages, str(tmp_path / "x"), at_once=2), "position", "table", "rows", "state")
    assert report == [(k, n, 3, "written") for k, n in enumerate("abc")] and sorted(calls[:2]) == ["a", "b"] and calls[2:] == ["c"]
    fail[0] = True
    with pytest.raises(ValueError, match="lost"):
        run_graph(spark, stages, str(tmp_path / "y"), at_once=2)
    fail[0], together = False, threading.Barrier(1)
    report = values(run_graph(spark, stages, str(tmp_path / "y"), at_once=2), "table", "state")
    assert report == [("a", "finished"), ("b", "written"), ("c", "written")]


def test_records_are_flattened_once(spark, raw, tmp_path):
    """Kept and rejected records read one written table, and tracks and awards one written parse of the soundtrack files."""
    stages = {s.name: s for s in graph_of_folder(spark, raw)}
    run_graph(spark, [stages["documents"]], str(tmp_path))
    t = Tables.from_parquet(spark, str(tmp_path))
    for name in ("film_records", "character_records", "music_records"):
        for table in stages[name].build(t).values():
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert "try_variant_get" not in plan and "from_json" not in plan and "/written-" in "".join(table.inputFiles()), name


def test_species_texts_are_read_once_each(spark, values):
    """Names come from written distinct texts, with no filter on them left to be evaluated on all rows."""
    rows = spark.range(1000).selectExpr("CASE id % 3 WHEN 0 THEN 'fire machine' WHEN 1 THEN 'Cat (small)' END AS species")
    built = builders.build_species(rows, readers.species(spark))
    assert ("fire machine",) in values(built, "name") and "Range (" not in built._jdf.queryExecution().executedPlan().toString()
    named = rows.selectExpr("'x' AS name", "species AS franchise", "'hero' AS role", "'male' AS gender", "species", "1 AS first_appearance_year")
    parts = builders.build_characters(named, readers.roles(spark), readers.genders(spark))
    assert values(parts, "species", "species_subtype") == [("Cat (small)", "small"), ("fire machine", None), (None, None)]


def test_skips_are_checked_against_dependants(spark, tmp_path):
    stages = [stage("a", [], ["a"], lambda t: {"a": spark.range(3)}), stage("b", ["a"], ["b"], lambda t: {"b": t.a})]
    with pytest.raises(ValueError, match="a has no tables yet, which .'b'. need"):
        run_graph(spark, stages, str(tmp_path), skip=["a"])
    with pytest.raises(ValueError, match="no stages"):
        run_graph(spark, stages, str(tmp_path), skip=["q"])
    assert {r.state for r in run_graph(spark, stages, str(tmp_path), skip=["a", "b"]).collect()} == {"skipped"}
    run_graph(spark, stages[:1], str(tmp_path), run="earlier")
    assert [(r.stage, r.state) for r in run_graph(spark, stages, str(tmp_path), skip=["a"]).collect()] == [("a", "skipped"), ("b", "written")]
    dry = run_graph(spark, stages, str(tmp_path), run="dry", dry_run=True).collect()
    assert [(r.rows, r.state) for r in dry] == [(3, "counted"), (3, "counted")]


def test_wrong_columns_and_violations(spark, table, tmp_path):
    rows = table("name STRING, id INT, status STRING", ("a", 1, "active"), ("b", 1, "gone"), (None, 2, None))
    full = rows.selectExpr("*", "1 AS years_active_start", "2 AS years_active_end", "0 AS more")
    report = run_graph(spark, [stage("studios", [], ["studios"], lambda t: {"studios": full})], str(tmp_path)).collect()
    assert [(r.rows, r.violations) for r in report] == [(3, 3)]  # a null name, a status, a repeated id
    assert spark.read.parquet(f"{tmp_path}/studios").columns == ["id", "name", "years_active_start", "years_active_end", "status"]
    with pytest.raises(ValueError, match="built"):
        run_graph(spark, [stage("x", [], ["x"], lambda t: {"y": rows})], str(tmp_path))


def test_all_tables_from_files(spark, raw, values, tmp_path):
    root = str(tmp_path)
    report = run_graph(spark, graph_of_folder(spark, raw), root).collect()
    counts = {r.table: r.rows for r in report}
    assert sum(r.violations for r in report) == 0
    assert {k: v for k, v in counts.items() if k in ("raw_films", "raw_characters", "raw_games", "raw_reports", "rejected_reports")} == {
        "raw_films": 2, "raw_characters": 2, "raw_games": 2, "raw_reports": 3, "rejected_reports": 1}
    t = Tables.from_parquet(spark, root)
    assert values(t.rejected_reports, "broken_rules") == [(["required:state_code"],)]
    assert values(marts.films_complete(t), "title", "studio_name", "total_revenue", "weeks_in_release")[0][:2] == ("Sky", "Pixar Animation Studios")
    assert values(t.games, "developer", "publisher", "platforms") == [("Small", "Big", ["PC", "Vectrex"])]
    assert values(t.media, "title", "media_type") == [("RACE", "game"), ("Sky", "film"), ("Sky 2", "film"), ("Sky Songs", "soundtrack")]
    assert ("Vectrex",) in values(t.platforms, "name") and t.game_platforms.count() == 2
    seen = values(views.v_character_appearances(t), "character_name", "species", "species_subtype", "is_anthropomorphic", "media_title", "role", "voice_actor", "variant", "notes")
    assert seen == [("Ava", "cat", None, True, m, "hero", "Ann", None, "first") for m in ("Sky", "Sky 2")] + [
        ("Rok", "toy", "doll", False, m, "villain", "Bob", None, None) for m in ("Sky", "Sky 2")]
    assert values(views.v_nominations(t), "media_title", "category", "outcome", "song_title") == [
        ("Sky", "Best Original Score", "won", None), ("Sky", "Best Original Song", "nominated", "One")]
    assert values(t.talent, "name") == [("Ann",), ("Bob",), ("Com",)]
    assert values(t.box_office_total, "film_title", "days_in_release") == [("Gone", 1), ("Sky", 2)]
    assert t.soundtracks.count() == 1 and t.songs.count() == 1 and t.song_credits.count() == 2
