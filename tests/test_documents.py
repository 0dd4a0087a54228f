import json
import random
import time

import pytest

from reelweave.operators import documents as doc
from reelweave.plans import builders as b
from reelweave.sources import readers

FILES = {
    "pixar_characters/sky.json": {
        "franchise": "Sky", "films": ["Sky (2001)", "Sky 2 (2004)", "Untitled"],
        "categories": {
            "sky_one": {"year": 2001, "count": 2, "characters": [
                {"name": "Ava", "role": "hero", "species": "toy (doll)", "gender": "Female", "voice_actor": "Ann Lee, Bob Ray"},
                {"name": "Rok", "role": "Main Villain", "voice_actor": None}]},
            "the-sky-2-cast": {"characters": [{"name": "Ava"}]},
            "note": "text", "empty": {"year": 2004}}},
    "disneytoon_characters/moss.json": {"film": "Moss", "studio": "Disneytoon Films", "year": 1999, "characters": [{"name": "Pim"}, "text", {"role": "x"}]},
    "kingdom_hearts_characters/realm.json": {"franchise": "Realm", "game": "Realm Zero", "year": 2010, "characters": [{"name": "Kit"}]},
    "blue_sky_characters/ice.json": {"franchise": "Ice", "films": ["Ice (2002)"], "characters": {"Ice_Age_1": [{"name": "Uma"}], "rest": [{"name": "Oz"}], "odd": 3}},
    "disney_interactive_characters/race.json": {
        "franchise": "Race", "studio": "Big House/Small House", "games": ["Race (2010)", "Race (2010)", "Race II (2012)"],
        "categories": {"race": {"year": 2010, "platform": "PC/PS3", "developer": "Fast House", "characters": [{"name": "Driver"}]}}},
    "fox_disney_plus_characters/plain.json": {"films": ["Plain (2005)"], "film_data": {"p": {"year": 2005, "characters": [{"name": "Alt"}]}},
                                              "categories": {"p": {"year": 2005, "characters": [{"name": "Old"}]}}},
    "marvel_animation_characters/series.json": {"franchise": "Heroes", "series": ["What (2021-2024)"], "categories": {"s": {"characters": [{"name": "Wat"}]}}},
    "pixar_characters/00_studio_summary.json": {"franchise": "No", "films": ["No (2000)"]},
    "pixar_characters/all_soundtracks.json": {"franchise": "No", "films": ["No (2000)"]},
    "pixar_characters/list.json": [{"franchise": "No"}],
}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for name, body in FILES.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_text(json.dumps(body))
    (root / "pixar_characters/bad.json").write_text('{"franchise": "Bro')
    return str(root)


@pytest.fixture
def docs(spark, corpus):
    return readers.read_documents(spark, corpus)


def test_read_documents_skips(spark, docs, corpus, values):
    assert [f for _, f in values(docs, "source_dir", "source_file")] == [
        "ice.json", "race.json", "moss.json", "plain.json", "realm.json", "series.json", "sky.json"]
    assert readers.read_documents(spark, corpus, ("kingdom_hearts_characters",)).count() == 6


def test_media_of_all_shapes(docs, values):
    assert values(doc.media_rows(docs), "franchise", "title", "year", "media_type") == sorted([
        ("Ice", "Ice", 2002, "film"), ("Race", "Race", 2010, "game"), ("Race", "Race", 2010, "game"), ("Race", "Race II", 2012, "game"),
        ("moss", "Moss", 1999, "film"), ("plain", "Plain", 2005, "film"), ("Realm", "Realm Zero", 2010, "game"),
        ("Sky", "Sky", 2001, "film"), ("Sky", "Sky 2", 2004, "film")], key=lambda r: tuple((v is None, str(v)) for v in r))
    kept = doc.media_rows(docs, keep_raw=True).filter("year IS NULL")
    assert values(kept, "title") == [("Untitled",)]


def test_characters_of_all_shapes(docs, values):
    assert values(doc.character_rows(docs), "name", "franchise", "container", "media_title", "media_year") == sorted([
        ("Ava", "Sky", "categories", "Sky", 2001), ("Rok", "Sky", "categories", "Sky", 2001), ("Ava", "Sky", "categories", "Sky", 2001),
        ("Pim", "moss", "list", "Moss", 1999), ("Kit", "Realm", "list", "Realm Zero", 2010), ("Uma", "Ice", "map", "Ice", 2002),
        ("Oz", "Ice", "map", None, None), ("Driver", "Race", "categories", "Race", 2010), ("Alt", "plain", "categories", "Plain", 2005),
        ("Wat", "Heroes", "categories", None, None)], key=lambda r: tuple((v is None, str(v)) for v in r))


def test_stand_in_titles_and_first_title(docs, values):
    rows = doc.character_rows(docs, first_for_lists=True, franchise_year=True)
    assert values(rows.filter("name = 'Oz'"), "media_title", "media_year") == [("Ice", 2002)]


def test_category_with_a_year_but_no_title(table, values):
    body = {"franchise": "Sky", "films": ["Sky (2001)"], "categories": {"zz": {"year": 2009, "characters": [{"name": "Ava"}]}}}
    rows = doc.character_rows(doc.parse_documents(table("value STRING, path STRING", (json.dumps(body), "/x/y/z.json"))), franchise_year=True)
    assert values(rows, "media_title", "media_year", "media_type") == [("Sky", 2009, "film")]
    assert values(doc.stand_in_titles(rows), "title", "year") == [("Sky", 2009)]


def test_titles_of_the_document_come_as_one_array(docs):
    rows = doc.character_rows(docs, titles=True).filter("name = 'Ava' AND category = 'sky_one'").collect()
    assert [[m.title for m in r.titles] for r in rows] == [["Sky", "Sky 2"]]


def test_categories_skip_texts(docs, values):
    rows = doc.category_rows(docs).filter("source_file = 'sky.json'")
    assert values(rows, "category", "category_year") == [("empty", 2004), ("sky_one", 2001), ("the-sky-2-cast", None)]


def test_games(docs, values):
    rows = doc.game_rows(docs.filter("source_dir = 'disney_interactive_characters'"))
    assert values(rows, "title", "year", "developer", "publisher", "platforms") == [
        ("Race", 2010, "Fast House", "Big House", ["PC", "PlayStation 3"]), ("Race", 2010, "Fast House", "Big House", ["PC", "PlayStation 3"]),
        ("Race II", 2012, "Small House", "Big House", [])]


def test_raw_films(docs, values):
    films = b.raw_films_from_documents(docs)
    assert values(films, "title", "studio", "studio_founded", "studio_status") == [
        ("Ice", "Blue Sky Studios", 1987, "closed"), ("Moss", "DisneyToon Studios", 1988, "closed"),
        ("Plain", "20th Century Animation", 2020, "active"), ("Sky", "Pixar Animation Studios", 1986, "active"),
        ("Sky 2", "Pixar Animation Studios", 1986, "active")]


def test_dashboard_tables(docs, values):
    people = doc.character_rows(docs)
    characters = b.dashboard_characters(people)
    ids = values(characters, "id")
    assert len(ids) == 10 and len(set(ids)) == 10
    assert values(characters.filter("name = 'Oz'"), "film_ids", "gender", "studio_id") == [("[]", "unknown", "blue-sky")]
    films = b.dashboard_films(doc.media_rows(docs), characters)
    assert ("sky-2001", "Sky", 2001, 3) in values(films, "id", "title", "year", "character_count")


def test_soundtracks(table, values):
    entry = [{"film": "Sky", "film_year": 2001, "releases": [
        {"title": "Sky Songs", "label": "L", "conductor": "Con", "composers": ["Com", "Various Classical", None],
         "album_awards": [{"award": "Oscar", "category": "Score", "year": 2002, "result": "won"}],
         "tracks": [{"title": "One", "composer": "Com", "performers": [{"name": " Per ", "type": "Singer"}, {"name": None}],
                     "awards": [{"award": "City", "category": "Song", "year": 2002}]}, {"title": None}, {"title": "Two"}]},
        {"tracks": [{"title": "Lost"}]}]}, {"film": None, "releases": [{"title": "Lost"}]}]
    entries = doc.soundtrack_entries(table("value STRING", (json.dumps(entry),)))
    releases = doc.release_rows(entries)
    tracks = doc.track_rows(releases)
    assert values(tracks, "song_title", "track_number", "track_type") == [("One", 1, "song"), ("Two", 3, "song")]
    assert values(doc.song_credit_rows(tracks), "song_title", "name", "credit_type") == [("One", "Com", "composer"), ("One", "Per", "performer")]
    assert values(doc.album_credit_rows(releases), "name", "credit_type") == [("Com", "composer"), ("Con", "conductor")]
    assert values(doc.award_rows(entries), "award_body", "category", "outcome", "song_title") == [
        ("Academy Awards", "Score", "won", None), ("City", "Song", "nominated", "One")]
    assert doc.award_rows(entries.limit(0)).count() == 0


def test_shorts(table, values):
    body = {"shorts": [{"title": "Wee", "year": 1999, "directors": ["A", "B"], "released_with": "Sky", "released_with_year": 2001}]}
    docs = doc.parse_documents(table("value STRING, path STRING", (json.dumps(body), "/x/awards/shorts.json")))
    assert values(doc.shorts_rows(docs), "title", "year", "directors", "notes") == [("Wee", 1999, ["A", "B"], None)]


def test_appearances_drop_nulls(table, values):
    raw = table("name STRING, appearances ARRAY<STRUCT<title: STRING, year: INT>>", ("a", [("T", 1), None]), ("b", None), ("c", []))
    assert values(doc.explode_appearances(raw), "name", "media_title", "media_year") == [("a", "T", 1)]


def test_categories_keep_the_order_of_the_document(spark, values):
    text = (
        '{"studio": "House", "games": ["Game (2001)"], "categories": {"zeta": {"year": 2001, "developer": "First", "characters": [{"name": "Z"}]},'
        ' "alpha": {"year": 2001, "developer": "Second", "characters": [{"name": "A"}]}, "mid": {"year": 1, "characters": [{"name": "M"}]}},'
        ' "film_data": {"omega": {"characters": [{"name": "O"}]}, "mid": {"year": 2, "characters": [{"name": "N"}]}, "beta": {"characters": []}}}'
    )
    docs = doc.parse_documents(spark.createDataFrame([(text, "/d/f.json")], "value STRING, path STRING"))
    assert [r.category for r in doc.category_rows(docs).collect()] == ["zeta", "alpha", "mid", "omega", "beta"]
    people = doc.character_rows(docs).orderBy("group_position", "position").collect()
    assert [(p.category, p.name) for p in people] == [("zeta", "Z"), ("alpha", "A"), ("mid", "N"), ("omega", "O")]
    assert doc.game_rows(docs).first().developer == "First"


def test_lists_of_a_map_keep_their_order(spark):
    text = '{"films": ["A (2001)"], "characters": {"z": [{"name": "1"}], "b": [{"name": "2"}], "a": [{"name": "3"}]}}'
    docs = doc.parse_documents(spark.createDataFrame([(text, "/d/f.json")], "value STRING, path STRING"))
    assert [r.name for r in doc.character_rows(docs).orderBy("group_position").collect()] == ["1", "2", "3"]


def test_merged_containers_against_plain_python(spark):
    rng = random.Random(8)
    texts, want = [], []
    for n in range(60):
        names = [f"k{k}" for k in range(rng.randint(0, 9))]
        base, alternate = (
            {k: {"year": rng.randint(1, 99), "characters": []} if rng.random() < 0.8 else rng.choice(["text", None, 3, [1]])
             for k in rng.sample(names, rng.randint(0, len(names)))} for _ in range(2))
        texts.append((json.dumps({"categories": base, "film_data": alternate}), f"/d/{n}.json"))
        merged = {k: alternate.get(k, v) for k, v in base.items()} | {k: v for k, v in alternate.items() if k not in base}
        want.append([(k, v["year"]) for k, v in merged.items() if isinstance(v, dict)])
    docs = doc.parse_documents(spark.createDataFrame(texts, "value STRING, path STRING"))
    found = {f"{n}.json": [] for n in range(60)}
    for r in doc.category_rows(docs).collect():
        found[r.source_file].append((r.category, r.category_year))
    assert [found[f"{n}.json"] for n in range(60)] == want


def test_a_large_document_takes_linear_time(spark, tmp_path):
    """Ten times the keys in both containers may not take much more than ten times as long (with the square: a hundred)."""

    def seconds(n):
        body = {"films": ["A (2001)"], "categories": {f"c{k * 7919 % n}": {"year": 1, "characters": [{"name": f"n{k}"}]} for k in range(n)},
                "film_data": {f"c{k + n // 2}": {"year": 2, "characters": [{"name": f"m{k}"}, {"name": "x"}]} for k in range(n)},
                "characters": [{"name": f"l{k}"} for k in range(n)]}
        docs = doc.parse_documents(spark.createDataFrame([(json.dumps(body), "/d/f.json")], "value STRING, path STRING"))
        stored = doc.store_documents(docs, f"{tmp_path}/{n}")
        best = []
        for _ in range(3):
            start = time.perf_counter()
            counts = {r.container: r["count"] for r in doc.character_rows(stored).groupBy("container").count().collect()}
            best.append(time.perf_counter() - start)
        assert counts == {"categories": n // 2 + 2 * n, "list": n}
        return min(best)

    seconds(500)
    small, large = seconds(1000), seconds(10_000)
    assert large < 30 * small


def test_stored_documents_are_read_by_column(spark, docs, values, tmp_path):
    stored = doc.store_documents(docs, str(tmp_path / "documents"))
    assert values(doc.character_rows(stored)) == values(doc.character_rows(docs))
    assert values(doc.media_rows(stored, keep_raw=True)) == values(doc.media_rows(docs, keep_raw=True))
    plan = doc.media_rows(stored)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):]
    assert "entries" not in read and "people" not in read and "Exchange" not in plan
    plan = doc.category_rows(stored)._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "from_json" not in plan


def test_dashboard_films_parse_once(spark):
    """Titles and characters come from stored documents, and no character is numbered for a count."""
    import __spark_entry__ as entry

    plan = entry.queries()["dashboard_films_from_documents"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "ExistingRDD" not in plan


def test_documents_without_games_are_left_out_before_their_categories_are_read(spark):
    texts = ['{"games": ["G (2004)"], "categories": {"a": {"year": 2004, "developer": "Dev"}}}', '{"games": null, "film": "F"}', '{"game": "One", "year": 2001}',
             '{"games": "no list"}', '{"films": ["F (2004)"], "categories": {"a": {"year": 2004, "developer": "Dev"}}}', '{"game": 7}']
    files = spark.createDataFrame([(t, f"/d/f{i}.json") for i, t in enumerate(texts)], "value STRING, path STRING")
    rows = doc.game_rows(doc.parse_documents(files))
    assert sorted((r.source_file, r.title, r.year) for r in rows.collect()) == [("f0.json", "G", 2004), ("f2.json", "One", 2001), ("f5.json", "7", None)]
    filters = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert any("$.games" in line and "$.game," in line for line in filters)
