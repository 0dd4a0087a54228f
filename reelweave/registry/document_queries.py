"""Flattening of nested documents. Each order (or part) becomes one JSON document, so the work grows with the table.

Orders make three shapes by status: F a map of categories, O a list of characters, P a map of lists.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.operators import documents as doc
from reelweave.plans import builders as b
from reelweave.plans import views
from reelweave.plans.catalogue_graph import catalogue_graph
from reelweave.plans.graph import run_graph
from reelweave.plans.tables import Tables
from reelweave.registry import query
from reelweave.registry.catalogue import with_views
from reelweave.registry.text_queries import _quoted
from reelweave.session import fresh_folder, sorting, written

SHAPES = {
    "F": """{"franchise": "Saga ~c", "studio": "Blue Sky Co", "films": ["Alpha ~k (1990)", "Beta ~k (1995)", "Gamma"],
      "categories": {"a_part": {"year": 1990, "developer": "none", "characters": [
          {"name": "Hero ~k", "role": "hero", "gender": "Male", "voice_actor": "Voice ~v"},
          {"name": "Foe ~k", "role": "villain", "species": "robot (old)"}, "text", {"role": "nameless"}]},
        "beta-~k": {"characters": [{"name": "Pal ~k", "notes": "late"}]}, "note": "text",
        "zeta": {"year": 2050, "characters": [{"name": "Ghost ~k"}]}},
      "film_data": {"zeta": {"year": 1995, "characters": [{"name": "Twin ~k"}]}}}""",
    "O": """{"game": "Game ~k", "year": 2001, "characters": [{"name": "Hero ~k", "origin_franchise": "Other"}, "text", {"name": ""}]}""",
    "P": """{"films": ["Delta ~k (2002)", "No year"], "categories": ["hero", "villain"],
      "characters": {"ice_age_1": [{"name": "Hero ~k"}], "misc": [{"name": "Foe ~k"}], "odd": "text"}}""",
}


def order_documents(t):
    """One document per order, some of them broken or not an object, in three folders."""
    text = F.create_map(*[F.lit(x) for pair in SHAPES.items() for x in pair])[F.col("o_orderstatus")]
    for mark, value in {"~k": "o_orderkey", "~c": "o_custkey", "~v": "l_v"}.items():
        text = F.replace(text, F.lit(mark), F.col(value).cast("string"))
    broken = F.when(F.col("o_orderpriority") == "5-LOW", F.substring(text, 1, 40)).when(
        F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("["), text, F.lit("]")))
    return t.raw("orders").withColumn("l_v", F.col("o_custkey") % 10).select(
        F.coalesce(broken, text).alias("value"),
        F.concat(F.lit("/data/folder_"), F.lower("o_orderstatus"), F.lit("/file_"), "o_orderkey", F.lit(".json")).alias("path"))


def parsed(t):
    return doc.parse_documents(order_documents(t))


DOCS = """docs AS (SELECT o_orderkey AS k, o_custkey AS c, o_custkey % 10 AS v, o_orderstatus AS s, 'folder_' || lower(o_orderstatus) AS source_dir,
  'file_' || o_orderkey || '.json' AS source_file FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH'))"""
FRANCHISE = "CASE s WHEN 'F' THEN 'Saga ' || c WHEN 'O' THEN 'Game ' || k ELSE 'file_' || k END"
MEDIA = """media AS (SELECT k, s, 0 AS position, CASE s WHEN 'F' THEN 'Alpha ' || k WHEN 'O' THEN 'Game ' || k ELSE 'Delta ' || k END AS title,
    CASE s WHEN 'F' THEN 1990 WHEN 'O' THEN 2001 ELSE 2002 END AS year, CASE s WHEN 'O' THEN 'game' ELSE 'film' END AS media_type FROM docs
  UNION ALL SELECT k, s, 1, 'Beta ' || k, 1995, 'film' FROM docs WHERE s = 'F')"""
PEOPLE = f"""people AS (
  SELECT k, s, c, gp, pos, source_file, {FRANCHISE} AS franchise, container, category, who || ' ' || k AS name, role,
    CASE WHEN voiced THEN 'Voice ' || v END AS voice_actor, media || ' ' || k AS media_title, media_year
  FROM docs JOIN (VALUES
    ('F', 'categories', 'a_part', 'Hero', 'hero', true, 'Alpha', 1990, 0, 0), ('F', 'categories', 'a_part', 'Foe', 'villain', false, 'Alpha', 1990, 0, 1),
    ('F', 'categories', 'beta', 'Pal', NULL, false, 'Beta', 1995, 1, 0), ('F', 'categories', 'zeta', 'Twin', NULL, false, 'Beta', 1995, 2, 0),
    ('O', 'list', NULL, 'Hero', NULL, false, 'Game', 2001, 0, 0), ('P', 'map', 'ice_age_1', 'Hero', NULL, false, 'Delta', 2002, 0, 0),
    ('P', 'map', 'misc', 'Foe', NULL, false, NULL, NULL, 1, 0)) AS p(status, container, category, who, role, voiced, media, media_year, gp, pos)
    ON p.status = docs.s)"""


@query("flatten_media", f"""
WITH {DOCS}, {MEDIA} SELECT d.source_file, {FRANCHISE.replace('s WHEN', 'd.s WHEN').replace('|| k', '|| d.k')} AS franchise, m.position, m.title, m.year, m.media_type
FROM docs d JOIN media m ON m.k = d.k""")
def _(t):
    return doc.media_rows(parsed(t)).select("source_file", "franchise", "position", "title", "year", "media_type")


@query("flatten_categories", f"""
WITH {DOCS} SELECT source_file, category, category_year, people FROM docs JOIN (VALUES ('a_part', 1990, 4), ('beta', NULL, 1), ('zeta', 1995, 1))
  AS c(category, category_year, people) ON s = 'F'""")
def _(t):
    rows = doc.category_rows(parsed(t))
    category = F.regexp_replace("category", r"^beta-\d+$", "beta")
    return rows.select("source_file", category.alias("category"), "category_year", F.size("characters").alias("people"))


@query("flatten_characters", f"""
WITH {DOCS}, {PEOPLE} SELECT source_file, franchise, container, category, name, role, voice_actor, media_title, media_year FROM people""")
def _(t):
    rows = doc.character_rows(parsed(t)).withColumn("category", F.regexp_replace("category", r"^beta-\d+$", "beta"))
    return rows.select("source_file", "franchise", "container", "category", "name", "role", "voice_actor", "media_title", "media_year")


@query("flatten_characters_all_media", f"""
WITH {DOCS}, {MEDIA}, {PEOPLE} SELECT p.source_file, p.name, p.category,
  string_agg(m.title || ' ' || m.year || ' ' || m.media_type, '|' ORDER BY m.position) AS titles
FROM people p JOIN media m ON m.k = p.k GROUP BY ALL""")
def _(t):
    rows = doc.character_rows(parsed(t), titles=True).withColumn("category", F.regexp_replace("category", r"^beta-\d+$", "beta"))
    titles = F.transform("titles", lambda m: F.concat_ws(" ", m["title"], m["year"], m["media_type"]))
    return rows.select("source_file", "name", "category", F.array_join(titles, "|").alias("titles"))


@query("raw_films_from_documents", f"""
WITH {DOCS}, {MEDIA} SELECT m.title, m.year, 'Blue Sky Studios' AS studio, CAST(1987 AS INTEGER) AS studio_founded,
  CAST(2021 AS INTEGER) AS studio_closed, 'closed' AS studio_status, 'Saga ' || d.c AS franchise, 'fully_animated' AS animation_type, d.source_file
FROM docs d JOIN media m ON m.k = d.k WHERE d.s = 'F'""")
def _(t):
    return b.raw_films_from_documents(parsed(t))


@query("raw_characters_from_documents", f"""
WITH {DOCS}, {MEDIA}, {PEOPLE}, rows AS (
  SELECT k, name, franchise, role, voice_actor, category, source_file FROM people
  UNION ALL SELECT k, 'Unknown', {FRANCHISE}, 'nameless', NULL, 'a_part', source_file FROM docs WHERE s = 'F')
SELECT r.source_file, r.name, r.franchise, coalesce(r.role, 'supporting') AS role, r.voice_actor, CASE r.category WHEN 'a_part' THEN 1990 WHEN 'zeta' THEN 1995 END AS first_appearance_year,
  coalesce(string_agg(m.title, '|' ORDER BY m.position) FILTER (WHERE m.media_type = 'film'), '') AS films
FROM rows r LEFT JOIN media m ON m.k = r.k GROUP BY r.k, r.source_file, r.name, r.franchise, r.role, r.voice_actor, r.category""")
def _(t):
    rows = b.raw_characters_from_documents(parsed(t))
    return rows.select("source_file", "name", "franchise", "role", "voice_actor", "first_appearance_year",
                       F.array_join(F.transform("appearances", lambda a: a["title"]), "|").alias("films"))


LINKED = f"""linked AS (SELECT k, CASE WHEN container = 'map' THEN 'Delta ' || k ELSE media_title END AS media_title,
    CASE WHEN container = 'map' THEN 2002 ELSE media_year END AS media_year, name, role, voice_actor, franchise, source_file, s, gp, pos FROM people
    UNION ALL SELECT k, 'Alpha ' || k, 1990, 'Unknown', 'nameless', NULL, {FRANCHISE}, source_file, s, 0, 3 FROM docs WHERE s = 'F'),
  titles AS (SELECT title, year FROM media UNION SELECT 'No year', 0 FROM docs WHERE s = 'P' UNION SELECT 'Gamma', 0 FROM docs WHERE s = 'F')"""
SLUG = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\\s-]', '', 'g'), '\\s+', '-', 'g'), '-')"


@query("dashboard_films_from_documents", f"""
WITH {DOCS}, {MEDIA}, {PEOPLE}, {LINKED} SELECT {SLUG.format("t.title")} || CASE WHEN t.year > 0 THEN '-' || t.year ELSE '' END AS id, t.title,
  CAST(t.year AS INTEGER) AS year, count(p.k) AS character_count
FROM titles t LEFT JOIN linked p ON p.media_title = t.title AND p.media_year = t.year GROUP BY ALL""")
def _(t):
    docs = doc.store_documents(parsed(t), fresh_folder(t.spark, "documents"))
    people = written(doc.character_rows(docs, first_for_lists=True, franchise_year=True, unnamed="Unknown"), packed=True)
    titles = doc.media_rows(docs, keep_raw=True).unionByName(doc.stand_in_titles(people), allowMissingColumns=True)
    return b.dashboard_films(titles, b.with_film_ids(people)).select("id", "title", "year", "character_count")


@query("dashboard_characters_from_documents", f"""
WITH {DOCS}, {MEDIA}, {PEOPLE}, {LINKED} SELECT {SLUG.format("name")} || '-' || (row_number() OVER (ORDER BY s, source_file, gp, pos) - 1) AS id,
  name, coalesce(role, 'unknown') AS role, voice_actor,
  '["' || lower(replace(media_title, ' ', '-')) || '-' || media_year || '"]' AS film_ids, {SLUG.format("franchise")} AS franchise_id
FROM linked""")
def _(t):
    people = doc.character_rows(parsed(t), first_for_lists=True, franchise_year=True, unnamed="Unknown")
    return b.dashboard_characters(people).select("id", "name", "role", "voice_actor", "film_ids", "franchise_id")


@query("dashboard_franchises", with_views(
    """SELECT fr.id, fr.name, fr.studio_id, (SELECT count(*) FROM films f JOIN media m ON m.id = f.media_id
         WHERE m.franchise_id = fr.id) AS film_count FROM franchises fr""", "franchises", "films", "media"))
def _(t):
    films = t.films.join(t.media.select(F.col("id").alias("media_id"), "franchise_id"), "media_id")
    return b.dashboard_franchises(t.franchises, films)


@query("dashboard_studios", with_views(
    """SELECT s.id, s.name, (SELECT count(*) FROM films f WHERE f.studio_id = s.id) AS film_count,
         (SELECT count(*) FROM franchises fr WHERE fr.studio_id = s.id) AS franchise_count,
         (SELECT count(*) FROM characters c WHERE c.studio_id = s.id) AS character_count
       FROM studios s""", "studios", "films", "characters", "franchises"))
def _(t):
    return b.dashboard_studios(t.studios.select("id", "name"), t.films, t.franchises, t.characters)


@query("explode_appearances", """
SELECT p_partkey, p_name AS media_title, CAST(p_size + 1970 AS INTEGER) AS media_year FROM part
UNION ALL SELECT p_partkey, p_name || ' 2', CAST(p_size + 1973 AS INTEGER) FROM part""")
def _(t):
    year = (F.col("p_size") + 1970).cast("int")
    first = F.struct(F.col("p_name").alias("title"), year.alias("year"))
    second = F.struct(F.concat("p_name", F.lit(" 2")).alias("title"), (year + 3).alias("year"))
    records = t.raw("part").select("p_partkey", F.array(first, F.lit(None).cast("struct<title: string, year: int>"), second).alias("appearances"))
    return doc.explode_appearances(records)


# ---------------------------------------------------------------- games


def game_documents(t):
    body = F.struct(
        F.col("p_type").alias("franchise"), F.concat("p_brand", F.lit(" / "), "p_type").alias("studio"),
        F.array(F.concat("p_name", F.lit(" "), "p_partkey", F.lit(" (2004)")), F.concat(F.lit("Remake "), "p_partkey", F.lit(" (2010)"))).alias("games"),
        F.create_map(
            F.lit("first"), F.struct(F.lit(2004).alias("year"), F.lit("Wii/PS2, ds").alias("platform"), F.lit("Second House").alias("developer")),
            F.lit("another"), F.struct(F.lit(2004).alias("year"), F.lit("PC").alias("platform"), F.lit("Fourth House").alias("developer")),
            F.lit("other"), F.struct(F.lit(1999).alias("year"), F.lit("PC").alias("platform"), F.lit("Third House").alias("developer")),
        ).alias("categories"))
    path = F.concat(F.lit("/data/games/g_"), "p_partkey", F.lit(".json"))
    return t.raw("part").select(F.to_json(body).alias("value"), path.alias("path"))


GAMES = """games AS (SELECT p_partkey AS k, p_name || ' ' || p_partkey AS title, 2004 AS year, p_type AS franchise, 'Second House' AS developer,
    p_brand AS publisher, 'Nintendo DS|Nintendo Wii|PlayStation 2' AS platforms FROM part
  UNION ALL SELECT p_partkey, 'Remake ' || p_partkey, 2010, p_type, p_type, p_brand, '' FROM part)"""


@query("flatten_games", f"WITH {GAMES} SELECT title, year, franchise, developer, publisher, platforms FROM games")
def _(t):
    rows = doc.game_rows(doc.parse_documents(game_documents(t)))
    return rows.select("title", "year", "franchise", "developer", "publisher", F.array_join("platforms", "|").alias("platforms"))


@query("build_games", f"""
WITH {GAMES} SELECT g.title, g.year, g.developer, g.publisher, p.name AS platform FROM games g
LEFT JOIN (VALUES (2004, 'Nintendo DS'), (2004, 'Nintendo Wii'), (2004, 'PlayStation 2')) AS p(year, name) ON p.year = g.year""")
def _(t):
    rows = written(doc.game_rows(doc.parse_documents(game_documents(t))))
    records = rows.select("title", "year", "franchise", F.lit("game").alias("media_type"))
    franchises = records.select(F.col("franchise").alias("name")).distinct().withColumn("id", F.xxhash64("name"))
    media = b.build_media(records, franchises)
    games = written(b.build_games(rows, media))
    platforms = b.build_platforms(games, t.platforms.filter(F.col("name") != "Nintendo Wii"))
    links = b.build_game_platforms(games, platforms).join(platforms.withColumnRenamed("id", "platform_id"), "platform_id")
    titled = games.join(media.select(F.col("id").alias("media_id"), "title", "year"), "media_id")
    return titled.withColumnRenamed("id", "game_id").join(links, "game_id", "left").select(
        "title", "year", "developer", "publisher", F.col("name").alias("platform"))


# ---------------------------------------------------------------- soundtracks and awards

ALBUM = """[{"film": "Film ~k", "film_year": 1994, "releases": [
  {"title": "Album ~k", "label": null, "conductor": "Leader ~v", "composers": ["Writer ~v", "Various Classical"],
   "album_awards": [{"award": "Oscar", "category": "Best Original Score", "year": 1995, "result": "won"}],
   "tracks": [{"title": "Song A", "composer": "Writer ~v", "performers": [{"name": " Singer ~v ", "type": "Voice"}, {"name": "Band ~v"}],
               "awards": [{"award": "Local Prize", "category": "Best Song", "year": 1995, "result": "unknown"}]},
              {"composer": "Nobody"}, {"title": "Song B", "type": "score"}]},
  {"title": "Album ~k", "label": "Old label", "tracks": []},
  {"title": "Album ~k", "label": "Label ~v", "tracks": []}, {"title": "Album ~k", "label": null, "tracks": []}]},
 {"film": "No year", "releases": [{"title": "Lost"}]}]"""


def soundtrack_files(t, album=ALBUM):
    """One soundtrack file per order."""
    text = F.replace(F.lit(album), F.lit("~k"), F.col("o_orderkey").cast("string"))
    return t.raw("orders").select(F.replace(text, F.lit("~v"), (F.col("o_custkey") % 10).cast("string")).alias("value"))


def soundtracks(t):
    return doc.soundtrack_entries(soundtrack_files(t))


@query("flatten_releases", """
SELECT 'Film ' || o_orderkey AS film, 'Album ' || o_orderkey AS release_title, p AS release_position,
  CASE p WHEN 1 THEN 'Old label' WHEN 2 THEN 'Label ' || (o_custkey % 10) END AS label FROM orders, (VALUES (0), (1), (2), (3)) AS v(p)""")
def _(t):
    return doc.release_rows(soundtracks(t)).select("film", "release_title", "release_position", "label")


@query("flatten_tracks", """
SELECT 'Film ' || o_orderkey AS film, CAST(1994 AS INTEGER) AS film_year, 'Album ' || o_orderkey AS release_title, song AS song_title,
  n AS track_number, kind AS track_type FROM orders, (VALUES ('Song A', 1, 'song'), ('Song B', 3, 'score')) AS v(song, n, kind)""")
def _(t):
    return doc.track_rows(doc.release_rows(soundtracks(t))).drop("composer", "performers", "awards")


@query("flatten_credits", """
SELECT 'Album ' || o_orderkey AS release_title, song AS song_title, who || ' ' || (o_custkey % 10) AS name, kind AS credit_type
FROM orders, (VALUES ('Song A', 'Singer', 'performer'), ('Song A', 'Band', 'performer'), ('Song A', 'Writer', 'composer'),
  (NULL, 'Writer', 'composer'), (NULL, 'Leader', 'conductor')) AS v(song, who, kind)""")
def _(t):
    releases = doc.release_rows(soundtracks(t))
    credits = doc.song_credit_rows(doc.track_rows(releases)).unionByName(doc.album_credit_rows(releases), allowMissingColumns=True)
    return credits.select("release_title", "song_title", "name", "credit_type")


@query("flatten_awards", """
SELECT 'Film ' || o_orderkey AS film, body AS award_body, category, CAST(1995 AS INTEGER) AS ceremony_year, result AS outcome, song AS song_title
FROM orders, (VALUES ('Academy Awards', 'Best Original Score', 'won', NULL), ('Local Prize', 'Best Song', 'nominated', 'Song A')) AS v(body, category, result, song)""")
def _(t):
    return doc.award_rows(soundtracks(t)).drop("film_year")


def music(t):
    """Media, soundtracks and songs built from the soundtrack files."""
    releases = written(doc.release_rows(soundtracks(t)), packed=True)
    films = releases.select(F.col("film").alias("title"), F.col("film_year").alias("year"), F.col("film").alias("franchise"), F.lit("film").alias("media_type"))
    albums = b.soundtrack_media(releases)
    franchises = sorting(albums.select(F.col("franchise").alias("name")).distinct().withColumn("id", F.xxhash64("name")))
    media = written(b.build_media(films.unionByName(albums), franchises), packed=True)
    tracks = written(doc.track_rows(releases), packed=True)
    built = written(b.build_soundtracks(releases, media), packed=True)
    return releases, media, tracks, built, written(b.build_songs(tracks, built), packed=True)


@query("build_soundtracks", """
SELECT 'Album ' || o_orderkey AS release_title, 'Film ' || o_orderkey AS source_title, 'Label ' || (o_custkey % 10) AS label FROM orders""")
def _(t):
    _, media, _, built, _ = music(t)
    source = media.select(F.col("id").alias("source_media_id"), F.col("title").alias("source_title"))
    return built.join(sorting(source), "source_media_id").select("release_title", "source_title", "label")


@query("build_song_credits", """
SELECT 'Album ' || o_orderkey AS release_title, 'Song A' AS song, who || ' ' || (o_custkey % 10) AS name, kind AS credit_type
FROM orders, (VALUES ('Singer', 'performer'), ('Band', 'performer'), ('Writer', 'composer')) AS v(who, kind)""")
def _(t):
    _, _, tracks, built, songs = music(t)
    credits = doc.song_credit_rows(tracks)
    talent = written(b.build_talent(credits, "name"))  # few names may have most credits: its size decides on the join
    links = b.build_song_credits(credits, songs, built, talent, t.credit_types)
    albums = sorting(built.select(F.col("id").alias("soundtrack_id"), "release_title"))
    titles = songs.select(F.col("id").alias("song_id"), "soundtrack_id", F.col("title").alias("song")).join(albums, "soundtrack_id")
    named = links.drop("id").join(sorting(titles), "song_id")
    named = named.join(talent.select(F.col("id").alias("talent_id"), "name"), "talent_id")
    return named.join(t.credit_types.select(F.col("id").alias("credit_type_id"), F.col("name").alias("credit_type")), "credit_type_id").select(
        "release_title", "song", "name", "credit_type")


@query("build_nominations", """
SELECT 'Film ' || o_orderkey AS film, body AS award_body, category, level AS is_media_level, CAST(1995 AS INTEGER) AS year, result AS outcome, song AS song_title
FROM orders, (VALUES ('Academy Awards', 'Best Original Score', 'won', NULL, false), ('Local Prize', 'Best Song', 'nominated', 'Song A', false)) AS v(body, category, result, song, level)""")
def _(t):
    _, media, _, built, songs = music(t)
    awards = written(doc.award_rows(soundtracks(t)), packed=True)
    bodies = written(b.build_award_bodies(awards, t.award_bodies))
    categories = written(b.build_award_categories(awards, bodies, t.award_categories))
    rows = b.nomination_rows(awards, bodies, categories, media, b.song_lookup(songs, built, media))
    named = rows.join(sorting(media.select(F.col("id").alias("media_id"), F.col("title").alias("film"))), "media_id")
    kinds = categories.select(F.col("id").alias("award_category_id"), "award_body_id", F.col("name").alias("category"), "is_media_level")
    named = named.join(kinds, "award_category_id").join(bodies.select(F.col("id").alias("award_body_id"), F.col("name").alias("award_body")), "award_body_id")
    sung = sorting(songs.select(F.col("id").alias("song_id"), F.col("title").alias("song_title")))
    return named.join(sung, "song_id", "left").select("film", "award_body", "category", "is_media_level", "year", "outcome", "song_title")


# ---------------------------------------------------------------- shorts


@query("flatten_shorts", """
SELECT 's_' || p_partkey || '.json' AS source_file, p_name AS title, CAST(p_size + 1970 AS INTEGER) AS year, p_brand AS studio, 'One|Two' AS directors,
  p_type AS released_with FROM part""")
def _(t):
    short = F.struct(F.col("p_name").alias("title"), (F.col("p_size") + 1970).alias("year"), F.col("p_brand").alias("studio"),
                     F.array(F.lit("One"), F.lit("Two")).alias("directors"), F.col("p_type").alias("released_with"))
    files = t.raw("part").select(F.to_json(F.struct(F.array(short).alias("shorts"))).alias("value"),
                                 F.concat(F.lit("/data/awards/s_"), "p_partkey", F.lit(".json")).alias("path"))
    return doc.shorts_rows(doc.parse_documents(files)).select(
        "source_file", "title", "year", "studio", F.array_join("directors", "|").alias("directors"), "released_with")


@query("catalogue_files", f"""
SELECT p_partkey FROM part WHERE NOT (starts_with(name, '00_') OR contains(lower(name), 'summary') OR contains(lower(name), 'soundtracks'))
  AND name NOT IN ({_quoted(fv.GAME_FOLDERS)})""".replace("FROM part WHERE", """FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '00_' WHEN 1 THEN 'A_Summary'
  WHEN 2 THEN 'x_soundtracks' ELSE '' END || p_name AS name FROM part) WHERE"""))
def _(t):
    size = F.col("p_size") % 4
    name = F.concat(F.when(size == 0, "00_").when(size == 1, "A_Summary").when(size == 2, "x_soundtracks").otherwise(""), "p_name")
    return t.raw("part").filter(doc.is_catalogue_file(name)).select("p_partkey")


# ---------------------------------------------------------------- the whole catalogue in one run


def event_reports(t):
    """Events as box-office reports of the first film of a document; some lack a state, which their contract forbids."""
    day = F.to_date("ts")
    week = (F.floor(F.date_diff(day, F.lit("2024-01-01").cast("date")) / 7) + 1).cast("int")
    return t.raw("events").select(
        F.concat(F.lit("ALPHA "), "user_id").alias("film_title"), F.lit(1990).alias("film_year"), F.lit("x").alias("franchise"),
        F.date_format("ts", "yyyy-MM-dd").alias("report_date"), F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("state_code"),
        F.col("value").alias("revenue"), week.alias("week_number"), (F.weekday(day) >= 4).alias("is_weekend"))


RUN_COUNTS = f"""
WITH {DOCS}, n AS (SELECT count(*) FILTER (s = 'F') AS f, count(*) FILTER (s = 'O') AS o, count(*) FILTER (s = 'P') AS p, count(*) AS d,
    count(DISTINCT c) FILTER (s = 'F') AS sagas, count(DISTINCT v) FILTER (s = 'F') AS voices FROM docs),
  a AS (SELECT count(*) AS albums, count(DISTINCT o_custkey % 10) AS names FROM orders),
  e AS (SELECT count(*) FILTER (event_id % 50 <> 0) AS good, count(*) FILTER (event_id % 50 = 0) AS bad,
    count(DISTINCT user_id) FILTER (event_id % 50 <> 0) AS shown,
    count(DISTINCT (user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7)) FILTER (event_id % 50 <> 0) AS weeks FROM events)
SELECT stage, "table", CAST(rows AS BIGINT) AS rows, CAST(0 AS BIGINT) AS violations, 'written' AS state FROM n, a, e, (
  LATERAL (VALUES ('documents', 'documents', d), ('film_records', 'raw_films', 2 * f), ('film_records', 'rejected_films', 0),
    ('character_records', 'raw_characters', 5 * f + o + 2 * p), ('character_records', 'rejected_characters', 0), ('raw_games', 'raw_games', o),
    ('music_records', 'raw_releases', 4 * albums), ('music_records', 'raw_tracks', 2 * albums), ('music_records', 'raw_awards', 2 * albums),
    ('report_records', 'raw_reports', good), ('report_records', 'rejected_reports', bad),
    ('lookups', 'roles', {len(fv.ROLES)}), ('lookups', 'genders', {len(fv.GENDERS)}), ('lookups', 'credit_types', {len(fv.CREDIT_TYPES)}),
    ('studios', 'studios', least(f, 1)), ('franchises', 'franchises', sagas + o + albums), ('media', 'media', 2 * f + o + albums), ('films', 'films', 2 * f),
    ('talent', 'talent', voices + 4 * names), ('species', 'species', {len(fv.SPECIES)} + least(d, 1)), ('characters', 'characters', 4 * f + sagas + o + 2 * p),
    ('character_appearances', 'character_appearances', 10 * f), ('games', 'games', o), ('platforms', 'platforms', {len(fv.PLATFORMS)}),
    ('game_platforms', 'game_platforms', 0), ('game_sales', 'game_sales', 0), ('soundtracks', 'soundtracks', albums), ('songs', 'songs', 2 * albums),
    ('song_credits', 'song_credits', 3 * albums), ('award_bodies', 'award_bodies', {len(fv.AWARD_BODIES)} + least(albums, 1)),
    ('award_categories', 'award_categories', {len(fv.AWARD_CATEGORIES)} + least(albums, 1)), ('nominations', 'nominations', 2 * f),
    ('box_office_daily', 'box_office_daily', good), ('box_office_weekly', 'box_office_weekly', weeks), ('box_office_total', 'box_office_total', shown)
  ) AS t(stage, "table", rows))"""


def run_catalogue(t, root, **options):
    album = ALBUM.replace("Film ~k", "Alpha ~k").replace("1994", "1990")
    stages = catalogue_graph(order_documents(t), soundtrack_files(t, album), event_reports(t))
    return run_graph(t.spark, stages, root, at_once=6, **options)


@query("catalogue_run", RUN_COUNTS)
def _(t):
    """All tables from documents, soundtracks and reports: rows and violations of each, as the run reports them."""
    return run_catalogue(t, fresh_folder(t.spark, "catalogue")).drop("position")


@query("catalogue_run_nominations", f"""
WITH {DOCS} SELECT 'Alpha ' || k AS media_title, CAST(1990 AS INTEGER) AS media_year, body AS award_body, category, CAST(1995 AS INTEGER) AS ceremony_year, result AS outcome
FROM docs, (VALUES ('Academy Awards', 'Best Original Score', 'won'), ('Local Prize', 'Best Song', 'nominated')) AS a(body, category, result) WHERE s = 'F'""")
def _(t):
    """The nominations view on the tables that a run has written; a second attempt of the run finds all stages finished."""
    root = fresh_folder(t.spark, "catalogue")
    run_catalogue(t, root)
    run_catalogue(t, root)
    named = views.v_nominations(Tables.from_parquet(t.spark, root))
    return named.select("media_title", "media_year", "award_body", "category", "ceremony_year", "outcome")
