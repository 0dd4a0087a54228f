"""Conformed tables from raw records and flattened documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import normalize as nz
from reelweave.functions.text import blank_to_null, slugify
from reelweave.operators import documents as doc
from reelweave.operators.keys import (
    build_dim, dense_index, first_per_key, get_or_create_ids, resolve_lookup, slug_ids, surrogate_key,
)
from reelweave.operators.relational import composite_lookup, with_branch_counts, with_child_count
from reelweave.session import handoff, sorting
from reelweave.sinks.upsert import upsert_columns

ORDER_OF_FILES = ["source_dir", "source_file", "position"]


# ---- catalogue tables from raw film and character records


def build_studios(raw_films: DataFrame) -> DataFrame:
    rows = raw_films.select(
        F.col("studio").alias("name"),
        F.col("studio_founded").alias("years_active_start"),
        F.col("studio_closed").alias("years_active_end"),
        F.col("studio_status").alias("status"),
    )
    order = [F.asc_nulls_last(c) for c in ("years_active_start", "years_active_end", "status")]
    return build_dim(rows, "name", ["years_active_start", "years_active_end", "status"], order)


def build_franchises(raw_films: DataFrame) -> DataFrame:
    """Franchises with the studio that is alphabetically first among those of their films."""
    rows = raw_films.select(F.col("franchise").alias("name"), blank_to_null(F.col("studio")).alias("studio"))
    built = build_dim(rows, "name", ["studio"], [F.asc_nulls_last("studio")])
    studio_id = F.when(F.col("studio").isNotNull(), surrogate_key("studio"))
    return built.select("id", "name", studio_id.alias("studio_id"))


def build_media(records: DataFrame, franchises: DataFrame) -> DataFrame:
    """Titles unique by (title, year, type), letter case aside; the alphabetically first franchise is kept."""
    key = [F.lower("title"), F.col("year"), F.col("media_type")]
    order = [F.asc("title"), F.asc_nulls_last("franchise")]
    # the order tells apart all rows that differ, so they need not be distinct
    rows = first_per_key(records.select("title", "year", "franchise", "media_type"), key, order)
    named = composite_lookup(rows, franchises, {"franchise": "name"}, {"id": "franchise_id"})
    return named.select(
        surrogate_key(F.lower("title"), F.col("year"), F.col("media_type")).alias("id"),
        "title", "year", "franchise_id", "media_type",
    )


def build_films(raw_films: DataFrame, media: DataFrame, studios: DataFrame) -> DataFrame:
    titles = media.filter(F.col("media_type") == "film")
    rows = raw_films.select(F.lower("title").alias("title"), "year", "studio", "animation_type")
    first = first_per_key(
        rows.distinct(), ["title", "year"], [F.asc_nulls_last("studio"), F.asc_nulls_last("animation_type")]
    )
    placed = composite_lookup(
        first, titles, {"title": "title", "year": "year"}, {"id": "media_id"}, any_case=["title"]
    )
    owned = composite_lookup(placed, studios, {"studio": "name"}, {"id": "studio_id"})
    return owned.select(surrogate_key("media_id").alias("id"), "media_id", "studio_id", "animation_type")


def raw_films_from_documents(docs: DataFrame) -> DataFrame:
    """Film records of documents: canonical studio with its facts, one record per (title, year)."""
    films = doc.media_rows(docs).filter((F.col("media_type") == "film") & F.col("year").isNotNull())
    studio = nz.studio_name(F.col("raw_studio"), F.col("source_dir"))
    rows = films.withColumn("studio", studio).filter(F.col("studio").isNotNull())
    first = first_per_key(
        rows, [F.lower("title"), F.col("year")], [F.asc("source_dir"), F.asc("source_file"), F.asc("position")]
    )
    facts = nz.studio_facts(F.col("studio"))
    return first.select(
        "title", "year", "studio", facts["founded"].alias("studio_founded"), facts["closed"].alias("studio_closed"),
        facts["status"].alias("studio_status"), "franchise",
        nz.animation_type(F.col("raw_animation_type"), F.col("title")).alias("animation_type"), "source_file",
    )


def raw_characters_from_documents(docs: DataFrame) -> DataFrame:
    """Character records of documents: the year of their category, and the dated films of the document as appearances."""
    people = doc.character_rows(docs, unnamed="Unknown", titles=True)
    return people.select(
        "name", "franchise", nz.role_alias(F.col("role")).alias("role"), nz.gender_alias(F.col("gender")).alias("gender"),
        F.coalesce("species", F.lit("unknown")).alias("species"), "voice_actor",
        F.col("category_year").alias("first_appearance_year"), "appearances", "notes", "source_dir", "source_file",
    )


def build_talent(names: DataFrame, column: str = "voice_actor", primary_only: bool = False) -> DataFrame:
    """Voice actors; with ``primary_only`` the first name of a list, without remarks in brackets."""
    name = nz.primary_actor(F.col(column)) if primary_only else F.col(column)
    return build_dim(names.select(name.alias("name")), "name")


def build_characters(
    raw: DataFrame, roles: DataFrame, genders: DataFrame, default_role: str | None = None, franchises: DataFrame | None = None,
    species: DataFrame | None = None,
) -> DataFrame:
    """Characters unique by (name, franchise); the alphabetically first attributes are kept. The studio is that of the
    franchise, null without a table of franchises. ``species`` stays as given; its canonical name is looked up in the table
    of species (null without one), subtype and flag are read from the text."""
    rows = raw.select(
        "name", "franchise", nz.role_alias(F.col("role")).alias("role"), nz.gender_alias(F.col("gender")).alias("gender"),
        # never a constant, which would leave the join of the texts below without a key
        F.when(F.length("name") >= 0, F.col("species")).alias("species"), "first_appearance_year",
    ).filter(blank_to_null(F.col("name")).isNotNull())
    order = [F.asc_nulls_last(c) for c in ("first_appearance_year", "role", "gender", "species")]
    first = first_per_key(rows, ["name", "franchise"], order)
    with_role = resolve_lookup(first, roles, F.col("role"), "role_id", default_role)
    with_gender = resolve_lookup(with_role, genders, F.col("gender"), "gender_id", "n/a" if default_role else None)
    if franchises is None:
        owned = with_gender.withColumn("studio_id", F.lit(None).cast("bigint"))
    else:
        owned = composite_lookup(with_gender, franchises, {"franchise": "name"}, {"studio_id": "studio_id"})
    # the texts are read once each, however many characters share one
    texts = rows.select(F.col("species").alias("_text")).distinct().withColumn("_species", nz.species_parts(F.col("_text")))
    parted = owned.join(texts, F.col("species").eqNullSafe(F.col("_text")), "left").drop("_text")
    if species is None:
        parted = parted.withColumn("species_id", F.lit(None).cast("bigint"))
    else:
        named = parted.withColumn("_name", F.col("_species.species"))
        parted = composite_lookup(named, species, {"_name": "name"}, {"id": "species_id"})
    return parted.select(
        surrogate_key("name", "franchise").alias("id"), "name", "franchise", "role_id", "gender_id", "species",
        "first_appearance_year", "studio_id", "species_id", F.col("_species.subtype").alias("species_subtype"),
        "_species.is_anthropomorphic",
    )


def build_appearances(raw: DataFrame, media: DataFrame, roles: DataFrame) -> DataFrame:
    """Character-media junction of raw records, one row per pair and variant; records without these columns have no
    variant and no notes.

    The ids of ``build_characters`` and ``build_talent`` are hashes of natural keys that every record carries, so they
    are computed in place; only media, which not every record matches, and the roles need a join. Soundtracks that
    share title and year with their film have no cast.
    """
    given = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in ("variant", "notes")]
    records = doc.explode_appearances(raw.select("name", "franchise", "voice_actor", "role", "appearances", *given))
    rows = records.select(
        F.when(F.col("name").isNotNull() & F.col("franchise").isNotNull(), surrogate_key("name", "franchise")).alias(
            "character_id"
        ),
        blank_to_null(F.col("voice_actor")).alias("voice_actor"),
        nz.role_alias(F.col("role")).alias("role"),
        "media_title",
        "media_year",
        "variant",
        "notes",
    )
    titles = media.filter(F.col("media_type") != "soundtrack")
    placed = composite_lookup(
        rows, titles, {"media_title": "title", "media_year": "year"}, {"id": "media_id"}, "inner", ["media_title"]
    )
    with_role = resolve_lookup(placed, roles, F.col("role"), "role_id")
    order = [F.asc_nulls_last("voice_actor"), F.asc_nulls_last("role_id"), F.asc_nulls_last("notes")]
    present = with_role.filter(F.col("character_id").isNotNull())
    pair = ["character_id", "media_id"]
    plain = F.when(F.col("variant").isNull(), surrogate_key(*pair)).otherwise(surrogate_key(*pair, "variant"))
    # the id of the voice follows from its name: taken here, it is not shuffled beside it
    talent_id = F.when(F.col("voice_actor").isNotNull(), surrogate_key("voice_actor"))
    return first_per_key(present, [*pair, "variant"], order).select(
        plain.alias("id"), *pair, talent_id.alias("talent_id"), "role_id", "variant", "notes"
    )


# ---- games


def build_games(game_rows: DataFrame, media: DataFrame) -> DataFrame:
    """Games unique by (title, year), with publisher and developer."""
    titles = media.filter(F.col("media_type") == "game")
    first = first_per_key(game_rows, [F.lower("title"), F.col("year")], ORDER_OF_FILES)
    placed = composite_lookup(
        first, titles, {"title": "title", "year": "year"}, {"id": "media_id"}, "inner", ["title"]
    )
    return placed.select(surrogate_key("media_id").alias("id"), "media_id", "developer", "publisher", "platforms")


def build_platforms(games: DataFrame, platforms: DataFrame) -> DataFrame:
    return get_or_create_ids(platforms, games.select(F.explode("platforms").alias("name")))


def build_game_platforms(games: DataFrame, platforms: DataFrame) -> DataFrame:
    links = games.select(F.col("id").alias("game_id"), F.explode("platforms").alias("name"))
    ids = platforms.select("name", F.col("id").alias("platform_id"))
    return links.join(ids, "name").select("game_id", "platform_id").distinct()


# ---- soundtracks


def build_soundtracks(releases: DataFrame, media: DataFrame) -> DataFrame:
    """Soundtracks unique by (title, year); the last label given wins."""
    place = F.struct("film", "release_position")
    merged = releases.groupBy(F.lower("release_title").alias("_title"), "film_year").agg(
        F.min(F.struct("film", "release_position", "release_title")).alias("_first"),
        F.max_by("label", F.when(F.col("label").isNotNull(), place)).alias("label"),
    )
    merged = merged.select("_first.film", "film_year", "_first.release_title", "label")
    albums = media.filter(F.col("media_type") == "soundtrack")
    films = media.filter(F.col("media_type") == "film")
    placed = composite_lookup(
        merged, albums, {"release_title": "title", "film_year": "year"}, {"id": "media_id"}, "inner", ["release_title"], large=True
    )
    sourced = composite_lookup(
        placed, films, {"film": "title", "film_year": "year"}, {"id": "source_media_id"}, any_case=["film"], large=True
    )
    return sourced.select(
        surrogate_key("media_id").alias("id"), "media_id", "source_media_id", "label", "release_title", "film_year"
    )


def soundtrack_media(releases: DataFrame) -> DataFrame:
    """Media records of the releases; the franchise is the film."""
    return releases.select(
        F.col("release_title").alias("title"), F.col("film_year").alias("year"), F.col("film").alias("franchise"),
        F.lit("soundtrack").alias("media_type"),
    )


def _on_album(rows: DataFrame, soundtracks: DataFrame) -> DataFrame:
    return composite_lookup(
        rows, soundtracks, {"release_title": "release_title", "film_year": "film_year"}, {"id": "soundtrack_id"},
        "inner", ["release_title"], large=True,
    )


def build_songs(tracks: DataFrame, soundtracks: DataFrame) -> DataFrame:
    """Songs unique by (soundtrack, title); the first track number is kept."""
    placed = _on_album(tracks, soundtracks)
    songs = placed.groupBy("soundtrack_id", F.col("song_title").alias("title")).agg(
        F.min("track_number").alias("track_number")
    )
    return songs.select(surrogate_key("soundtrack_id", "title").alias("id"), "soundtrack_id", "title", "track_number")


def build_song_credits(
    credits: DataFrame, songs: DataFrame, soundtracks: DataFrame, talent: DataFrame, credit_types: DataFrame
) -> DataFrame:
    on_song = composite_lookup(
        _on_album(credits, soundtracks), songs, {"soundtrack_id": "soundtrack_id", "song_title": "title"}, {"id": "song_id"}, "inner",
        large=True,
    )
    named = composite_lookup(on_song, talent, {"name": "name"}, {"id": "talent_id"}, "inner")
    typed = composite_lookup(named, credit_types, {"credit_type": "name"}, {"id": "credit_type_id"}, "inner")
    links = typed.select("song_id", "talent_id", "credit_type_id").distinct()
    return links.select(surrogate_key("song_id", "talent_id", "credit_type_id").alias("id"), "*")


# ---- awards


def build_award_bodies(awards: DataFrame, bodies: DataFrame) -> DataFrame:
    return get_or_create_ids(bodies, awards.select(F.col("award_body").alias("name")))


def build_award_categories(awards: DataFrame, bodies: DataFrame, categories: DataFrame) -> DataFrame:
    """The known categories plus new ones; a category first used without a song is on media level.

    The first use is that of the first film by (title, year); of one film, awards of releases come before those of songs.
    """
    place = F.struct("film", "film_year", F.col("song_title").isNotNull())
    used = awards.groupBy("award_body", F.col("category").alias("name")).agg(
        F.min_by(F.col("song_title").isNull(), place).alias("is_media_level")
    )
    placed = composite_lookup(used, bodies, {"award_body": "name"}, {"id": "award_body_id"}, "inner")
    keys = ["award_body_id", "name"]
    missing = placed.filter(F.col("name").isNotNull()).join(categories, keys, "left_anti")
    start = F.coalesce(categories.agg(F.max("id")).scalar(), F.lit(0)) + F.lit(1)
    created = dense_index(missing.select(*keys, "is_media_level"), [F.col(k) for k in keys], "id", start)
    columns = ["id", *keys, "is_media_level"]
    return categories.select(*columns).unionByName(created.select(*columns))


def song_lookup(songs: DataFrame, soundtracks: DataFrame, media: DataFrame) -> DataFrame:
    """(film title, film year, song title) -> song, through the soundtrack's source film."""
    albums = soundtracks.select(F.col("id").alias("soundtrack_id"), F.col("source_media_id").alias("media_id"))
    films = media.select(F.col("id").alias("media_id"), F.col("title").alias("film"), F.col("year").alias("film_year"))
    rows = songs.select(F.col("id").alias("song_id"), "soundtrack_id", F.col("title").alias("song_title"))
    found = rows.join(sorting(albums), "soundtrack_id").join(sorting(films), "media_id")
    return found.groupBy("film", "film_year", "song_title").agg(F.min("song_id").alias("song_id"))


def nomination_rows(
    awards: DataFrame, bodies: DataFrame, categories: DataFrame, media: DataFrame, song_ids: DataFrame
) -> DataFrame:
    """Awards of known films with their ids; awards of unknown films are left out."""
    films = media.filter(F.col("media_type") == "film")
    placed = composite_lookup(
        awards, films, {"film": "title", "film_year": "year"}, {"id": "media_id"}, "inner", ["film"], large=True
    )
    bodied = composite_lookup(placed, bodies, {"award_body": "name"}, {"id": "award_body_id"}, "inner")
    typed = composite_lookup(
        bodied, categories, {"award_body_id": "award_body_id", "category": "name"}, {"id": "award_category_id"}, "inner"
    )
    sung = composite_lookup(
        typed, song_ids, {"film": "film", "film_year": "film_year", "song_title": "song_title"}, {"song_id": "song_id"}, large=True
    )
    rows = sung.select(
        "media_id", "award_category_id", F.col("ceremony_year").alias("year"), "outcome",
        F.lit(None).cast("bigint").alias("talent_id"), "song_id",
    )
    return rows.select(surrogate_key(*NOMINATION_KEYS).alias("id"), "*")


def skipped_awards(awards: DataFrame, media: DataFrame) -> DataFrame:
    """Awards of films that the catalogue does not have, with the number of awards by film."""
    films = media.filter(F.col("media_type") == "film").select(F.lower("title").alias("_title"), F.col("year").alias("_year"))
    known = (F.lower("film") == F.col("_title")) & (F.col("film_year") == F.col("_year"))
    return awards.join(films, known, "left_anti").groupBy("film", "film_year").agg(F.count("*").alias("awards"))


NOMINATION_KEYS = ["media_id", "award_category_id", "year", "talent_id", "song_id"]


def upsert_nominations(nominations: DataFrame, incoming: DataFrame, sequence: list[str]) -> DataFrame:
    """Only the outcome of a known nomination changes. Null key members compare as equal."""
    return upsert_columns(nominations, incoming, NOMINATION_KEYS, ["outcome"], sequence)


# ---- slug-keyed dashboard tables


def with_film_ids(people: DataFrame) -> DataFrame:
    """Adds ``film_ids``, the JSON list of the slug ids of a character's titles."""
    film_id = slugify(F.concat_ws("-", "media_title", F.col("media_year").cast("string")))
    ids = F.when(F.col("media_title").isNotNull(), F.array(film_id)).otherwise(F.array().cast("array<string>"))
    return people.withColumn("film_ids", F.to_json(ids))


def dashboard_characters(people: DataFrame) -> DataFrame:
    """Characters with slug ids: the name's slug and a running number in file order."""
    rows = with_film_ids(people).withColumns(
        {
            "role": F.coalesce("role", F.lit("unknown")),
            "species": F.coalesce("species", F.lit("unknown")),
            "gender": F.coalesce("gender", F.lit("unknown")),
            "franchise_id": slugify(F.col("franchise")),
            "studio_id": nz.lookup({k: v[0] for k, v in fv.DASHBOARD_STUDIOS.items()}, F.col("source_dir")),
        }
    )
    order = [F.col(c) for c in ("source_dir", "source_file", "group_position", "position")]
    return slug_ids(rows, slugify(F.col("name")), order).select(
        "id", "name", "role", "voice_actor", "species", "gender", "notes", "film_ids", "franchise_id", "studio_id"
    )


def dashboard_films(media_rows: DataFrame, characters: DataFrame) -> DataFrame:
    """Titles with slug ids, year 0 when there is none, and the number of characters linked to them.

    Of the characters only ``film_ids`` is read (``with_film_ids``): they need no running numbers here.
    """
    film_id = slugify(F.concat_ws("-", "title", F.col("year").cast("string")))
    if "behind" not in media_rows.columns:
        media_rows = media_rows.withColumn("behind", F.lit(0))
    rows = media_rows.select(
        film_id.alias("id"), "title", F.coalesce("year", F.lit(0)).alias("year"),
        slugify(F.col("franchise")).alias("franchise_id"),
        nz.lookup({k: v[0] for k, v in fv.DASHBOARD_STUDIOS.items()}, F.col("source_dir")).alias("studio_id"),
        "source_dir", "source_file", "behind", "position",
    )
    first = first_per_key(rows, ["id"], ["source_dir", "source_file", F.asc_nulls_first("behind"), "position"])
    links = characters.select(F.explode(F.from_json("film_ids", "array<string>")).alias("id"))
    counts = links.groupBy("id").agg(F.count("*").alias("character_count"))
    return first.join(counts, "id", "left").select(
        "id", "title", "year", "franchise_id", "studio_id",
        F.coalesce("character_count", F.lit(0)).alias("character_count"),
    )


def dashboard_franchises(names: DataFrame, films: DataFrame) -> DataFrame:
    """Franchises (id, name, studio_id) with the number of their films; the films themselves carry the franchise id."""
    first = first_per_key(names, ["id"], ["name", "studio_id"])
    return with_child_count(first, films, "franchise_id", "film_count")


def dashboard_studios(studios: DataFrame, films: DataFrame, franchises: DataFrame, characters: DataFrame) -> DataFrame:
    """Studios with the number of films, franchises and characters; studios without any stay."""
    branches = {
        "film_count": (films, "studio_id"),
        "franchise_count": (franchises, "studio_id"),
        "character_count": (characters, "studio_id"),
    }
    return with_branch_counts(studios, branches)


def build_species(names: DataFrame, species: DataFrame) -> DataFrame:
    """Species table extended by canonical names that it does not have yet."""
    # each text is read once: written first, as the filter on the name would be evaluated on all rows, below the distinct
    texts = handoff(names.select("species").distinct())
    return get_or_create_ids(species, texts.select(nz.species_name(F.col("species")).alias("name")))


def map_species(characters: DataFrame, mapping: DataFrame) -> DataFrame:
    """Exact raw value -> (species_id, subtype, flag) by a mapping table given by the caller."""
    columns = {"species_id": "species_id", "species_subtype": "species_subtype", "is_anthropomorphic": "is_anthropomorphic"}
    return composite_lookup(characters, mapping, {"species": "raw_value"}, columns)
