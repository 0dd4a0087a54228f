"""Views with all names resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelweave.functions.measures import count_where, with_share
from reelweave.operators.relational import distinct_list, lookup_inner, lookup_left, with_branch_counts
from reelweave.plans.tables import Tables


def v_media(t: Tables, keep_without_franchise: bool = False) -> DataFrame:
    join = lookup_left if keep_without_franchise else lookup_inner
    return join(t.media, t.franchises, "franchise_id", {"name": "franchise_name"}).select(
        "id", "title", "year", "media_type", "franchise_name"
    )


def v_films(t: Tables, keep_without_franchise: bool = False) -> DataFrame:
    films = t.films.select(F.col("id").alias("film_id"), "media_id", "studio_id", "animation_type")
    titled = lookup_inner(films, t.media, "media_id", {"title": "title", "year": "year", "franchise_id": "franchise_id"})
    owned = lookup_inner(titled, t.studios, "studio_id", {"name": "studio_name"})
    join = lookup_left if keep_without_franchise else lookup_inner
    return join(owned, t.franchises, "franchise_id", {"name": "franchise_name"}).select(
        "film_id", "media_id", "title", "year", "studio_name", "franchise_name", "animation_type"
    )


def v_games(t: Tables) -> DataFrame:
    games = t.games.select(F.col("id").alias("game_id"), "media_id", "developer", "publisher")
    titled = lookup_inner(games, t.media, "media_id", {"title": "title", "year": "year", "franchise_id": "franchise_id"})
    named = lookup_inner(titled, t.franchises, "franchise_id", {"name": "franchise_name"})
    links = lookup_inner(t.game_platforms, t.platforms, "platform_id", {"name": "platform"})
    return named.join(distinct_list(links, ["game_id"], "platform", "platforms"), "game_id", "left").select(
        "game_id", "media_id", "title", "year", "franchise_name", "developer", "publisher", "platforms"
    )


def v_soundtracks(t: Tables) -> DataFrame:
    albums = t.soundtracks.select(F.col("id").alias("soundtrack_id"), "media_id", "source_media_id", "label")
    titled = lookup_inner(albums, t.media, "media_id", {"title": "title", "year": "year", "franchise_id": "franchise_id"})
    named = lookup_inner(titled, t.franchises, "franchise_id", {"name": "franchise_name"})
    sourced = lookup_left(named, t.media, "source_media_id", {"title": "source_title", "media_type": "source_type"})
    return sourced.select(
        "soundtrack_id", "media_id", "title", "year", "franchise_name", "label", "source_title", "source_type"
    )


def v_songs(t: Tables) -> DataFrame:
    credits = lookup_left(t.song_credits, t.talent, "talent_id", {"name": "who"})
    credits = lookup_left(credits, t.credit_types, "credit_type_id", {"name": "kind"})
    credits = credits.withColumn("credit", F.concat("who", F.lit(" ("), "kind", F.lit(")")))
    songs = t.songs.select(F.col("id").alias("song_id"), F.col("title").alias("song_title"), "track_number",
                           "soundtrack_id")
    on_album = lookup_inner(songs, t.soundtracks, "soundtrack_id", {"media_id": "media_id"})
    titled = lookup_inner(on_album, t.media, "media_id", {"title": "soundtrack_title", "year": "year"})
    return titled.join(distinct_list(credits, ["song_id"], "credit", "credits"), "song_id", "left").select(
        "song_id", "song_title", "track_number", "soundtrack_id", "soundtrack_title", "year", "credits"
    )


def v_character_appearances(t: Tables) -> DataFrame:
    """Appearances with names; the species is the canonical one, or the text of the character where it has none."""
    rows = lookup_inner(
        t.character_appearances, t.characters.drop("role_id"), "character_id",
        {"name": "character_name", "franchise": "origin_franchise", "species": "raw_species", "species_id": "species_id",
         "species_subtype": "species_subtype", "is_anthropomorphic": "is_anthropomorphic", "gender_id": "gender_id"},
    )
    rows = lookup_inner(
        rows, t.media, "media_id", {"title": "media_title", "year": "media_year", "media_type": "media_type"}
    )
    rows = lookup_inner(rows, t.roles, "role_id", {"name": "role"})
    rows = lookup_left(rows, t.genders, "gender_id", {"name": "gender"})
    rows = lookup_left(rows, t.talent, "talent_id", {"name": "voice_actor"})
    rows = lookup_left(rows, t.species, "species_id", {"name": "species_name"})
    return rows.select(
        "id", "character_id", "media_id", "character_name", "origin_franchise",
        F.coalesce("species_name", "raw_species").alias("species"), "species_subtype", "is_anthropomorphic", "gender",
        "media_title", "media_year", "media_type", "voice_actor", "role", "variant", "notes",
    )


def v_box_office_by_film(t: Tables) -> DataFrame:
    per_film = t.box_office_daily.groupBy("film_id").agg(
        F.sum("revenue").alias("total_gross"),
        F.min("report_date").alias("release_date"),
        F.max("report_date").alias("last_date"),
        F.max("week_number").alias("weeks_in_release"),
    )
    films = t.films.select(F.col("id").alias("film_id"), "media_id")
    return lookup_inner(per_film.join(films, "film_id"), t.media, "media_id", {"title": "title", "year": "year"}).select(
        "film_id", "title", "year", "total_gross", "release_date", "last_date", "weeks_in_release"
    )


def v_game_sales_by_game(t: Tables) -> DataFrame:
    per_game = t.game_sales.groupBy("game_id").agg(
        F.sum("units_sold").alias("total_units"), F.sum("revenue").alias("total_revenue")
    )
    games = t.games.select(F.col("id").alias("game_id"), "media_id")
    return lookup_inner(per_game.join(games, "game_id"), t.media, "media_id", {"title": "title", "year": "year"}).select(
        "game_id", "title", "year", "total_units", "total_revenue"
    )


def v_nominations(t: Tables) -> DataFrame:
    rows = lookup_inner(
        t.nominations.withColumnRenamed("year", "ceremony_year"), t.media, "media_id",
        {"title": "media_title", "year": "media_year", "media_type": "media_type"},
    )
    rows = lookup_inner(
        rows, t.award_categories, "award_category_id",
        {"name": "category", "is_media_level": "is_media_level", "award_body_id": "award_body_id"},
    )
    rows = lookup_inner(rows, t.award_bodies, "award_body_id", {"name": "award_body"})
    rows = lookup_left(rows, t.talent, "talent_id", {"name": "talent_name"})
    rows = lookup_left(rows, t.songs, "song_id", {"title": "song_title"})
    return rows.select(
        "id", "media_title", "media_year", "media_type", "award_body", "category", "is_media_level", "ceremony_year",
        "outcome", "talent_name", "song_title",
    )


def v_media_awards(t: Tables) -> DataFrame:
    """Nominations and wins by title. ``total_nominations`` leaves the wins out; ``total_entries`` counts both."""
    counts = t.nominations.groupBy(F.col("media_id").alias("id")).agg(
        count_where(F.col("outcome") == "nominated").alias("total_nominations"),
        count_where(F.col("outcome") == "won").alias("total_wins"),
        F.count("*").alias("total_entries"),
    )
    joined = t.media.join(counts, "id", "left").na.fill(0, ["total_nominations", "total_wins", "total_entries"])
    return joined.select(
        F.col("id").alias("media_id"), "title", "year", "media_type", "total_nominations", "total_wins", "total_entries"
    )


def v_characters(t: Tables) -> DataFrame:
    """Characters with their own role, gender, franchise and studio."""
    rows = lookup_left(t.characters, t.genders, "gender_id", {"name": "gender"})
    rows = lookup_left(rows, t.roles, "role_id", {"name": "role"})
    rows = lookup_left(rows, t.studios, "studio_id", {"name": "studio_name"})
    return rows.select("id", "name", "species", "gender", "role", "franchise", "studio_name")


def v_gender_stats(t: Tables) -> DataFrame:
    counted = t.characters.groupBy("gender_id").agg(F.count("*").alias("character_count"))
    named = lookup_left(counted, t.genders, "gender_id", {"name": "gender"})
    per_gender = named.groupBy("gender").agg(F.sum("character_count").alias("character_count"))
    shared = with_share(per_gender, "character_count", "percentage")
    return shared.orderBy(F.desc("character_count"), F.asc_nulls_last("gender"))


def v_role_stats(t: Tables) -> DataFrame:
    counted = t.character_appearances.groupBy("role_id").agg(F.count("*").alias("character_count"))
    named = lookup_inner(counted, t.roles, "role_id", {"name": "role"})
    return named.select("role", "character_count").orderBy(F.desc("character_count"), "role")


def v_studio_stats(t: Tables) -> DataFrame:
    """Characters, films and franchises by studio; each is counted on its own, so the counts cannot multiply."""
    branches = {
        "character_count": (t.characters, "studio_id"),
        "film_count": (t.films, "studio_id"),
        "franchise_count": (t.franchises.filter(F.col("studio_id").isNotNull()), "studio_id"),
    }
    return with_branch_counts(t.studios.select("id", "name"), branches)
