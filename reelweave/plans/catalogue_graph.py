"""All conformed tables of a catalogue, from documents, soundtrack files and box-office reports, as one graph of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave.operators import documents as doc
from reelweave.operators import quality
from reelweave.operators.relational import composite_lookup
from reelweave.plans import boxoffice as bo
from reelweave.plans import builders as b
from reelweave.plans.graph import Stage
from reelweave.plans.tables import Tables
from reelweave.schemas import RAW_BOX_OFFICE, RECORD_CONTRACTS, TABLES
from reelweave.session import written
from reelweave.sinks.upsert import latest_per_key
from reelweave.sources import readers


def _species(t: Tables) -> DataFrame:
    known = readers.species(t.raw_characters.sparkSession)
    ids = b.build_species(t.raw_characters, known)
    return composite_lookup(ids, known, {"id": "id"}, {"parent_species_id": "parent_species_id"})


def _talent(t: Tables) -> DataFrame:
    """Voice actors, and everybody credited on a song or an album."""
    songs, albums = doc.song_credit_rows(t.raw_tracks), doc.album_credit_rows(t.raw_releases)
    names = [t.raw_characters.select(F.col("voice_actor").alias("name")), songs.select("name"), albums.select("name")]
    return b.build_talent(names[0].unionByName(names[1]).unionByName(names[2]), "name")


def _media(t: Tables) -> DataFrame:
    titles = ["title", "year", "franchise", "media_type"]
    films = t.raw_films.withColumn("media_type", F.lit("film")).select(*titles)
    games = t.raw_games.filter(F.col("year").isNotNull()).withColumn("media_type", F.lit("game")).select(*titles)
    return b.build_media(films.unionByName(games).unionByName(b.soundtrack_media(t.raw_releases)), t.franchises)


def _franchises(t: Tables) -> DataFrame:
    """Franchises of films with their studio, and those of games and albums, where an album's franchise is its film."""
    no_studio = F.lit(None).cast("string").alias("studio")
    games = t.raw_games.select("franchise", no_studio)
    albums = t.raw_releases.select(F.col("film").alias("franchise"), no_studio)
    return b.build_franchises(t.raw_films.select("franchise", "studio").unionByName(games).unionByName(albums))


def _nominations(t: Tables) -> DataFrame:
    rows = b.nomination_rows(
        t.raw_awards, t.award_bodies, t.award_categories, t.media, b.song_lookup(t.songs, t.soundtracks, t.media)
    )
    return latest_per_key(rows, b.NOMINATION_KEYS, ["outcome"])


def catalogue_graph(
    files: DataFrame, soundtracks: DataFrame, reports: DataFrame, game_sales: DataFrame | None = None
) -> list[Stage]:
    """The stages over ``files`` (value, path), one JSON object each, ``soundtracks`` (value), one JSON array each, box-office
    ``reports``, and sales of games, which no file brings. Records that break their contract go to tables of their own,
    with the rules they break, and no further."""
    spark = files.sparkSession

    def checked(name: str, contract: str, rows: DataFrame) -> dict[str, DataFrame]:
        # both tables come from one flattening
        kept, rejected = quality.split_by_contract(written(rows, packed=True), RECORD_CONTRACTS[contract])
        return {f"raw_{name}": kept, f"rejected_{name}": rejected}

    def music(t: Tables) -> dict[str, DataFrame]:
        entries = written(doc.soundtrack_entries(soundtracks), packed=True)  # files are parsed once for three tables
        releases = doc.release_rows(entries)
        return {"raw_releases": releases, "raw_tracks": doc.track_rows(releases), "raw_awards": doc.award_rows(entries)}

    def sales(t: Tables) -> dict[str, DataFrame]:
        return {"game_sales": spark.createDataFrame([], TABLES["game_sales"]) if game_sales is None else game_sales}

    def one(table: str, build) -> tuple:
        return (table,), lambda t: {table: build(t)}

    def stage(table: str, reads: str, build) -> Stage:
        return Stage(table, tuple(reads.split()), *one(table, build))

    def lookups(t: Tables) -> dict[str, DataFrame]:
        return {"roles": readers.roles(spark), "genders": readers.genders(spark), "credit_types": readers.credit_types(spark)}

    return [
        stage("documents", "", lambda t: doc.parse_documents(files)),
        Stage("film_records", ("documents",), ("raw_films", "rejected_films"),
              lambda t: checked("films", "film", b.raw_films_from_documents(t.documents))),
        Stage("character_records", ("documents",), ("raw_characters", "rejected_characters"),
              lambda t: checked("characters", "character", b.raw_characters_from_documents(t.documents))),
        stage("raw_games", "documents", lambda t: doc.game_rows(t.documents)),
        Stage("music_records", (), ("raw_releases", "raw_tracks", "raw_awards"), music),
        Stage("report_records", (), ("raw_reports", "rejected_reports"), lambda t: checked("reports", "box_office", reports)),
        Stage("lookups", (), ("roles", "genders", "credit_types"), lookups),
        stage("studios", "raw_films", lambda t: b.build_studios(t.raw_films)),
        stage("franchises", "raw_films raw_games raw_releases", _franchises),
        stage("media", "raw_films raw_games raw_releases franchises", _media),
        stage("films", "raw_films media studios", lambda t: b.build_films(t.raw_films, t.media, t.studios)),
        stage("talent", "raw_characters raw_releases raw_tracks", _talent),
        stage("species", "raw_characters", _species),
        stage("characters", "raw_characters roles genders franchises species", lambda t: b.build_characters(
            t.raw_characters, t.roles, t.genders, franchises=t.franchises, species=t.species)),
        stage("character_appearances", "raw_characters media roles", lambda t: b.build_appearances(t.raw_characters, t.media, t.roles)),
        stage("games", "raw_games media", lambda t: b.build_games(t.raw_games, t.media)),
        stage("platforms", "games", lambda t: b.build_platforms(t.games, readers.platforms(spark))),
        stage("game_platforms", "games platforms", lambda t: b.build_game_platforms(t.games, t.platforms)),
        Stage("game_sales", (), ("game_sales",), sales),
        stage("soundtracks", "raw_releases media", lambda t: b.build_soundtracks(t.raw_releases, t.media)),
        stage("songs", "raw_tracks soundtracks", lambda t: b.build_songs(t.raw_tracks, t.soundtracks)),
        stage("song_credits", "raw_tracks songs soundtracks talent credit_types", lambda t: b.build_song_credits(
            doc.song_credit_rows(t.raw_tracks), t.songs, t.soundtracks, t.talent, t.credit_types)),
        stage("award_bodies", "raw_awards", lambda t: b.build_award_bodies(t.raw_awards, readers.award_bodies(spark))),
        stage("award_categories", "raw_awards award_bodies", lambda t: b.build_award_categories(
            t.raw_awards, t.award_bodies, readers.award_categories(spark))),
        stage("nominations", "raw_awards award_bodies award_categories media songs soundtracks", _nominations),
        stage("box_office_daily", "raw_reports films media", lambda t: bo.build_daily(t.raw_reports, t.films, t.media)),
        stage("box_office_weekly", "box_office_daily", lambda t: bo.build_weekly(t.box_office_daily)),
        stage("box_office_total", "box_office_daily", lambda t: bo.build_total(t.box_office_daily)),
    ]


def graph_of_folder(spark: SparkSession, raw: str) -> list[Stage]:
    """The graph over ``raw/documents``, which holds soundtrack files too, and the NDJSON reports of ``raw/boxoffice``."""
    reports = readers.read_ndjson(spark, f"{raw}/boxoffice", RAW_BOX_OFFICE)
    return catalogue_graph(readers.document_files(spark, f"{raw}/documents"), readers.soundtrack_files(spark, f"{raw}/documents"), reports)
