"""Figures that a reader of the catalogue looks for: retention, longevity, density, decades, co-appearance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions.measures import count_where, percent, ratio
from reelweave.operators.keys import first_per_key
from reelweave.operators.relational import lookup_inner, top_k
from reelweave.plans.tables import Tables


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def era(year: Column) -> Column:
    branch = None
    for name, first, last in fv.ERAS:
        hit = year.between(first, last)
        branch = F.when(hit, name) if branch is None else branch.when(hit, name)
    return branch


def sequel_retention(t: Tables) -> DataFrame:
    """Share of the characters of each franchise's first title that appear in a later one."""
    media = t.media.filter(F.col("franchise_id").isNotNull() & F.col("year").isNotNull())
    first = first_per_key(media, ["franchise_id"], ["year", "id"]).select("franchise_id", F.col("id").alias("_first"))
    titles = media.select(F.col("id").alias("media_id"), "franchise_id").join(first, "franchise_id")
    is_first = F.col("media_id") == F.col("_first")
    seen = (
        t.character_appearances.select("character_id", "media_id")
        .join(titles, "media_id")
        .groupBy("franchise_id", "character_id")
        .agg(F.max(is_first).alias("in_first"), F.max(~is_first).alias("in_later"))
    )
    kept = seen.filter("in_first").groupBy("franchise_id").agg(
        F.count("*").alias("original"), count_where(F.col("in_later")).alias("retained")
    )
    sequels = media.groupBy("franchise_id").agg((F.count("*") - 1).alias("sequels"))
    joined = lookup_inner(kept.join(sequels, "franchise_id"), t.franchises, "franchise_id", {"name": "franchise"})
    return joined.select(
        "franchise", "original", "retained", percent(F.col("retained"), F.col("original"), 0).alias("retention"), "sequels"
    )


def franchise_longevity(t: Tables) -> DataFrame:
    spans = t.media.filter(F.col("year").isNotNull()).groupBy("franchise_id").agg(
        F.min("year").alias("start_year"), F.max("year").alias("end_year")
    )
    named = lookup_inner(spans, t.franchises, "franchise_id", {"name": "franchise"}).drop("franchise_id")
    return named.withColumn("span", F.col("end_year") - F.col("start_year")).orderBy(F.desc("span"), "franchise")


def character_density(t: Tables) -> DataFrame:
    """Characters per film by studio: distinct characters of each film, averaged over the films of the studio."""
    per_title = t.character_appearances.groupBy("media_id").agg(F.count("*").alias("n"))
    films = t.films.select("media_id", "studio_id").join(per_title, "media_id", "left")
    per_studio = films.groupBy("studio_id").agg(
        ratio(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).alias("avg_characters"), F.count("*").alias("total_films")
    )
    return lookup_inner(per_studio, t.studios, "studio_id", {"name": "studio_name"}).drop("studio_id")


def female_leads_by_decade(t: Tables) -> DataFrame:
    """Protagonists by decade of the title, with the share of female ones."""
    leads = t.roles.filter(F.col("name") == "protagonist").select(F.col("id").alias("role_id"))
    cast = t.character_appearances.select("character_id", "media_id", "role_id").join(leads, "role_id")
    cast = lookup_inner(cast, t.characters, "character_id", {"gender_id": "gender_id"})
    cast = lookup_inner(cast, t.media.filter(F.col("year").isNotNull()), "media_id", {"year": "year"})
    counted = cast.groupBy(decade(F.col("year")).alias("decade"), "gender_id").agg(F.count("*").alias("n"))
    named = lookup_inner(counted, t.genders, "gender_id", {"name": "gender"})
    per_decade = named.groupBy("decade").agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("gender") == "female", F.col("n"))), F.lit(0)).alias("female")
    )
    return per_decade.withColumn("percentage", percent(F.col("female"), F.col("total"), 0)).orderBy("decade")


def co_appearances(t: Tables, k: int | None = None) -> DataFrame:
    """Links from each franchise's most seen character to the characters it shares the franchise's titles with.

    A title has one franchise and so at most one such character: every appearance joins at most one row, and the number
    of links grows with the appearances, not with the pairs inside a title.
    """
    franchises = t.media.filter(F.col("franchise_id").isNotNull()).select(F.col("id").alias("media_id"), "franchise_id")
    cast = t.character_appearances.select("character_id", "media_id").join(franchises, "media_id")
    counts = cast.groupBy("franchise_id", "character_id").agg(F.count("*").alias("n"))
    hubs = first_per_key(counts, ["franchise_id"], [F.desc("n"), F.asc("character_id")]).drop("n")
    hub_titles = cast.join(hubs, ["franchise_id", "character_id"]).select(
        "media_id", F.col("character_id").alias("source_id")
    )
    links = (
        cast.join(hub_titles, "media_id")
        .filter(F.col("character_id") != F.col("source_id"))
        .groupBy("franchise_id", "source_id", F.col("character_id").alias("target_id"))
        .agg(F.count("*").alias("shared_titles"))
    )
    order = [F.desc("shared_titles"), F.asc("franchise_id"), F.asc("target_id")]
    return links if k is None else top_k(links, k, *order)


def wins_by_decade(t: Tables) -> DataFrame:
    return t.nominations.groupBy(decade(F.col("year")).alias("decade")).agg(
        count_where(F.col("outcome") == "won").alias("wins"), F.count("*").alias("entries")
    )


def award_entry_counts(t: Tables) -> DataFrame:
    return t.nominations.agg(
        F.count("*").alias("entries"),
        count_where(F.col("outcome") == "won").alias("wins"),
        count_where(F.col("outcome") != "won").alias("nominations"),
    )


def songs_per_era(t: Tables) -> DataFrame:
    """Songs per soundtrack by era of the album."""
    per_album = t.songs.groupBy("soundtrack_id").agg(F.count("*").alias("n"))
    albums = t.soundtracks.select(F.col("id").alias("soundtrack_id"), "media_id").join(per_album, "soundtrack_id", "left")
    dated = lookup_inner(albums, t.media, "media_id", {"year": "year"}).withColumn("era", era(F.col("year")))
    return dated.filter(F.col("era").isNotNull()).groupBy("era").agg(
        ratio(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).alias("avg_songs"), F.count("*").alias("albums")
    )


def composer_frequency(t: Tables, k: int = 10) -> DataFrame:
    """Composers by number of albums they have a song on."""
    composing = t.credit_types.filter(F.col("name") == "composer").select(F.col("id").alias("credit_type_id"))
    credits = t.song_credits.join(composing, "credit_type_id")
    on_album = lookup_inner(credits, t.songs, "song_id", {"soundtrack_id": "soundtrack_id"})
    pairs = on_album.select("talent_id", "soundtrack_id").distinct()
    counted = pairs.groupBy("talent_id").agg(F.count("*").alias("albums"))
    named = lookup_inner(counted, t.talent, "talent_id", {"name": "composer"}).drop("talent_id")
    return top_k(named, k, F.desc("albums"), F.asc("composer"))


def most_recent_films(t: Tables, n: int = 50) -> DataFrame:
    titled = lookup_inner(
        t.films.select(F.col("id").alias("film_id"), "media_id"), t.media, "media_id", {"title": "title", "year": "year"}
    )
    return top_k(titled, n, F.desc_nulls_last("year"), F.asc("film_id"))


def film_list(t: Tables, by: str = "year", studio_id: int | None = None) -> DataFrame:
    """Films newest first, or by title; optionally of one studio."""
    films = t.films if studio_id is None else t.films.filter(F.col("studio_id") == studio_id)
    titled = lookup_inner(
        films.select(F.col("id").alias("film_id"), "media_id", "studio_id"), t.media, "media_id",
        {"title": "title", "year": "year"},
    )
    order = [F.desc_nulls_last("year"), F.asc("title")] if by == "year" else [F.asc("title")]
    return titled.orderBy(*order)


def grand_totals(films: DataFrame, characters: DataFrame) -> DataFrame:
    """Number of films and characters of the whole catalogue, from the per-studio counts."""
    counts = films.groupBy("studio_id").agg(F.count("*").alias("films")).join(
        characters.groupBy("studio_id").agg(F.count("*").alias("characters")), "studio_id", "full_outer"
    )
    return counts.agg(F.sum("films").alias("films"), F.sum("characters").alias("characters"))
