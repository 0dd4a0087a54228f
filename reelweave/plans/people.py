"""Character, voice-actor and demographic queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import normalize as nz
from reelweave.functions.measures import count_where, percent, with_share
from reelweave.operators.relational import (
    gender_split, lookup_inner, lookup_left, members_of, top_k, with_child_count,
)
from reelweave.plans.tables import Tables
from reelweave.session import handoff


def franchise_demographics(t: Tables) -> DataFrame:
    """Counts by franchise. Characters are first counted by franchise, species, gender and role."""
    counted = t.characters.groupBy("franchise", "species", "gender_id", "role_id").agg(F.count("*").alias("n"))
    named = lookup_left(counted, t.genders, "gender_id", {"name": "gender"})
    named = lookup_left(named, t.roles, "role_id", {"name": "role"})

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return (
        named.groupBy("franchise")
        .agg(
            F.sum("n").alias("total_characters"),
            F.countDistinct("species").alias("unique_species"),
            total(F.col("gender") == "male").alias("male_count"),
            total(F.col("gender") == "female").alias("female_count"),
            total(F.col("gender") == "non-binary").alias("nonbinary_count"),
            total(F.col("role").isin(fv.HERO_ROLES)).alias("hero_count"),
            total(F.col("role").isin(fv.VILLAIN_ROLES)).alias("villain_count"),
        )
        .orderBy(F.desc("total_characters"), F.asc_nulls_last("franchise"))
    )


def studio_characters(t: Tables) -> DataFrame:
    """Characters by studio with the average number of appearances a character has there."""
    films = t.films.select("media_id", "studio_id")
    per_character = (
        t.character_appearances.join(films, "media_id").groupBy("studio_id", "character_id").agg(F.count("*").alias("n"))
    )
    people = lookup_inner(per_character, t.characters, "character_id", {"franchise": "franchise", "species": "species"})
    per_studio = people.groupBy("studio_id").agg(
        F.count("*").alias("total_characters"),
        F.countDistinct("franchise").alias("franchises"),
        F.countDistinct("species").alias("unique_species"),
        F.round(F.sum("n").cast("double") / F.count("*"), 2).alias("avg_appearances_per_char"),
    )
    named = lookup_inner(per_studio, t.studios, "studio_id", {"name": "studio_name"})
    return named.drop("studio_id").orderBy(F.desc("total_characters"), "studio_name")


def species_share(t: Tables, k: int = 20) -> DataFrame:
    per_species = (
        t.characters.filter(F.col("species").isNotNull())
        .groupBy("species")
        .agg(F.count("*").alias("character_count"), F.countDistinct("franchise").alias("franchises_appeared"))
    )
    return top_k(
        with_share(per_species, "character_count", "percentage"), k, F.desc("character_count"), F.asc("species")
    )


def gender_by_release_year(t: Tables) -> DataFrame:
    people = lookup_inner(
        t.character_appearances.select("character_id", "media_id"), t.characters, "character_id",
        {"gender_id": "gender_id"},
    )
    released = lookup_inner(people, t.media.filter(F.col("year").isNotNull()), "media_id", {"year": "year"})
    counted = released.groupBy("year", "gender_id").agg(F.count("*").alias("character_count"))
    named = lookup_inner(counted, t.genders, "gender_id", {"name": "gender"})
    return named.select("year", "gender", "character_count").orderBy("year", "gender")


def role_by_gender(t: Tables) -> DataFrame:
    counted = t.characters.groupBy("role_id", "gender_id").agg(F.count("*").alias("character_count"))
    named = lookup_inner(counted, t.roles, "role_id", {"name": "role"})
    named = lookup_inner(named, t.genders, "gender_id", {"name": "gender"})
    return named.select("role", "gender", "character_count").orderBy("role", F.desc("character_count"), "gender")


def actor_careers(t: Tables, min_appearances: int = 3, k: int = 50) -> DataFrame:
    """Voice actors by number of appearances. (Character, media) is the key of an appearance, so rows are counted.

    Rows are counted for all actors, distinct values only for the k found: several distinct counts lay every row out once each.
    """
    cast = t.character_appearances.filter(F.col("talent_id").isNotNull()).select("talent_id", "character_id", "media_id")

    def known(rows: DataFrame) -> DataFrame:
        rows = lookup_inner(rows, t.characters, "character_id", {"franchise": "franchise"})
        return lookup_inner(rows, t.media, "media_id", {"year": "year"})

    counted = known(cast).groupBy("talent_id").agg(F.count("*").alias("total_appearances"))
    often = counted.filter(F.col("total_appearances") >= min_appearances)
    order = [F.desc("total_appearances"), F.asc("voice_actor")]
    best = top_k(lookup_inner(often, t.talent, "talent_id", {"name": "voice_actor"}), k, *order)
    # k rows, whatever the input
    theirs = known(cast.join(F.broadcast(best.select("talent_id")), "talent_id", "left_semi"))
    measures = theirs.groupBy("talent_id").agg(
        F.countDistinct("character_id").alias("unique_characters"),
        F.countDistinct("media_id").alias("films_appeared"),
        F.countDistinct("franchise").alias("franchises"),
        F.min("year").alias("first_appearance"),
        F.max("year").alias("last_appearance"),
    )
    rows = best.join(measures, "talent_id").select(
        "total_appearances", "unique_characters", "films_appeared", "franchises", "first_appearance", "last_appearance",
        "voice_actor", (F.col("last_appearance") - F.col("first_appearance")).alias("career_span_years"),
    )
    return top_k(rows, k, *order)


def actor_box_office(t: Tables, k: int = 30) -> DataFrame:
    """Revenue of the films an actor appears in. A film counts once per appearance."""
    films = t.films.select(F.col("id").alias("film_id"), "media_id").join(
        t.box_office_total.select("film_id", "total_revenue"), "film_id", "left"
    )
    cast = (
        t.character_appearances.filter(F.col("talent_id").isNotNull())
        .groupBy("talent_id", "media_id")
        .agg(F.count("*").alias("n"))
    )
    revenue = F.col("total_revenue")
    per_actor = (
        cast.join(films, "media_id")
        .groupBy("talent_id")
        .agg(
            F.sum("n").alias("appearances"),
            F.sum(revenue * F.col("n")).alias("total_box_office"),
            F.sum(F.when(revenue.isNotNull(), F.col("n"))).alias("_reported"),
            F.max(revenue).alias("highest_grossing_film"),
        )
        .filter(F.col("total_box_office").isNotNull())
        .withColumn("avg_box_office_per_film", F.col("total_box_office").cast("double") / F.col("_reported"))
    )
    named = lookup_inner(per_actor, t.talent, "talent_id", {"name": "voice_actor"})
    return top_k(named.drop("talent_id", "_reported"), k, F.desc("total_box_office"), F.asc("voice_actor"))


def _actor_studio_counts(t: Tables) -> DataFrame:
    films = t.films.select("media_id", "studio_id")
    cast = t.character_appearances.filter(F.col("talent_id").isNotNull()).select("talent_id", "media_id")
    return cast.join(films, "media_id").groupBy("talent_id", "studio_id").agg(
        F.count("*").alias("appearances_at_studio")
    )


def actor_studio_share(t: Tables, min_appearances: int = 2) -> DataFrame:
    """Share of an actor's career by studio; pairs below the minimum are left out before the share is taken."""
    kept = _actor_studio_counts(t).filter(F.col("appearances_at_studio") >= min_appearances)
    shared = with_share(kept, "appearances_at_studio", "pct_of_career", within=["talent_id"])
    named = lookup_inner(shared, t.talent, "talent_id", {"name": "voice_actor"})
    named = lookup_inner(named, t.studios, "studio_id", {"name": "studio_name"})
    return named.select("voice_actor", "studio_name", "appearances_at_studio", "pct_of_career").orderBy(
        "voice_actor", F.desc("appearances_at_studio"), "studio_name"
    )


def exclusive_actors(t: Tables, loyal_share: float = 50.0, min_appearances: int = 2) -> DataFrame:
    """Loyal actors (at least the given share of the career) and exclusive ones (all of it) by studio."""
    shared = with_share(
        _actor_studio_counts(t), "appearances_at_studio", "_share", within=["talent_id"], digits=None
    ).filter(F.col("appearances_at_studio") >= min_appearances)
    per_studio = shared.groupBy("studio_id").agg(
        count_where(F.col("_share") >= loyal_share).alias("loyal_actors"),
        count_where(F.col("_share") == 100.0).alias("exclusive_actors"),
    )
    return lookup_inner(per_studio, t.studios, "studio_id", {"name": "studio_name"}).drop("studio_id")


def hero_actors(t: Tables, min_roles: int = 2, k: int = 20) -> DataFrame:
    heroes = t.roles.filter(F.col("name").isin(fv.HERO_ROLES))
    cast = t.character_appearances.filter(F.col("talent_id").isNotNull())
    cast = lookup_inner(cast, heroes, "role_id", {"name": "role_type"})
    cast = lookup_inner(cast, t.characters, "character_id", {"franchise": "franchise"})
    per_actor = cast.groupBy("talent_id", "role_type").agg(
        F.count("*").alias("role_count"), F.countDistinct("franchise").alias("franchises")
    )
    often = per_actor.filter(F.col("role_count") >= min_roles)
    named = lookup_inner(often, t.talent, "talent_id", {"name": "voice_actor"}).drop("talent_id")
    return top_k(named, k, F.desc("role_count"), F.asc("voice_actor"), F.asc("role_type"))


def _by_medium(t: Tables, who: str) -> DataFrame:
    """Appearances in films and games, null when there are none."""
    cast = lookup_inner(
        t.character_appearances.filter(F.col(who).isNotNull()).select(who, "media_id"), t.media, "media_id",
        {"media_type": "media_type"},
    )

    def count_of(medium: str):
        return F.nullif(count_where(F.col("media_type") == medium), F.lit(0))

    return cast.groupBy(who).agg(
        count_of("film").alias("film_appearances"),
        count_of("game").alias("game_appearances"),
        F.count("*").alias("total_appearances"),
    )


def cross_media_actors(t: Tables) -> DataFrame:
    both = _by_medium(t, "talent_id").filter(
        F.col("film_appearances").isNotNull() & F.col("game_appearances").isNotNull()
    )
    named = lookup_inner(both, t.talent, "talent_id", {"name": "voice_actor"}).drop("talent_id")
    return named.orderBy(F.desc("total_appearances"), "voice_actor")


def cross_media_characters(t: Tables, k: int | None = None) -> DataFrame:
    """Characters seen in films and in games."""
    both = _by_medium(t, "character_id").filter(
        F.col("film_appearances").isNotNull() & F.col("game_appearances").isNotNull()
    )
    named = lookup_inner(both, t.characters, "character_id", {"name": "character_name", "franchise": "franchise"})
    order = [F.desc("total_appearances"), F.asc("character_id")]
    return named.orderBy(*order) if k is None else top_k(named, k, *order)


def most_appearances(t: Tables, k: int = 10) -> DataFrame:
    best = top_k(_by_medium(t, "character_id"), k, F.desc("total_appearances"), F.asc("character_id"))
    return lookup_inner(best, t.characters, "character_id", {"name": "character_name"})


def top_characters(t: Tables, k: int = 20) -> DataFrame:
    """Characters by number of appearances, counted per character before the names are joined."""
    counted = t.character_appearances.groupBy("character_id").agg(F.count("*").alias("n"))
    named = lookup_inner(counted, t.characters, "character_id", {"name": "name", "franchise": "franchise"})
    summed = named.groupBy("name", "franchise").agg(F.sum("n").alias("appearances"))
    return top_k(summed, k, F.desc("appearances"), F.asc("name"), F.asc("franchise"))


def studio_film_counts(t: Tables) -> DataFrame:
    return with_child_count(t.studios, t.films, "studio_id", "film_count").select("name", "status", "film_count")


# ---- dashboard tables: characters with their own gender, role, studio and a JSON list of film ids


def dashboard_gender_by_year(characters: DataFrame, films: DataFrame) -> DataFrame:
    dated = films.filter(F.col("year") > 0).select(F.col("id").alias("film_id"), "year")
    cast = members_of(characters.select("gender", "film_ids"), "film_ids", dated, "film_id")
    return gender_split(cast, ["year"], with_total=True).orderBy("year")


def dashboard_gender_by_role(characters: DataFrame) -> DataFrame:
    return gender_split(characters, ["role"]).orderBy("role")


def top_talents(characters: DataFrame, k: int = 50) -> DataFrame:
    """Voice actors by characters, with the number of film links and the studios they worked for.

    Rows are first reduced to one per actor and studio. Studios are listed for the k actors found only.
    """
    films = F.size(F.from_json("film_ids", "array<string>"))
    per_studio = handoff(
        characters.filter(nz.is_real_name(F.col("voice_actor")))
        .groupBy("voice_actor", "studio_id")
        .agg(F.count("*").alias("n"), F.sum(films).alias("films"))
    )
    per_actor = per_studio.groupBy("voice_actor").agg(
        F.sum("n").alias("character_count"), F.sum("films").alias("film_count")
    )
    best = handoff(top_k(per_actor, k, F.desc("character_count"), F.asc("voice_actor")))
    lists = per_studio.join(best.select("voice_actor"), "voice_actor", "left_semi").groupBy("voice_actor")
    named = lists.agg(F.array_join(F.sort_array(F.collect_set("studio_id")), ", ").alias("studios"))
    rows = best.join(named, "voice_actor").select(F.col("voice_actor").alias("name"), "film_count", "character_count", "studios")
    return rows.orderBy(F.desc("character_count"), "name")


def prolific_actors(characters: DataFrame, k: int = 15) -> DataFrame:
    voiced = characters.filter(F.col("voice_actor").isNotNull() & (F.col("voice_actor") != ""))
    counted = voiced.groupBy(nz.first_actor(F.col("voice_actor")).alias("name")).agg(F.count("*").alias("characters"))
    return top_k(counted, k, F.desc("characters"), F.asc("name"))


def breakdown(characters: DataFrame, by: str, where: dict[str, object], k: int | None = None) -> DataFrame:
    """Characters of one studio (or any equality) counted by a column."""
    rows = characters
    for column, value in where.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    counted = rows.groupBy(by).agg(F.count("*").alias("count"))
    order = [F.desc("count"), F.asc_nulls_last(by)]
    return counted.orderBy(*order) if k is None else top_k(counted, k, *order)


def film_cast(characters: DataFrame, film_id: str) -> DataFrame:
    return characters.filter(F.array_contains(F.from_json("film_ids", "array<string>"), film_id))


def film_gender_breakdown(characters: DataFrame, film_id: str) -> DataFrame:
    return film_cast(characters, film_id).groupBy("gender").agg(F.count("*").alias("count"))


def voice_actors_per_film(characters: DataFrame) -> DataFrame:
    """Number of distinct voice actors of each film."""
    links = characters.filter(F.col("voice_actor").isNotNull() & (F.col("voice_actor") != "")).select(
        F.explode(F.from_json("film_ids", "array<string>")).alias("film_id"), "voice_actor"
    )
    return links.groupBy("film_id").agg(F.countDistinct("voice_actor").alias("voice_actors"))


def films_by_year(films: DataFrame) -> DataFrame:
    return films.groupBy("year").agg(F.count("*").alias("count")).orderBy("year")


def species_group_share(characters: DataFrame, k: int = 10) -> DataFrame:
    counted = characters.groupBy(nz.species_group(F.col("species")).alias("species")).agg(F.count("*").alias("count"))
    return top_k(with_share(counted, "count", "percentage", digits=0), k, F.desc("count"), F.asc("species"))


def villain_share(characters: DataFrame) -> DataFrame:
    """Villains by gender with their share; always three rows."""
    villains = characters.filter(F.col("role").isin(fv.VILLAIN_ROLES))
    counts = villains.agg(
        F.count("*").alias("total"),
        count_where(F.col("gender") == "male").alias("male"),
        count_where(F.col("gender") == "female").alias("female"),
    )
    rows = F.array(
        F.struct(F.lit("Male Villains").alias("category"), F.col("male").alias("count")),
        F.struct(F.lit("Female Villains").alias("category"), F.col("female").alias("count")),
        F.struct(
            F.lit("Non-binary/Other").alias("category"), (F.col("total") - F.col("male") - F.col("female")).alias("count")
        ),
    )
    share = F.coalesce(percent(F.col("count"), F.col("total"), 0), F.lit(0.0)).alias("percentage")
    return counts.select("total", F.inline(rows)).select("category", "count", share)


def role_balance(characters: DataFrame) -> DataFrame:
    """Protagonists, antagonists and sidekicks by studio."""
    return characters.groupBy("studio_id").agg(
        count_where(F.col("role").isin(fv.HERO_ROLES)).alias("protagonists"),
        count_where(F.col("role").isin(fv.VILLAIN_ROLES)).alias("antagonists"),
        count_where(F.col("role").isin(fv.SIDEKICK_ROLES)).alias("sidekicks"),
    )


def studios_by_characters(studios: DataFrame, characters: DataFrame, k: int = 5) -> DataFrame:
    counted = with_child_count(studios, characters, "studio_id", "char_count")
    return top_k(counted.select("name", "char_count"), k, F.desc("char_count"), F.asc("name"))
