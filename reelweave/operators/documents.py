"""Flattening of nested catalogue documents.

A document is one JSON object whose containers differ from file to file. It is parsed once into a VARIANT, with the containers
beside it as maps in the order of the text, and stored as a table (``store_documents``): the VARIANT is shredded on write, and
every flattening reads only the paths and containers it needs. Every step is a row-local expression or an explode, linear in
the document (merging the alternate container sorts its keys); no step needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import normalize as nz
from reelweave.functions.text import blank_to_null, slugify, strip
from reelweave.schemas import RELEASE, SHORT

CATEGORY = "struct<year: variant, platform: variant, developer: variant, characters: variant>"
CHARACTER = (
    "struct<name: string, role: string, species: string, gender: string, voice_actor: string, notes: string, "
    "origin: string, origin_franchise: string, singing_voice: string>"
)

MAPS = ["categories", "film_data", "characters"]
ENTRY = "array<struct<key: string, value: variant>>"


def _get(source: str | Column, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(source) if isinstance(source, str) else source, path, kind)


def parse_documents(files: DataFrame) -> DataFrame:
    """(value, path) rows -> one row per JSON object. Unparsable files and top-level arrays drop out."""
    # the parse sits inside the explode, so that dropping unparsable texts does not parse every text twice
    parsed = F.filter(F.array(F.try_parse_json("value")), lambda d: d.isNotNull())
    # objects inside a VARIANT come back with sorted keys, and each value taken out of one carries all of its names: the
    # containers are read from the text, in its order, each value as a VARIANT of its own
    entries = F.from_json("value", ", ".join(f"{c} map<string, variant>" for c in MAPS))
    people = F.from_json("value", "characters array<variant>")["characters"]
    objects = files.filter(F.col("value").rlike(r"^\s*\{")).select("path", "value", F.explode(parsed).alias("doc"))
    return objects.select(
        "doc",
        entries.alias("entries"),
        F.when(_get("doc", "$.characters", "variant").isNotNull(), people).alias("people"),
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        F.coalesce(F.get(F.split("path", "/"), F.size(F.split("path", "/")) - 2), F.lit("")).alias("source_dir"),
    )


def store_documents(docs: DataFrame, path: str) -> DataFrame:
    """Writes parsed documents as a table, replacing an older one, and reads it back."""
    docs.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def is_catalogue_file(file_name: Column) -> Column:
    """Summary files and soundtrack files are not part of the catalogue."""
    name = F.lower(file_name)
    return ~(file_name.startswith("00_") | name.contains("summary") | name.contains("soundtracks"))


def franchise_of(default: str = "Unknown") -> Column:
    """Franchise, else game, else the file name without its ending."""
    stem = blank_to_null(F.regexp_replace(F.col("source_file"), r"\.json$", ""))
    return F.coalesce(
        blank_to_null(_get("doc", "$.franchise", "string")),
        blank_to_null(_get("doc", "$.game", "string")),
        stem,
        F.lit(default),
    )


def _titles(path: str, media_type: str, keep_raw: bool) -> Column:
    """Titles of a text array. Each text is matched once; texts without a year drop out unless kept as they are."""
    texts = F.coalesce(_get("doc", path, "array<string>"), F.array().cast("array<string>"))
    matched = F.transform(
        F.transform(F.filter(texts, lambda x: x.isNotNull()), strip),
        lambda x: F.struct(
            x.alias("raw"),
            strip(F.regexp_extract(x, fv.TITLE_YEAR_PATTERN, 1)).alias("title"),
            F.regexp_extract(x, fv.TITLE_YEAR_PATTERN, 2).try_cast("int").alias("year"),
        ),
    )
    if not keep_raw:
        matched = F.filter(matched, lambda t: t.year.isNotNull())
    return F.transform(
        matched,
        lambda t: F.struct(
            F.when(t.year.isNotNull(), t.title).otherwise(t.raw).alias("title"), t.year.alias("year"),
            F.lit(media_type).alias("media_type"),
        ),
    )


def _single(path: str, media_type: str) -> Column:
    title = blank_to_null(_get("doc", path, "string"))
    entry = F.struct(
        title.alias("title"), _get("doc", "$.year", "int").alias("year"), F.lit(media_type).alias("media_type")
    )
    return F.filter(F.array(F.when(title.isNotNull(), entry)), lambda t: t.isNotNull())


def with_media(docs: DataFrame, keep_raw: bool = False, slugs: bool = False) -> DataFrame:
    """Adds ``media``: every title of the document, whichever of the four forms it uses, in document order; on demand
    with its slug."""
    media = F.concat(
        _titles("$.films", "film", keep_raw),
        _single("$.film", "film"),
        _titles("$.games", "game", keep_raw),
        _single("$.game", "game"),
    )
    return docs.withColumn("media", F.transform(media, lambda m: m.withField("slug", slugify(m.title))) if slugs else media)


def media_rows(docs: DataFrame, keep_raw: bool = False) -> DataFrame:
    """One row per title of each document."""
    return (
        with_media(docs, keep_raw)
        .select(
            "source_dir", "source_file", franchise_of().alias("franchise"),
            _get("doc", "$.studio", "string").alias("raw_studio"),
            _get("doc", "$.animation_type", "string").alias("raw_animation_type"),
            F.posexplode("media").alias("position", "m"),
        )
        .select(
            "source_dir", "source_file", "franchise", "raw_studio", "raw_animation_type", "position",
            "m.title", "m.year", "m.media_type",
        )
    )


def _entries(container: str) -> Column:
    """(key, value) of a container that is an object, in the order of the document."""
    return F.coalesce(F.map_entries(f"entries.{container}"), F.array().cast(ENTRY))


def _merged(base: Column, alternate: Column) -> Column:
    """The entries of both; of equal keys the alternate's value stands in the base's place, its other keys come behind.

    Sorting brings equal keys together, so that no key is looked up in the other container.
    """

    def placed(entries: Column, side: int) -> Column:
        return F.transform(
            entries,
            lambda e, i: F.struct(e.key.alias("key"), F.lit(side).alias("side"), i.alias("at"), e.value.alias("value")),
        )

    def order(*names: str):
        def compare(x: Column, y: Column) -> Column:
            steps = [F.when(x[n] < y[n], -1).when(x[n] > y[n], 1) for n in names]
            return F.coalesce(*steps, F.lit(0))

        return compare

    # of equal keys the alternate (side 0) comes first
    both = F.array_sort(F.concat(placed(alternate, 0), placed(base, 1)), order("key", "side"))
    # each entry with the one before and the one behind it: the sorted array beside itself, moved by one
    unnamed = F.transform(F.slice(both, 1, 1), lambda e: e.withField("key", F.lit(None).cast("string")))
    rows = F.arrays_zip(
        both.alias("e"), F.concat(unnamed, F.slice(both, 1, F.size(both) - 1)).alias("before"),
        F.slice(both, 2, F.size(both)).alias("behind"),
    )
    kept = F.filter(rows, lambda r: ~((r.e.side == 1) & F.coalesce(r.before.key == r.e.key, F.lit(False))))
    merged = F.transform(
        kept,
        lambda r: F.when(
            (r.e.side == 0) & F.coalesce(r.behind.key == r.e.key, F.lit(False)),
            F.struct(F.lit(0).alias("late"), r.behind["at"].alias("at"), r.e.key.alias("key"), r.e.value.alias("value")),
        ).otherwise(
            F.struct((1 - r.e.side).alias("late"), r.e["at"].alias("at"), r.e.key.alias("key"), r.e.value.alias("value"))
        ),
    )
    in_order = F.array_sort(merged, order("late", "at"))
    return F.transform(in_order, lambda e: F.struct(e.key.alias("key"), e.value.alias("value")))


def _category_entries() -> Column:
    """(category, body) of every category that is an object, in the order of the document; each body is read once.

    Entries of the alternate container win over equal keys, in the place of the first ones; its other keys come behind.
    """
    base, alternate = _entries("categories"), _entries("film_data")
    entries = F.when(F.size(alternate) == 0, base).otherwise(_merged(base, alternate))
    bodies = F.transform(
        entries, lambda e: F.struct(e.key.alias("category"), _get(e.value, "$", CATEGORY).alias("body"))
    )
    return F.filter(bodies, lambda e: e.body.isNotNull())


def category_rows(docs: DataFrame) -> DataFrame:
    """One row per category of each document; values that are not objects are skipped."""
    return docs.select("*", F.explode(_category_entries()).alias("e")).select(
        *docs.columns,
        "e.category",
        _get("e.body.year", "$", "int").alias("category_year"),
        _get("e.body.platform", "$", "string").alias("platform"),
        _get("e.body.developer", "$", "string").alias("developer"),
        _get("e.body.characters", "$", "array<variant>").alias("characters"),
    )


def _groups() -> Column:
    """All character lists of a document: per category, the direct list, and the lists of a map."""

    def group(container: str, key: Column, year: Column, characters: Column) -> Column:
        return F.struct(
            F.lit(container).alias("container"), key.alias("category"), year.alias("category_year"),
            characters.alias("characters"),
        )

    def people(value: Column) -> Column:
        return _get(value, "$", "array<variant>")

    no_year = F.lit(None).cast("int")
    everything = F.concat(
        F.transform(
            _category_entries(),
            lambda e: group("categories", e.category, _get(e.body.year, "$", "int"), people(e.body.characters)),
        ),
        F.array(group("list", F.lit(None).cast("string"), no_year, F.col("people"))),
        F.transform(_entries("characters"), lambda e: group("map", e.key, no_year, people(e.value))),
    )
    return F.filter(everything, lambda g: g.characters.isNotNull())


def category_media(category: Column, year: Column, media: Column, by_slug: bool = True) -> Column:
    """The first title whose year is the category's, or whose slug contains or is contained in the category key."""

    def fits(m: Column) -> Column:
        hit = F.coalesce(m.year == year, F.lit(False))
        if by_slug:
            near = (m.slug != "") & (category.contains(m.slug) | m.slug.contains(category))
            hit = hit | F.coalesce(near, F.lit(False))
        return hit

    return F.get(F.filter(media, fits), F.lit(0))


def character_rows(
    docs: DataFrame, first_for_lists: bool = False, franchise_year: bool = False,
    unnamed: str | None = None, titles: bool = False,
) -> DataFrame:
    """One row per character of each document, with the media the character belongs to.

    A character of a category belongs to the title of that category; with ``franchise_year``, a category that has a
    year but no title gets the franchise as its title. A character of a list belongs to the only title of the
    document; with ``first_for_lists``, characters of a list or of a map of lists belong to its first title. Characters
    without a name drop out, unless ``unnamed`` names them; ``titles`` adds ``appearances``, the dated films of the
    document, and ``titles``, all its media, as arrays: characters are never multiplied by titles.
    """
    grouped = (
        with_media(docs, slugs=True)
        .withColumn("franchise", franchise_of())
        .withColumn("total_media", F.size("media"))
        .select("*", F.posexplode(_groups()).alias("group_position", "g"))
        .select("*", "g.*")
        .drop("g", "doc")
        .withColumn("known_year", F.coalesce("category_year", nz.lookup(fv.CATEGORY_YEARS, F.lower("category"))))
    )
    first = F.get("media", F.lit(0))
    matched = category_media(F.col("category"), F.col("known_year"), F.col("media"))
    own = F.when(F.col("container") == "list", F.when(F.col("total_media") == 1, first)).otherwise(matched)
    if first_for_lists:
        own = F.when(F.col("container") == "categories", matched).otherwise(first)
    if franchise_year:
        stand_in = F.struct(
            F.col("franchise").alias("title"), F.col("category_year").alias("year"), F.lit("film").alias("media_type"),
            slugify(F.col("franchise")).alias("slug"),
        )
        own = F.coalesce(own, F.when(F.col("category_year").isNotNull(), stand_in))
    grouped = grouped.withColumn("own_media", own)
    records = F.transform("characters", lambda c: _get(c, "$", CHARACTER))
    people = grouped.select("*", F.posexplode(records).alias("position", "_person")).filter(F.col("_person").isNotNull())
    if unnamed is not None:
        people = people.withColumn("_person", F.col("_person").withField("name", F.coalesce("_person.name", F.lit(unnamed))))
    films = F.filter("media", lambda m: (m.media_type == "film") & m.year.isNotNull())
    appearances = [F.transform(films, lambda m: F.struct(m.title.alias("title"), m.year.alias("year"))).alias("appearances")]
    return people.filter(blank_to_null(F.col("_person.name")).isNotNull()).select(
        "source_dir", "source_file", "franchise", "container", "category", "category_year", "group_position",
        "position", "_person.*", F.col("own_media.title").alias("media_title"),
        F.col("own_media.year").alias("media_year"), F.col("own_media.media_type").alias("media_type"),
        *([*appearances, F.col("media").alias("titles")] if titles else []),
    )


def stand_in_titles(people: DataFrame) -> DataFrame:
    """Titles that categories got from their franchise (see ``franchise_year``), shaped like ``media_rows``.

    A title that the document names itself may come up again; ``behind`` puts the stand-ins behind all named titles.
    """
    text = F.lit(None).cast("string")
    return people.filter((F.col("media_title") == F.col("franchise")) & F.col("media_year").isNotNull()).select(
        "source_dir", "source_file", "franchise", text.alias("raw_studio"), text.alias("raw_animation_type"),
        F.col("group_position").alias("position"), F.col("media_title").alias("title"),
        F.col("media_year").alias("year"), "media_type", F.lit(1).alias("behind"),
    ).distinct()


def explode_appearances(records: DataFrame) -> DataFrame:
    """Raw character records -> one row per non-null appearance, with title and year."""
    exploded = records.withColumn("_at", F.explode("appearances")).filter(F.col("_at").isNotNull())
    return exploded.withColumns({"media_title": F.col("_at.title"), "media_year": F.col("_at.year")}).drop(
        "_at", "appearances"
    )


def shorts_rows(docs: DataFrame) -> DataFrame:
    return docs.select("source_file", F.explode(_get("doc", "$.shorts", f"array<{SHORT}>")).alias("s")).select(
        "source_file", "s.*"
    )


def soundtrack_entries(files: DataFrame) -> DataFrame:
    """(value) rows, each the JSON array of film entries of one soundtrack file -> one row per entry."""
    entries = F.from_json("value", f"array<struct<film: string, film_year: int, releases: array<{RELEASE}>>>")
    return files.select(F.explode(entries).alias("e")).select("e.*")


def release_rows(entries: DataFrame) -> DataFrame:
    """One row per titled release of the films that have a title and a year."""
    return (
        entries.filter(F.col("film").isNotNull() & F.col("film_year").isNotNull())
        .select("film", "film_year", F.posexplode("releases").alias("release_position", "r"))
        .filter(blank_to_null(F.col("r.title")).isNotNull())
        .select("film", "film_year", "release_position", F.col("r.title").alias("release_title"), "r.label",
                "r.conductor", "r.composers", "r.album_awards", "r.tracks")
    )


def track_rows(releases: DataFrame) -> DataFrame:
    """One row per titled track; numbers start at one and count untitled tracks too."""
    return (
        releases.select("film", "film_year", "release_title", F.posexplode("tracks").alias("_at", "t"))
        .filter(blank_to_null(F.col("t.title")).isNotNull())
        .select(
            "film", "film_year", "release_title", F.col("t.title").alias("song_title"),
            (F.col("_at") + 1).alias("track_number"), F.coalesce("t.type", F.lit("song")).alias("track_type"),
            "t.composer", "t.performers", "t.awards",
        )
    )


def song_credit_rows(tracks: DataFrame) -> DataFrame:
    """One row per credit of a track: each performer, and the composer."""
    performers = F.transform(
        F.coalesce("performers", F.array().cast("array<struct<name: string, type: string, character: string>>")),
        lambda p: F.struct(p["name"].alias("name"), F.coalesce(p["type"], F.lit("performer")).alias("type")),
    )
    composer = F.array(F.struct(F.col("composer").alias("name"), F.lit("composer").alias("type")))
    return (
        tracks.select("film", "film_year", "release_title", "song_title",
                      F.explode(F.concat(performers, composer)).alias("c"))
        .filter(blank_to_null(F.col("c.name")).isNotNull())
        .select("film", "film_year", "release_title", "song_title", F.trim("c.name").alias("name"),
                nz.credit_type(F.col("c.type")).alias("credit_type"))
    )


def album_credit_rows(releases: DataFrame) -> DataFrame:
    """Composers of a release, without the excluded ones, and its conductor."""
    composers = F.transform(
        F.coalesce("composers", F.array().cast("array<string>")),
        lambda c: F.struct(c.alias("name"), F.lit("composer").alias("credit_type")),
    )
    conductor = F.array(F.struct(F.col("conductor").alias("name"), F.lit("conductor").alias("credit_type")))
    return (
        releases.select("film", "film_year", "release_title", F.explode(F.concat(composers, conductor)).alias("c"))
        .select("film", "film_year", "release_title", "c.*")
        .filter(blank_to_null(F.col("name")).isNotNull() & ~F.col("name").isin(fv.EXCLUDED_COMPOSERS))
    )


def award_rows(entries: DataFrame) -> DataFrame:
    """One row per award, of the release (no song) or of a track."""
    releases = entries.filter(F.col("film").isNotNull() & F.col("film_year").isNotNull()).select(
        "film", "film_year", F.explode("releases").alias("r")
    )
    album = releases.select("film", "film_year", F.explode("r.album_awards").alias("a"))
    track = releases.select("film", "film_year", F.explode("r.tracks").alias("t")).select(
        "film", "film_year", F.col("t.title").alias("song_title"), F.explode("t.awards").alias("a")
    )
    return album.unionByName(track, allowMissingColumns=True).select(
        "film", "film_year", nz.award_body(F.col("a.award")).alias("award_body"), F.col("a.category").alias("category"),
        F.col("a.year").alias("ceremony_year"), nz.outcome(F.col("a.result")).alias("outcome"), "song_title",
    )


def game_rows(docs: DataFrame) -> DataFrame:
    """One row per game title with publisher, developer and platforms of the category of the same year."""
    studio = F.coalesce(_get("doc", "$.studio", "string"), F.lit(fv.DEFAULT_GAME_STUDIO))
    first_of_year = F.get(
        F.filter(
            "_categories",
            lambda e: F.coalesce(_get(e.body.year, "$", "int") == F.col("m.year"), F.lit(False)),
        ),
        F.lit(0),
    )
    # documents without a game give no rows: their categories are not read
    named = _get("doc", "$.games", "variant").isNotNull() | _get("doc", "$.game", "variant").isNotNull()
    return (
        with_media(docs.filter(named))
        .withColumn("franchise", franchise_of())
        .withColumn("studio", studio)
        .withColumn("_categories", _category_entries())
        .select("*", F.posexplode(F.filter("media", lambda m: m.media_type == "game")).alias("position", "m"))
        .withColumn("_category", first_of_year)
        .select(
            "source_dir", "source_file", "position", "franchise", "m.title", "m.year",
            F.coalesce(_get("_category.body.developer", "$", "string"), nz.developer(F.col("studio"))).alias("developer"),
            nz.publisher(F.col("studio")).alias("publisher"),
            nz.platforms(_get("_category.body.platform", "$", "string")).alias("platforms"),
        )
    )
