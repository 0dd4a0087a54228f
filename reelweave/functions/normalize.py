"""Value normalisation as native column expressions (no UDF)."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions.text import blank_to_null, strip, title_case


def lookup(mapping: dict[str, object], key: Column) -> Column:
    """Value of a small literal mapping, null when the key is missing."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])[key]


def folded(col: Column) -> Column:
    return strip(F.lower(col))


def map_values(col: Column, mapping: dict[str, str], null_default: str, unmapped: str | None = None) -> Column:
    """Dictionary lookup on the folded text. Unmapped values pass through, or become ``unmapped`` when given."""
    other = folded(col) if unmapped is None else F.lit(unmapped)
    return F.when(col.isNull(), null_default).otherwise(F.coalesce(lookup(mapping, folded(col)), other))


def role_alias(col: Column) -> Column:
    return map_values(col, fv.ROLE_ALIASES, "supporting")


def gender_alias(col: Column) -> Column:
    return map_values(col, fv.GENDER_ALIASES, "n/a")


def role_closed(col: Column) -> Column:
    return map_values(blank_to_null(col), fv.ROLE_CLOSED, "supporting", unmapped="supporting")


def gender_closed(col: Column) -> Column:
    return map_values(blank_to_null(col), fv.GENDER_CLOSED, "n/a", unmapped="n/a")


def role_by_rules(col: Column) -> Column:
    role = F.regexp_replace(F.lower(col), r"\s+", "_")
    return (
        F.when(blank_to_null(col).isNull(), "minor")
        .when(role.contains("hench"), "henchman")
        .when(role.isin(fv.ROLE_RULE_NAMES), role)
        .otherwise("supporting")
    )


def gender_by_rules(col: Column) -> Column:
    gender = F.lower(col)
    return (
        F.when(gender.isin("male", "female", "mixed"), gender)
        .when(gender.isin("n/a", "none", "various"), "n/a")
        .otherwise("unknown")
    )


def first_matching(text: Column, rules: list[tuple[str, list[str]]], default: Column | str) -> Column:
    """Ordered contains-rules: the first rule with a contained word gives the value."""
    branch = None
    for value, words in rules:
        hit = reduce(lambda a, b: a | b, [text.contains(w) for w in words])
        branch = F.when(hit, value) if branch is None else branch.when(hit, value)
    return branch.otherwise(default)


def studio_name(studio: Column, source_dir: Column) -> Column:
    """Canonical studio from the raw name; only a missing name falls back to the source folder."""
    raw = F.lower(studio)
    contained = first_matching(raw, [(name, [word]) for word, name in fv.STUDIO_CONTAINED], studio)
    return F.when(studio.isNull(), lookup(fv.STUDIO_BY_FOLDER, source_dir)).otherwise(
        F.coalesce(lookup(fv.STUDIO_EXACT, raw), contained)
    )


def studio_facts(name: Column) -> Column:
    """``struct(founded, closed, status)`` of a studio, with a default for unknown ones."""

    def facts(values: tuple) -> Column:
        founded, closed, status = values
        return F.struct(
            F.lit(founded).cast("int").alias("founded"),
            F.lit(closed).cast("int").alias("closed"),
            F.lit(status).alias("status"),
        )

    pairs = chain.from_iterable((F.lit(k), facts(v)) for k, v in fv.STUDIO_FACTS.items())
    return F.coalesce(F.create_map(*pairs)[name], facts(fv.STUDIO_FACTS_DEFAULT))


def animation_type(explicit: Column, title: Column) -> Column:
    text = F.lower(title)
    hybrid = reduce(lambda a, b: a | b, [text.contains(t) for t in fv.HYBRID_TITLES])
    return F.coalesce(explicit, F.when(hybrid, "hybrid").otherwise("fully_animated"))


def _contained_species(text: Column, whole_words: bool) -> Column:
    """Longest canonical name in the text, then the alphabetically first one."""
    names = F.array(*[F.lit(s) for s in sorted(fv.SPECIES, key=lambda s: (-len(s), s))])
    if whole_words:
        return F.get(F.filter(names, lambda n: F.regexp_like(text, F.concat(F.lit(r"\b"), n, F.lit(r"\b")))), F.lit(0))
    return F.get(F.filter(names, lambda n: F.contains(text, n)), F.lit(0))


def _exact_species(text: Column, part: int) -> Column:
    """Species (0), subtype (1) or flag (2) of a raw text that has a row of its own."""
    return lookup({raw: row[part] for raw, row in fv.SPECIES_EXACT.items() if row[part] is not None}, text)


def species_name(raw: Column, whole_words: bool = False) -> Column:
    """Canonical species: exact value, canonical name, toy prefix, contained name, hint word, else the raw text."""
    text = folded(raw)
    contained = _contained_species(text, whole_words)
    unknown_animal = F.when(text.contains("anthropomorphic"), "animal")
    hints = first_matching(text, [(name, [word]) for word, name in fv.SPECIES_HINTS.items()], raw)
    return F.when(
        blank_to_null(raw).isNotNull(),
        F.coalesce(
            _exact_species(text, 0),
            F.when(text.isin(fv.SPECIES), text),
            F.when(text.startswith("toy"), "toy"),
            contained,
            unknown_animal,
            hints,
        ),
    )


def species_parts(raw: Column, whole_words: bool = False) -> Column:
    """``struct(species, subtype, is_anthropomorphic)``; the subtype is the text in the first brackets."""
    text = folded(raw)
    bracketed = F.when(text.rlike(r"\([^)]*\)"), strip(F.regexp_extract(text, r"\(([^)]*)\)", 1)))
    return F.struct(
        species_name(raw, whole_words).alias("species"),
        F.coalesce(_exact_species(text, 1), bracketed).alias("subtype"),
        F.coalesce(_exact_species(text, 2), text.contains("anthropomorphic"), F.lit(False)).alias("is_anthropomorphic"),
    )


def species_bucket(raw: Column) -> Column:
    return first_matching(F.lower(raw), fv.SPECIES_BUCKETS, "unknown")


def species_group(raw: Column) -> Column:
    text = F.lower(F.coalesce(blank_to_null(raw), F.lit("unknown")))
    return first_matching(text, fv.SPECIES_GROUPS, "Other")


def primary_actor(raw: Column) -> Column:
    """First of several names, without a trailing bracket; null for texts that stand for nobody."""
    first = F.get(F.split(strip(raw), r",\s*(?=[A-Z])"), F.lit(0))
    name = strip(F.regexp_replace(first, r"\s*\([^)]*\)\s*$", ""))
    nobody = F.lower(raw).isin(fv.NO_TALENT_TEXTS) | F.lower(name).isin("n/a", "none", "")
    return F.when(raw.isNotNull() & ~nobody, name)


def first_actor(raw: Column) -> Column:
    """Simpler variant: the text before the first comma and the first bracket."""
    return strip(F.substring_index(F.substring_index(raw, ",", 1), "(", 1))


def is_real_name(raw: Column) -> Column:
    return F.coalesce((raw != "") & ~F.lower(raw).isin(fv.NO_NAME_TEXTS), F.lit(False))


def platforms(raw: Column) -> Column:
    """Sorted distinct platform names of a text such as ``PC/PS3, Wii``."""
    parts = F.transform(F.split(raw, "[/,]"), folded)
    named = F.transform(
        F.filter(parts, lambda p: p != ""), lambda p: F.coalesce(lookup(fv.PLATFORM_ALIASES, p), title_case(p))
    )
    return F.array_sort(F.array_distinct(F.coalesce(named, F.array().cast("array<string>"))))


def award_body(raw: Column) -> Column:
    text = F.lower(raw)
    rules = [(name, [word]) for word, name in fv.AWARD_BODY_WORDS]
    return F.when(blank_to_null(raw).isNull(), fv.AWARD_BODY_DEFAULT).otherwise(first_matching(text, rules, raw))


def credit_type(raw: Column) -> Column:
    text = F.lower(raw)
    return F.coalesce(lookup(fv.CREDIT_ALIASES, text), text)


def outcome(raw: Column) -> Column:
    return F.when(raw.isin(fv.OUTCOMES), raw).otherwise("nominated")


def publisher(studio: Column) -> Column:
    return F.when(studio.contains("/"), strip(F.substring_index(studio, "/", 1))).otherwise(studio)


def developer(studio: Column) -> Column:
    """The part after the last slash of ``Publisher/Developer``, null when there is no slash."""
    return F.when(studio.contains("/"), strip(F.substring_index(studio, "/", -1)))
