"""Parsing and normalisation of raw texts. The raw texts are made from table columns by one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import normalize as nz
from reelweave.functions import text as tx
from reelweave.registry import query
from reelweave.registry.catalogue import with_views
from reelweave.sinks import writers

RAW_TITLE = """CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN '  ' || p_name || '(' || (1970 + p_size) || ')  '
  WHEN 2 THEN p_name || ' (19) (' || (1970 + p_size) || ')' WHEN 3 THEN p_name || ' (' || (1970 + p_size) || ') extra'
  WHEN 4 THEN '(' || (1970 + p_size) || ')' ELSE p_name || ' (' || (1970 + p_size) || ')' END"""
RAW_ROLE = """CASE c_custkey % 11 WHEN 0 THEN ' Main Protagonist ' WHEN 1 THEN 'villain' WHEN 2 THEN 'Comic Relief'
  WHEN 3 THEN 'Henchmen' WHEN 4 THEN 'love interest' WHEN 5 THEN 'cameo' WHEN 6 THEN 'Ally' WHEN 7 THEN c_mktsegment
  WHEN 8 THEN NULL WHEN 9 THEN 'Co-Lead' ELSE 'mentor' END"""
RAW_GENDER = """CASE c_nationkey % 8 WHEN 0 THEN 'Male' WHEN 1 THEN ' F ' WHEN 2 THEN 'NonBinary' WHEN 3 THEN 'Various'
  WHEN 4 THEN 'unknown' WHEN 5 THEN NULL WHEN 6 THEN 'mixed' ELSE c_mktsegment END"""
RAW_SPECIES = """CASE c_nationkey WHEN 0 THEN 'Toy (Cowboy Doll)' WHEN 1 THEN 'anthropomorphic mouse' WHEN 2 THEN 'anthropomorphic dog'
  WHEN 3 THEN 'Human (ghost)' WHEN 4 THEN 'Spix''s macaw' WHEN 5 THEN 'Woolly Mammoth' WHEN 6 THEN 'Animatronic figure'
  WHEN 7 THEN 'gremlin' WHEN 8 THEN 'ink creature' WHEN 9 THEN 'Robot dog' WHEN 10 THEN NULL WHEN 11 THEN ' Sea Turtle '
  WHEN 12 THEN 'unicorn' WHEN 13 THEN 'saber-toothed squirrel' WHEN 14 THEN 'dream eater (spirit)' WHEN 15 THEN 'anthropomorphic yak'
  WHEN 16 THEN 'Emotion' WHEN 17 THEN 'fire machine' WHEN 18 THEN 'insect' WHEN 19 THEN 'toyland bird' ELSE c_mktsegment END"""
RAW_ACTOR = """CASE c_custkey % 9 WHEN 0 THEN 'Ann Lee, Bob Ray' WHEN 1 THEN 'Cyd Poe (singing)' WHEN 2 THEN 'N/A' WHEN 3 THEN NULL
  WHEN 4 THEN 'Lee Roy, jr.' WHEN 5 THEN c_name || ' (young), Dan Oz (old)' WHEN 6 THEN 'none' WHEN 7 THEN ' ' || c_name || ' '
  ELSE c_name END"""
RAW_DEVICE = """CASE p_size % 7 WHEN 0 THEN 'PS2/Xbox 360' WHEN 1 THEN 'pc, PC' WHEN 2 THEN 'Switch,/iOS' WHEN 3 THEN 'vectrex-mini'
  WHEN 4 THEN NULL WHEN 5 THEN 'Mobile/Android' ELSE 'wii u' END"""
RAW_STUDIO = """CASE p_size % 8 WHEN 0 THEN 'Pixar' WHEN 1 THEN 'WDAS' WHEN 2 THEN 'Blue Sky Co' WHEN 3 THEN 'Disneytoon Films'
  WHEN 4 THEN 'Old Fox House' WHEN 5 THEN NULL WHEN 6 THEN 'Marvel Works' ELSE p_brand END"""
RAW_FOLDER = "CASE WHEN p_partkey % 2 = 0 THEN 'pixar_characters' ELSE 'kingdom_hearts_characters' END"
RAW_BODY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Oscar night' WHEN '2-HIGH' THEN 'The Golden Globe Award' WHEN '3-MEDIUM' THEN NULL
  WHEN '5-LOW' THEN 'BAFTA Film' ELSE o_orderpriority END"""


def _case(mapping: dict, key: str) -> str:
    whens = " ".join("WHEN '{}' THEN '{}'".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in mapping.items())
    return f"CASE {key} {whens} END"


def _contains(rules: list[tuple[str, list[str]]], text: str, default: str) -> str:
    whens = " ".join(
        "WHEN {} THEN '{}'".format(" OR ".join(f"contains({text}, '{w}')" for w in words), value) for value, words in rules
    )
    return f"CASE {whens} ELSE {default} END"


def _quoted(names: list[str]) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


@query("parse_title_year", f"""
SELECT p_partkey, trim(regexp_extract(raw, '{fv.TITLE_YEAR_PATTERN}', 1)) AS title,
  CAST(regexp_extract(raw, '{fv.TITLE_YEAR_PATTERN}', 2) AS INTEGER) AS year
FROM (SELECT p_partkey, trim({RAW_TITLE}) AS raw FROM part) WHERE regexp_matches(raw, '{fv.TITLE_YEAR_PATTERN}')""")
def _(t):
    parsed = t.raw("part").select("p_partkey", tx.parse_title_year(F.expr(RAW_TITLE)).alias("p"))
    return parsed.filter(F.col("p").isNotNull()).select("p_partkey", "p.title", "p.year")


@query("parse_title_keep_raw", f"""
SELECT p_partkey, coalesce(nullif(trim(regexp_extract(trim(raw), '{fv.TITLE_YEAR_PATTERN}', 1)), ''), raw) AS title,
  coalesce(TRY_CAST(nullif(regexp_extract(trim(raw), '{fv.TITLE_YEAR_PATTERN}', 2), '') AS INTEGER), 0) AS year
FROM (SELECT p_partkey, {RAW_TITLE} AS raw FROM part)""")
def _(t):
    parsed = t.raw("part").select("p_partkey", tx.title_year_or_raw(F.expr(RAW_TITLE)).alias("p"))
    return parsed.select("p_partkey", "p.title", F.coalesce("p.year", F.lit(0)).alias("year"))


@query("parse_title_default_year", f"""
SELECT p_partkey, regexp_replace(raw, '\\s*\\(\\d{{4}}\\)', '') AS title,
  coalesce(TRY_CAST(nullif(regexp_extract(raw, '\\((\\d{{4}})\\)', 1), '') AS INTEGER), 2000) AS year
FROM (SELECT p_partkey, {RAW_TITLE} AS raw FROM part)""")
def _(t):
    return t.raw("part").select("p_partkey", tx.title_year_anywhere(F.expr(RAW_TITLE)).alias("p")).select(
        "p_partkey", "p.title", "p.year")


SLUG_SQL = r"regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s\p{Z}-]', '', 'g'), '[\s\p{Z}-]+', '-', 'g')"


@query("slugify_texts", f"SELECT doc_id, trim({SLUG_SQL}, '-') AS slug FROM documents")
def _(t):
    return t.raw("documents").select("doc_id", tx.slugify(F.col("text")).alias("slug"))


@query("slugify_short", f"SELECT doc_id, substr({SLUG_SQL}, 1, 50) AS slug FROM documents")
def _(t):
    return t.raw("documents").select("doc_id", tx.slugify(F.col("text"), 50, trim_dashes=False).alias("slug"))


@query("map_role_passthrough", f"""
SELECT c_custkey, CASE WHEN raw IS NULL THEN 'supporting' ELSE coalesce({_case(fv.ROLE_ALIASES, 'trim(lower(raw))')}, trim(lower(raw))) END AS role,
  CASE WHEN gender IS NULL THEN 'n/a' ELSE coalesce({_case(fv.GENDER_ALIASES, 'trim(lower(gender))')}, trim(lower(gender))) END AS gender
FROM (SELECT c_custkey, {RAW_ROLE} AS raw, {RAW_GENDER} AS gender FROM customer)""")
def _(t):
    return t.raw("customer").select(
        "c_custkey", nz.role_alias(F.expr(RAW_ROLE)).alias("role"), nz.gender_alias(F.expr(RAW_GENDER)).alias("gender"))


@query("map_role_default", f"""
SELECT c_custkey, coalesce({_case(fv.ROLE_CLOSED, 'trim(lower(raw))')}, 'supporting') AS role,
  coalesce({_case(fv.GENDER_CLOSED, 'trim(lower(gender))')}, 'n/a') AS gender
FROM (SELECT c_custkey, {RAW_ROLE} AS raw, {RAW_GENDER} AS gender FROM customer)""")
def _(t):
    return t.raw("customer").select(
        "c_custkey", nz.role_closed(F.expr(RAW_ROLE)).alias("role"), nz.gender_closed(F.expr(RAW_GENDER)).alias("gender"))


@query("map_role_rules", f"""
SELECT c_custkey, CASE WHEN raw IS NULL THEN 'minor' WHEN contains(r, 'hench') THEN 'henchman'
    WHEN r IN ({_quoted(fv.ROLE_RULE_NAMES)}) THEN r ELSE 'supporting' END AS role,
  CASE WHEN lower(gender) IN ('male', 'female', 'mixed') THEN lower(gender)
    WHEN lower(gender) IN ('n/a', 'none', 'various') THEN 'n/a' ELSE 'unknown' END AS gender
FROM (SELECT c_custkey, {RAW_ROLE} AS raw, replace(lower({RAW_ROLE}), ' ', '_') AS r, {RAW_GENDER} AS gender FROM customer)""")
def _(t):
    return t.raw("customer").select(
        "c_custkey", nz.role_by_rules(F.expr(RAW_ROLE)).alias("role"), nz.gender_by_rules(F.expr(RAW_GENDER)).alias("gender"))


_LONGEST_FIRST = sorted(fv.SPECIES, key=lambda s: (-len(s), s))
SPECIES_SQL = f"""CASE WHEN raw IS NULL THEN NULL
  WHEN s = 'anthropomorphic dog' THEN 'dog' WHEN s = 'anthropomorphic mouse' THEN 'mouse' WHEN s = 'woolly mammoth' THEN 'mammoth'
  WHEN s = 'saber-toothed squirrel' THEN 'squirrel' WHEN s IN ({_quoted(fv.SPECIES)}) THEN s WHEN starts_with(s, 'toy') THEN 'toy'
  ELSE {_contains([(n, [n]) for n in _LONGEST_FIRST], 's',
                  _contains([(n, [w]) for w, n in fv.SPECIES_HINTS.items()], 's', 'raw'))} END"""


@query("species_canonical", f"SELECT c_custkey, {SPECIES_SQL} AS species FROM (SELECT c_custkey, {RAW_SPECIES} AS raw, trim(lower({RAW_SPECIES})) AS s FROM customer)")
def _(t):
    return t.raw("customer").select("c_custkey", nz.species_name(F.expr(RAW_SPECIES)).alias("species"))


@query("species_parse", f"""
SELECT c_custkey, {SPECIES_SQL} AS species,
  CASE WHEN s = 'saber-toothed squirrel' THEN 'saber-toothed' ELSE nullif(regexp_extract(s, '\\(([^)]*)\\)', 1), '') END AS subtype,
  coalesce(contains(s, 'anthropomorphic'), false) AS is_anthropomorphic
FROM (SELECT c_custkey, {RAW_SPECIES} AS raw, trim(lower({RAW_SPECIES})) AS s FROM customer)""")
def _(t):
    return t.raw("customer").select("c_custkey", nz.species_parts(F.expr(RAW_SPECIES)).alias("s")).select("c_custkey", "s.*")


@query("species_bucket", f"""
SELECT c_custkey, {_contains(fv.SPECIES_BUCKETS, f"lower({RAW_SPECIES})", "'unknown'")} AS bucket FROM customer""")
def _(t):
    return t.raw("customer").select("c_custkey", nz.species_bucket(F.expr(RAW_SPECIES)).alias("bucket"))


@query("species_bucket_texts", f"SELECT doc_id, {_contains(fv.SPECIES_BUCKETS, 'lower(text)', chr(39) + 'unknown' + chr(39))} AS bucket FROM documents")
def _(t):
    return t.raw("documents").select("doc_id", nz.species_bucket(F.col("text")).alias("bucket"))


@query("voice_actor_primary", f"""
SELECT c_custkey, CASE WHEN raw IS NOT NULL AND lower(raw) NOT IN ('n/a', 'none', 'unknown', '') THEN
  trim(regexp_replace(split_part(regexp_replace(trim(raw), ',\\s*([A-Z])', chr(1) || '\\1', 'g'), chr(1), 1), '\\s*\\([^)]*\\)\\s*$', '')) END AS actor
FROM (SELECT c_custkey, {RAW_ACTOR} AS raw FROM customer)""")
def _(t):
    return t.raw("customer").select("c_custkey", nz.primary_actor(F.expr(RAW_ACTOR)).alias("actor"))


@query("voice_actor_first", f"""
SELECT c_custkey, trim(split_part(split_part({RAW_ACTOR}, ',', 1), '(', 1)) AS actor,
  coalesce(lower({RAW_ACTOR}) NOT IN ({_quoted(fv.NO_NAME_TEXTS)}), false) AS is_real
FROM customer""")
def _(t):
    raw = F.expr(RAW_ACTOR)
    return t.raw("customer").select("c_custkey", nz.first_actor(raw).alias("actor"), nz.is_real_name(raw).alias("is_real"))


@query("split_platforms", """
SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN 'PlayStation 2|Xbox 360' WHEN 1 THEN 'PC' WHEN 2 THEN 'Nintendo Switch|iOS'
  WHEN 3 THEN 'Vectrex-Mini' WHEN 4 THEN '' WHEN 5 THEN 'Android|iOS' ELSE 'Nintendo Wii U' END AS platforms FROM part""")
def _(t):
    return t.raw("part").select("p_partkey", F.array_join(nz.platforms(F.expr(RAW_DEVICE)), "|").alias("platforms"))


@query("publisher_developer", "SELECT p_partkey, p_brand AS publisher, p_type AS developer FROM part")
def _(t):
    owner = F.concat("p_brand", F.lit(" / "), "p_type")
    return t.raw("part").select("p_partkey", nz.publisher(owner).alias("publisher"), nz.developer(owner).alias("developer"))


STUDIO_SQL = f"""CASE WHEN raw IS NULL THEN CASE WHEN p_partkey % 2 = 0 THEN 'Pixar Animation Studios' END ELSE
  coalesce({_case(fv.STUDIO_EXACT, 'lower(raw)')}, {_contains([(n, [w]) for w, n in fv.STUDIO_CONTAINED], 'lower(raw)', 'raw')}) END"""


@query("studio_from_rules", f"""
SELECT p_partkey, studio, coalesce(f.founded, 2000) AS founded, f.closed, coalesce(f.status, 'active') AS status
FROM (SELECT p_partkey, {STUDIO_SQL} AS studio FROM (SELECT p_partkey, {RAW_STUDIO} AS raw FROM part))
LEFT JOIN (VALUES {", ".join(f"('{k}', {v[0]}, {v[1] or 'NULL'}, '{v[2]}')" for k, v in fv.STUDIO_FACTS.items())})
  AS f(name, founded, closed, status) ON f.name = studio""")
def _(t):
    named = t.raw("part").select("p_partkey", nz.studio_name(F.expr(RAW_STUDIO), F.expr(RAW_FOLDER)).alias("studio"))
    return named.select("p_partkey", "studio", nz.studio_facts(F.col("studio")).alias("f")).select("p_partkey", "studio", "f.*")


ANIMATION_TITLE = "CASE p_size % 4 WHEN 0 THEN 'The Enchanted ' || p_name WHEN 1 THEN 'Pete''s Dragon' ELSE p_name END"


@query("animation_type", """
SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'mixed' WHEN p_size % 4 IN (0, 1) THEN 'hybrid' ELSE 'fully_animated' END AS animation_type
FROM part""")
def _(t):
    explicit = F.when(F.col("p_size") % 10 == 0, "mixed")
    return t.raw("part").select("p_partkey", nz.animation_type(explicit, F.expr(ANIMATION_TITLE)).alias("animation_type"))


@query("award_body", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Academy Awards' WHEN '2-HIGH' THEN 'Golden Globe Awards'
  WHEN '3-MEDIUM' THEN 'Academy Awards' WHEN '5-LOW' THEN 'BAFTA' ELSE o_orderpriority END AS body,
  CASE o_orderstatus WHEN 'F' THEN 'won' ELSE 'nominated' END AS outcome,
  CASE o_orderstatus WHEN 'F' THEN 'performer' WHEN 'O' THEN 'lyricist' ELSE 'performer' END AS credit
FROM orders""")
def _(t):
    result = F.when(F.col("o_orderstatus") == "F", "won").otherwise(F.col("o_orderstatus"))
    credit = F.when(F.col("o_orderstatus") == "F", "Voice").when(F.col("o_orderstatus") == "O", "Lyricist").otherwise("SINGER")
    return t.raw("orders").select(
        "o_orderkey", nz.award_body(F.expr(RAW_BODY)).alias("body"), nz.outcome(result).alias("outcome"),
        nz.credit_type(credit).alias("credit"))


@query("keyed_messages", with_views(
    """SELECT 'film' AS topic, replace(lower(title), ' ', '_') || '_' || year AS key, title AS payload FROM media
       UNION ALL SELECT 'character', replace(lower(name), ' ', '_') || '_' || replace(lower(franchise), ' ', '_'), name
         FROM characters WHERE franchise IS NOT NULL
       UNION ALL SELECT 'box_office', m.title || '_' || e.report_date || '_' || state_code, m.title
         FROM event_reports e JOIN media m ON m.id = e.film_id
       UNION ALL SELECT 'revenue', film_id || '-' || report_date || '-' || state_code, CAST(film_id AS VARCHAR) FROM event_reports""",
    "media", "characters", "event_reports"))
def _(t):
    def read(messages, topic, field):
        return messages.select(F.lit(topic).alias("topic"), "key", F.get_json_object("value", f"$.{field}").alias("payload"))

    events = t.event_reports().drop("ts", "event_id")
    titled = events.join(t.media.select(F.col("id").alias("film_id"), F.col("title").alias("film_title")), "film_id")
    parts = [
        read(writers.film_messages(t.media), "film", "title"),
        read(writers.character_messages(t.characters.filter("franchise IS NOT NULL")), "character", "name"),
        read(writers.box_office_messages(titled), "box_office", "film_title"),
        read(writers.revenue_messages(events), "revenue", "film_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("camel_case_names", with_views(
    'SELECT id, title, year, franchise_id AS "franchiseId", media_type AS "mediaType" FROM media', "media"))
def _(t):
    return tx.camel_case_columns(t.media)


@query("search_pages", "SELECT page_id, url FROM pages WHERE contains(lower(html), 'dr') OR contains(lower(url), 'dr')")
def _(t):
    return t.raw("pages").filter(tx.contains_any_case([F.col("html"), F.col("url")], "DR")).select("page_id", "url")
