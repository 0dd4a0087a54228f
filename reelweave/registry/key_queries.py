"""Keys, dimensions, junctions, table builders and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import text as tx
from reelweave.functions.normalize import gender_alias
from reelweave.operators import keys, quality, relational
from reelweave.plans import builders as b
from reelweave.registry import query
from reelweave.registry.catalogue import with_views
from reelweave.registry.text_queries import RAW_ACTOR, RAW_GENDER, RAW_ROLE, RAW_SPECIES, _case
from reelweave.session import written
from reelweave.sources import readers

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"]


def raw_films(t):
    return t.raw("part").select(
        F.col("p_name").alias("title"), (F.col("p_size") + 1970).cast("int").alias("year"), F.col("p_brand").alias("studio"),
        (F.col("p_size") + 1900).cast("int").alias("studio_founded"), F.lit(None).cast("int").alias("studio_closed"),
        F.lit("active").alias("studio_status"), F.col("p_type").alias("franchise"),
        F.when(F.col("p_size") % 5 == 0, "hybrid").otherwise("fully_animated").alias("animation_type"))


def raw_people(t):
    """One raw record per line item: who (customer) speaks in which title (part) by whom (supplier)."""
    orders = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    titles = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_size")
    rows = t.raw("lineitem").join(orders, "l_orderkey").join(titles, "l_partkey")
    appearance = F.struct(F.col("p_name").alias("title"), (F.col("p_size") + 1970).cast("int").alias("year"))
    return rows.select(
        F.concat(F.lit("Person "), "o_custkey").alias("name"), F.col("p_type").alias("franchise"),
        F.when(F.col("l_returnflag") == "A", " Main Protagonist").when(F.col("l_returnflag") == "N", "villain")
        .otherwise("Unlisted").alias("role"),
        F.when(F.col("o_custkey") % 3 == 0, "M").when(F.col("o_custkey") % 3 == 1, "girl").alias("gender"),
        F.when(F.col("l_quantity") > 1, F.concat(F.lit("Voice "), "l_suppkey")).alias("voice_actor"),
        F.lit("human").alias("species"), F.col("p_size").alias("first_appearance_year"),
        F.array(appearance, F.lit(None).cast("struct<title: string, year: int>")).alias("appearances"))


RAW_PEOPLE = """raw_people AS (SELECT 'Person ' || o_custkey AS name, p_type AS franchise,
  CASE l_returnflag WHEN 'A' THEN 'protagonist' WHEN 'N' THEN 'villain' ELSE 'unlisted' END AS role,
  CASE o_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'n/a' END AS gender,
  CASE WHEN l_quantity > 1 THEN 'Voice ' || l_suppkey END AS voice_actor, p_size AS first_appearance_year,
  p_name AS title, CAST(p_size + 1970 AS INTEGER) AS year
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""


@query("distinct_studios", """
SELECT p_brand AS name, CAST(min(p_size + 1900) AS INTEGER) AS years_active_start, CAST(NULL AS INTEGER) AS years_active_end, 'active' AS status
FROM part GROUP BY p_brand""")
def _(t):
    return b.build_studios(raw_films(t)).drop("id")


@query("build_franchises", "SELECT p_type AS name, min(p_brand) AS studio FROM part GROUP BY p_type")
def _(t):
    studios = b.build_studios(raw_films(t)).select(F.col("id").alias("studio_id"), F.col("name").alias("studio"))
    return b.build_franchises(raw_films(t)).join(studios, "studio_id", "left").select("name", "studio")


@query("dedup_first", """
SELECT p_partkey, p_name, p_size FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_name), p_size ORDER BY p_partkey) = 1""")
def _(t):
    return keys.first_per_key(t.raw("part"), [F.lower("p_name"), "p_size"], ["p_partkey"]).select("p_partkey", "p_name", "p_size")


@query("surrogate_keys", f"SELECT count(*) AS rows, count(DISTINCT ({', '.join(LINE)})) AS ids FROM lineitem")
def _(t):
    return t.raw("lineitem").select(keys.surrogate_key(*LINE).alias("id")).agg(
        F.count("*").alias("rows"), F.countDistinct("id").alias("ids"))


@query("dense_ids", "SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id FROM customer")
def _(t):
    return keys.dense_index(t.raw("customer").select("c_custkey", "c_mktsegment"), [F.col("c_mktsegment"), F.col("c_custkey")]).select(
        "c_custkey", "id")


@query("slug_ids", """
SELECT c_custkey, replace(replace(lower(c_name), '#', ''), ' ', '-') || '-' || (row_number() OVER (ORDER BY c_name) - 1) AS id FROM customer""")
def _(t):
    return keys.slug_ids(t.raw("customer").select("c_custkey", "c_name"), tx.slugify(F.col("c_name")), [F.col("c_name")]).select(
        "c_custkey", "id")


@query("get_or_create_ids", """
SELECT s_suppkey AS id, s_name AS name FROM supplier
UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY name), name
FROM (SELECT c_name AS name FROM customer EXCEPT SELECT s_name FROM supplier)""")
def _(t):
    known = t.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    seen = t.raw("customer").select(F.col("c_name").alias("name")).unionByName(known.select("name"))
    return keys.get_or_create_ids(known, seen)


@query("fk_resolve_default", with_views(
    f"""SELECT c_custkey, coalesce(r.id, (SELECT id FROM roles WHERE name = 'supporting')) AS role_id
       FROM (SELECT c_custkey, trim(lower({RAW_ROLE})) AS raw FROM customer) c LEFT JOIN roles r ON r.name = c.raw""", "roles"))
def _(t):
    rows = t.raw("customer").select("c_custkey", F.trim(F.lower(F.expr(RAW_ROLE))).alias("raw"))
    return keys.resolve_lookup(rows, t.roles, F.col("raw"), "role_id", "supporting").drop("raw")


@query("split_orphans", with_views(
    """SELECT id, media_id, true AS kept FROM nominations WHERE media_id IN (SELECT id FROM films)
       UNION ALL SELECT id, media_id, false FROM nominations WHERE media_id NOT IN (SELECT id FROM films)""", "nominations", "films"))
def _(t):
    kept, rejected = keys.split_orphans(t.nominations.select("id", "media_id"), t.films.select("media_id"), ["media_id"])
    return kept.withColumn("kept", F.lit(True)).unionByName(rejected.withColumn("kept", F.lit(False))).select("id", "media_id", "kept")


@query("dq_violations", with_views(
    """SELECT 'line_key' AS rule, l_orderkey || '|' || l_linenumber AS key, count(*) AS rows FROM lineitem
         GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
       UNION ALL SELECT 'has_film', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT id FROM films)
         GROUP BY l_partkey
       UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY l_returnflag
       UNION ALL SELECT 'has_role', CAST(id AS VARCHAR), count(*) FROM characters WHERE role_id IS NULL GROUP BY id
       UNION ALL SELECT 'one_title', CAST(p_size AS VARCHAR), count(DISTINCT p_name) FROM part GROUP BY p_size HAVING count(DISTINCT p_name) > 1""",
    "films", "characters"))
def _(t):
    lines = t.raw("lineitem")
    return quality.violations(
        quality.duplicate_keys(lines, "line_key", ["l_orderkey", "l_linenumber"]),
        quality.orphans(lines, "has_film", "l_partkey", t.films, "id"),
        quality.not_allowed(lines, "flag", "l_returnflag", ["A", "N"]),
        quality.missing_values(t.characters, "has_role", "role_id", ["id"]),
        quality.colliding_ids(t.raw("part"), "one_title", "p_size", ["p_name"]),
        # the library's own ids: no rows unless two natural keys share a hash
        quality.colliding_ids(raw_people(t).select(keys.surrogate_key("name", "franchise").alias("id"), "name", "franchise"), "character_id", "id", ["name", "franchise"]),
    )


@query("build_media", """
SELECT p_name AS title, CAST(p_size + 1970 AS INTEGER) AS year, 'film' AS media_type, min(p_type) AS franchise FROM part GROUP BY ALL""")
def _(t):
    franchises = b.build_franchises(raw_films(t))
    media = b.build_media(raw_films(t).withColumn("media_type", F.lit("film")), franchises)
    names = franchises.select(F.col("id").alias("franchise_id"), F.col("name").alias("franchise"))
    return media.join(names, "franchise_id").select("title", "year", "media_type", "franchise")


@query("build_films", """
SELECT p_name AS title, CAST(p_size + 1970 AS INTEGER) AS year, min(p_brand) AS studio,
  CASE WHEN p_size % 5 = 0 THEN 'hybrid' ELSE 'fully_animated' END AS animation_type
FROM part GROUP BY p_name, p_size""")
def _(t):
    films = raw_films(t)
    media = b.build_media(films.withColumn("media_type", F.lit("film")), b.build_franchises(films))
    studios = b.build_studios(films)
    built = b.build_films(films, media, studios)
    titled = built.join(media.select(F.col("id").alias("media_id"), "title", "year"), "media_id")
    return titled.join(studios.select(F.col("id").alias("studio_id"), F.col("name").alias("studio")), "studio_id").select(
        "title", "year", "studio", "animation_type")


@query("build_talent", f"""
SELECT DISTINCT name FROM (SELECT CASE WHEN raw IS NOT NULL AND lower(raw) NOT IN ('n/a', 'none', 'unknown', '') THEN
  trim(regexp_replace(split_part(regexp_replace(trim(raw), ',\\s*([A-Z])', chr(1) || '\\1', 'g'), chr(1), 1), '\\s*\\([^)]*\\)\\s*$', '')) END AS name
  FROM (SELECT {RAW_ACTOR} AS raw FROM customer)) WHERE name <> ''""")
def _(t):
    return b.build_talent(t.raw("customer").select(F.expr(RAW_ACTOR).alias("voice_actor")), primary_only=True).drop("id")


@query("build_characters", with_views(
    f""", {RAW_PEOPLE} SELECT p.name, p.franchise, r.name AS role, g.name AS gender, p.first_appearance_year
       FROM (SELECT name, franchise, role, gender, CAST(first_appearance_year AS INTEGER) AS first_appearance_year FROM raw_people
             QUALIFY row_number() OVER (PARTITION BY name, franchise ORDER BY first_appearance_year, role, gender) = 1) p
       LEFT JOIN roles r ON r.name = p.role LEFT JOIN genders g ON g.name = p.gender""", "roles", "genders").replace(")\n, raw", "),\nraw"))
def _(t):
    built = b.build_characters(raw_people(t), t.roles, t.genders)
    named = built.join(t.roles.select(F.col("id").alias("role_id"), F.col("name").alias("role")), "role_id", "left")
    named = named.join(t.genders.select(F.col("id").alias("gender_id"), F.col("name").alias("gender")), "gender_id", "left")
    return named.select("name", "franchise", "role", "gender", "first_appearance_year")


@query("build_appearances", with_views(
    f""", {RAW_PEOPLE} SELECT p.name, p.franchise, p.title, p.year, p.voice_actor AS voice, r.name AS role
       FROM raw_people p LEFT JOIN roles r ON r.name = p.role
       QUALIFY row_number() OVER (PARTITION BY p.name, p.franchise, p.title, p.year ORDER BY p.voice_actor NULLS LAST, r.id NULLS LAST) = 1""",
    "roles").replace(")\n, raw", "),\nraw"))
def _(t):
    people, films = raw_people(t), raw_films(t)
    # titles and voices are written first: rows that meet tables of unknown size are shuffled before it is known
    media = written(b.build_media(films.withColumn("media_type", F.lit("film")), b.build_franchises(films)))
    characters = b.build_characters(people, t.roles, t.genders)
    talent = written(b.build_talent(people))
    built = b.build_appearances(people, media, t.roles)
    named = built.join(characters.select(F.col("id").alias("character_id"), "name", "franchise"), "character_id")
    titled = named.join(media.select(F.col("id").alias("media_id"), "title", "year"), "media_id")
    voices = talent.select(F.col("id").alias("talent_id"), F.col("name").alias("voice"))
    roles = t.roles.select(F.col("id").alias("role_id"), F.col("name").alias("role"))
    return titled.join(voices, "talent_id", "left").join(roles, "role_id", "left").select("name", "franchise", "title", "year", "voice", "role")


@query("junction_build", """
SELECT l_partkey, l_suppkey, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_partkey, l_suppkey""")
def _(t):
    return keys.build_junction(t.raw("lineitem"), ["l_partkey", "l_suppkey"], ["l_shipdate"], ["l_shipdate"]).drop("id")


@query("build_species", f"""
WITH known(id, name) AS (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(fv.SPECIES, start=1))}),
raw AS (SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_nationkey >= 20 UNION SELECT 'animal' WHERE false UNION SELECT 'unicorn'
  FROM customer WHERE c_nationkey = 12 UNION SELECT 'insect' FROM customer WHERE c_nationkey = 18 UNION SELECT 'fire machine' FROM customer WHERE c_nationkey = 17)
SELECT name FROM known UNION SELECT name FROM raw""")
def _(t):
    named = t.raw("customer").select(F.expr(RAW_SPECIES).alias("species"))
    return b.build_species(named, readers.species(t.spark)).select("name")


@query("species_exact_map", """
SELECT c_custkey, n_name AS species, CAST(n_regionkey AS BIGINT) AS species_id, 'sub' || n_nationkey AS species_subtype,
  n_nationkey % 2 = 0 AS is_anthropomorphic
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def _(t):
    mapping = t.raw("nation").select(
        F.col("n_name").alias("raw_value"), F.col("n_regionkey").cast("bigint").alias("species_id"),
        F.concat(F.lit("sub"), "n_nationkey").alias("species_subtype"), (F.col("n_nationkey") % 2 == 0).alias("is_anthropomorphic"))
    people = t.raw("customer").join(t.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("species")),
                                    "c_nationkey").select("c_custkey", "species")
    return b.map_species(people, mapping)


@query("record_contract", """
SELECT 'required:p_name' AS rule, CAST(p_partkey AS VARCHAR) AS key, 1::BIGINT AS rows FROM part WHERE p_name IS NULL
UNION ALL SELECT 'allowed:p_type', p_type, count(*) FROM part WHERE p_type NOT IN ('SMALL', 'LARGE') GROUP BY p_type""")
def _(t):
    contract = {"required": ["p_name"], "allowed": {"p_type": ["SMALL", "LARGE"]}}
    return quality.contract_violations(t.raw("part"), contract, ["p_partkey"])


@query("gender_aliases_by_nation", f"""
SELECT c_nationkey, gender, count(*) AS n FROM (SELECT c_nationkey,
  CASE WHEN raw IS NULL THEN 'n/a' ELSE coalesce({_case(fv.GENDER_ALIASES, 'trim(lower(raw))')}, trim(lower(raw))) END AS gender
  FROM (SELECT c_nationkey, {RAW_GENDER} AS raw FROM customer)) GROUP BY ALL""")
def _(t):
    return t.raw("customer").groupBy("c_nationkey", gender_alias(F.expr(RAW_GENDER)).alias("gender")).agg(F.count("*").alias("n"))


@query("union_first", """
SELECT s_suppkey AS id, s_name AS name FROM supplier
UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(t):
    suppliers = t.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customers = t.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return relational.union_first(["id"], suppliers, customers)
