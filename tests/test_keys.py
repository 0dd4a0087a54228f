from pyspark.sql import functions as F

from reelweave.operators import keys, quality
from reelweave.operators import relational as rel


def test_first_per_key_treats_nulls_as_equal(table, values):
    df = table("k STRING, v INT", ("a", 2), ("a", 1), (None, 9), (None, 8))
    assert values(keys.first_per_key(df, ["k"], ["v"])) == [("a", 1), (None, 8)]


def test_surrogate_key_is_stable_and_sees_nulls(table):
    df = table("a STRING, b STRING", ("x", None), (None, "x"), ("x", "x"), (None, None), ("", None))
    ids = [r.id for r in df.select(keys.surrogate_key("a", "b").alias("id")).collect()]
    assert len(set(ids)) == 5
    again = [r.id for r in df.repartition(3).select(keys.surrogate_key("a", "b").alias("id")).collect()]
    assert sorted(ids) == sorted(again)


def test_dense_index_equals_row_number_on_any_partitioning(spark, values):
    rows = spark.range(5000).select(F.concat(F.lit("n"), F.xxhash64("id")).alias("name"))
    expected = [(n, i + 1) for i, n in enumerate(sorted(r.name for r in rows.collect()))]
    for partitions in (1, 7):
        numbered = keys.dense_index(rows.repartition(partitions), [F.col("name")])
        assert values(numbered, "name", "id") == expected


def test_dense_index_of_nothing(table):
    assert keys.dense_index(table("name STRING"), [F.col("name")]).count() == 0


def test_slug_ids_count_from_zero(table, values):
    df = table("name STRING", ("b",), ("a",))
    assert values(keys.slug_ids(df, F.col("name"), [F.col("name")])) == [("a", "a-0"), ("b", "b-1")]


def test_get_or_create_keeps_known_ids(table, values):
    known = table("id BIGINT, name STRING", (3, "b"), (7, "x"))
    seen = table("name STRING", ("b",), ("c",), ("a",), ("c",), (None,))
    assert values(keys.get_or_create_ids(known, seen)) == [(3, "b"), (7, "x"), (8, "a"), (9, "c")]
    assert values(keys.get_or_create_ids(known.limit(0), seen)) == [(1, "a"), (2, "b"), (3, "c")]


def test_resolve_lookup(table, values):
    roles = table("id BIGINT, name STRING", (1, "hero"), (2, "supporting"))
    df = table("n INT, role STRING", (1, "hero"), (2, "odd"), (3, None))
    assert values(keys.resolve_lookup(df, roles, F.col("role"), "role_id"), "n", "role_id") == [(1, 1), (2, None), (3, None)]
    assert values(keys.resolve_lookup(df, roles, F.col("role"), "role_id", "supporting"), "n", "role_id") == [(1, 1), (2, 2), (3, 2)]


def test_build_dim_and_junction(table, values):
    df = table("name STRING, year INT", ("a", 2), ("a", 1), ("", 3), (None, 4))
    assert values(keys.build_dim(df, "name", ["year"]), "name", "year") == [("a", 1)]
    links = table("a BIGINT, b BIGINT, c INT", (1, 1, 5), (1, 1, 4), (1, None, 3), (2, 1, 2))
    assert values(keys.build_junction(links, ["a", "b"], ["c"], ["c"]), "a", "b", "c") == [(1, 1, 4), (2, 1, 2)]


def test_split_orphans_keeps_every_row(table, values):
    df, parent = table("k INT, v INT", (1, 1), (1, 2), (2, 3), (None, 4)), table("k INT", (1,), (1,))
    kept, rejected = keys.split_orphans(df, parent, ["k"])
    assert values(kept) == [(1, 1), (1, 2)]
    assert values(rejected) == [(2, 3), (None, 4)]


def test_violations(table, values):
    df = table("a INT, b INT, c STRING", (1, None, "x"), (1, None, "y"), (2, 5, "x"), (None, 6, None))
    found = quality.violations(
        quality.duplicate_keys(df, "unique", ["a", "b"]), quality.missing_values(df, "a", "a", ["b"]),
        quality.orphans(df, "fk", "b", table("id INT", (5,)), "id"), quality.not_allowed(df, "enum", "c", ["x"]))
    assert values(found) == [("a", "6", 1), ("enum", "y", 1), ("fk", "6", 1), ("unique", "1|null", 2)]


def test_contract(table, values):
    from reelweave.schemas import RECORD_CONTRACTS

    films = table("title STRING, year INT, studio STRING, franchise STRING, animation_type STRING, source_file STRING",
                  ("A", 1990, "S", "F", "hybrid", "a.json"), (None, 1990, "S", "F", "clay", "b.json"))
    found = quality.contract_violations(films, RECORD_CONTRACTS["film"], ["source_file"])
    assert values(found) == [("allowed:animation_type", "clay", 1), ("required:title", "b.json", 1)]


def test_filters_and_ranking(table, values):
    df = table("id INT, g STRING, v INT, name STRING", (1, "a", 5, "Ann"), (2, "a", 5, "Bob"), (3, "a", 4, "Cy"), (4, "b", 1, "Ann"))
    assert values(rel.top_per_group(df, ["g"], F.desc("v"), 1), "id", "rank") == [(1, 1), (2, 1), (4, 1)]
    assert values(rel.facet_filter(df, "name", "an", g="a", v="all"), "id") == [(1,)]
    assert values(rel.search(df, ["name"], "", [F.col("id")], 2), "id") == [(1,), (2,)]
    assert values(rel.point_lookup(df, "id", 3), "name") == [("Cy",)]
    assert values(rel.distinct_list(df, ["g"], "name", "names")) == [("a", "Ann, Bob, Cy"), ("b", "Ann")]
    assert [r.id for r in rel.rows_of(df, "g", "a", F.desc("id")).collect()] == [3, 2, 1]


def test_branch_counts_do_not_multiply(table, values):
    parent = table("id INT", (1,), (2,))
    one, two = table("p INT", (1,), (1,), (1,)), table("p INT", (1,), (1,), (None,))
    assert values(rel.with_branch_counts(parent, {"x": (one, "p"), "y": (two, "p")})) == [(1, 3, 2), (2, 0, 0)]


def test_composite_lookup_never_matches_nulls(table, values):
    df, other = table("a STRING, b INT", ("x", 1), ("x", None)), table("k STRING, n INT, v STRING", ("x", 1, "hit"), ("x", None, "no"))
    assert values(rel.composite_lookup(df, other, {"a": "k", "b": "n"}, {"v": "v"})) == [("x", 1, "hit"), ("x", None, None)]


def test_concat_extracts_and_gender_split(table, values):
    assert values(rel.concat_extracts(table("a INT", (1,)), table("b INT", (2,)))) == [(1, None), (None, 2)]
    people = table("g STRING, gender STRING", ("x", "male"), ("x", None), ("x", "n/a"), ("y", "female"))
    assert values(rel.gender_split(people, ["g"], with_total=True)) == [("x", 1, 0, 2, 3), ("y", 0, 1, 0, 1)]
