"""A third of all rows shares one key; results must equal a brute-force count in plain Python."""

import collections

import pytest
from pyspark.sql import functions as F

from reelweave.operators import keys
from reelweave.plans import boxoffice, insights, people
from reelweave.plans.tables import Tables
from reelweave.sinks import upsert

ROWS = 30_000


@pytest.fixture(scope="module")
def rows(spark):
    """(character, media, talent, role): every third row belongs to character 0 and talent 0."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(ROWS).select(
        F.when(hot, 0).otherwise(n % 997 + 1).alias("character_id"), (n * 7919 % 4001).alias("media_id"),
        F.when(hot, 0).otherwise(n % 53).alias("talent_id"), (n % 5 + 1).alias("role_id")).repartition(6).cache()


@pytest.fixture(scope="module")
def plain(rows):
    return [tuple(r) for r in rows.collect()]


def catalogue(spark, cast):
    def table(name):
        n = F.col("id")
        return {
            "character_appearances": cast,
            "characters": spark.range(998).select(n, F.concat(F.lit("c"), n).alias("name"), F.concat(F.lit("f"), n % 4).alias("franchise")),
            "media": spark.range(4001).select(n, (n % 60 + 1950).cast("int").alias("year"), F.when(n % 2 == 0, "film").otherwise("game").alias("media_type"), (n % 4).alias("franchise_id")),
            "films": spark.range(4001).filter("id % 2 = 0").select(n, n.alias("media_id"), (n % 7).alias("studio_id")),
            "studios": spark.range(7).select(n, F.concat(F.lit("s"), n).alias("name")),
            "talent": spark.range(53).select(n, F.concat(F.lit("t"), n).alias("name")),
        }[name]

    return Tables(table)


def test_junction(spark, rows, plain, values):
    first = {}
    for c, m, t, r in plain:
        first[c, m] = min(first.get((c, m), (t, r)), (t, r))
    built = keys.build_junction(rows, ["character_id", "media_id"], ["talent_id", "role_id"], ["talent_id", "role_id"])
    assert values(built, "character_id", "media_id", "talent_id", "role_id") == sorted(((*k, *v) for k, v in first.items()), key=lambda r: tuple((False, str(v)) for v in r))


def test_upsert_keeps_one_row_per_key(spark, rows, plain):
    kept = upsert.latest_per_key(rows, ["character_id"], ["media_id", "talent_id", "role_id"]).collect()
    best = {}
    for row in plain:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:])
    assert {tuple(r) for r in kept} == set(best.values())


def test_actor_queries(spark, rows, plain):
    pairs = {}
    for c, m, t, r in plain:
        pairs[c, m] = min(pairs.get((c, m), (t, r)), (t, r))
    cast = keys.build_junction(rows, ["character_id", "media_id"], ["talent_id", "role_id"], ["talent_id", "role_id"])
    t = catalogue(spark, cast)
    by_actor, by_studio = collections.Counter(), collections.Counter()
    for (_, m), (actor, _) in pairs.items():
        by_actor[f"t{actor}"] += 1
        if m % 2 == 0:
            by_studio[f"t{actor}", f"s{m % 7}"] += 1
    careers = {r.voice_actor: r.total_appearances for r in people.actor_careers(t, k=100).collect()}
    assert careers == {a: n for a, n in by_actor.items() if n >= 3}
    shares = {(r.voice_actor, r.studio_name): r.appearances_at_studio for r in people.actor_studio_share(t).collect()}
    assert shares == {k: n for k, n in by_studio.items() if n >= 2}


def test_co_appearances_are_a_star(spark, rows, plain):
    cast = {(c, m) for c, m, _, _ in plain}
    seen = collections.Counter((m % 4, c) for c, m in cast)
    hubs = {}
    for (f, c), n in seen.items():
        if f not in hubs or (-n, c) < (-seen[f, hubs[f]], hubs[f]):
            hubs[f] = c
    by_media = collections.defaultdict(set)
    for c, m in cast:
        by_media[m].add(c)
    expected = collections.Counter()
    for media, members in by_media.items():
        hub = hubs[media % 4]
        if hub in members:
            expected.update((media % 4, hub, other) for other in members if other != hub)
    t = catalogue(spark, rows.select("character_id", "media_id").distinct())
    links = {(r.franchise_id, r.source_id, r.target_id): r.shared_titles for r in insights.co_appearances(t).collect()}
    assert links == dict(expected)


def test_dense_index_with_one_big_group(rows, plain):
    numbered = keys.dense_index(rows.withColumn("n", F.monotonically_increasing_id()), [F.col("character_id"), F.col("n")], "pos")
    got = sorted((r.pos, r.character_id) for r in numbered.select("pos", "character_id").collect())
    assert [p for p, _ in got] == list(range(1, ROWS + 1))
    assert [c for _, c in got] == sorted(c for c, _, _, _ in plain)


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def split_early(spark):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df._jdf.queryExecution()
    rows.executedPlan().executeCollect()
    return rows.executedPlan().toString()


@pytest.fixture(scope="module")
def reports(spark):
    n = F.col("id")
    film = F.when(n % 3 == 0, 0).otherwise(n % 97 + 1)
    return spark.range(60_000).select(
        film.alias("film_id"), F.concat(F.lit("Film "), film).alias("film_title"), F.lit(2000).alias("film_year"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 400).cast("int")).alias("report_date"), (n % 50).cast("string").alias("state_code"),
        (n % 1000).cast("decimal(14,2)").alias("revenue")).repartition(6).cache()


def test_a_hot_film_is_split_in_the_daily_fact(spark, split_early, reports):
    titles = reports.select("film_id", F.upper("film_title").alias("title")).distinct()
    assert "skew=true" in executed(boxoffice.release_calendar(reports.drop("film_title"), ["film_id"], attributes=titles))


def test_a_hot_film_is_summed_before_the_shuffle(spark, reports):
    reduced = reports.groupBy("film_id", "report_date", "state_code").agg(F.sum("revenue"))
    assert "partial_sum" in reduced._jdf.queryExecution().executedPlan().toString()
    days = boxoffice.release_calendar(boxoffice.reduce_reports(reports, ["film_id"]), ["film_id"])
    assert days.agg(F.sum("reports")).first()[0] == 60_000
    plain = boxoffice.release_calendar(reports, ["film_id"])
    weekly = boxoffice.weekly_facts(days.withColumns({"film_title": F.lit("x"), "film_year": F.lit(1)}))
    by_hand = plain.groupBy("film_id", "week_number").agg(F.sum("revenue").alias("r"), F.count("*").alias("n"), F.countDistinct("state_code").alias("s"), F.countDistinct("report_date").alias("d"))
    found = {(r.film_id, r.week_number): (r.total_revenue, r.days_reporting, r.states_reporting, r.distinct_days) for r in weekly.collect()}
    assert found == {(r.film_id, r.week_number): (r.r, r.n, r.s, r.d) for r in by_hand.collect()}


def test_reduced_rows_are_dealt_out_by_their_number(spark, reports, monkeypatch):
    """The facts' tasks take a fixed number of reduced rows, however many rows there are, and the rows stay the same."""
    reduced = boxoffice.reduce_reports(reports, ["film_id"])
    monkeypatch.setattr(boxoffice, "ROWS", reduced.count() // 40)
    days = boxoffice.release_calendar(reduced, ["film_id"], reduced=True)
    assert days.rdd.getNumPartitions() >= 40 and "REPARTITION_BY_NUM" in executed(days)
    plain = boxoffice.release_calendar(reduced, ["film_id"])
    assert days.exceptAll(plain).count() == plain.exceptAll(days).count() == 0


def test_facts_lay_no_row_out_per_distinct_count(reports):
    days = boxoffice.release_calendar(boxoffice.reduce_reports(reports, ["film_id"]), ["film_id"], reduced=True)
    for facts in (boxoffice.weekly_facts, boxoffice.film_facts):
        titled = days.withColumns({"film_title": F.lit("t"), "film_year": F.lit(1)}) if "film_title" not in days.columns else days
        assert "Expand" not in executed(facts(titled))
