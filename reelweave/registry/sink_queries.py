"""Upserts, exports and streaming jobs. Each writes to a new folder and returns what a reader of it sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelweave.functions.measures import MONEY
from reelweave.plans import marts, stages
from reelweave.plans.builders import NOMINATION_KEYS, upsert_nominations
from reelweave.registry import query
from reelweave.registry.catalogue import with_views
from reelweave.registry.catalogue_queries import FILMS_COMPLETE
from reelweave.session import fresh_folder
from reelweave.sinks import upsert, writers
from reelweave.sinks.buckets import write_bucketed
from reelweave.sources import streams
from reelweave.streaming import facts, landing, revenue, windows

DAILY = ["film_id", "report_date", "state_code"]
LATEST = """SELECT film_id, report_date, state_code, CAST(revenue AS DOUBLE) AS revenue FROM event_reports
  QUALIFY row_number() OVER (PARTITION BY film_id, report_date, state_code ORDER BY ts DESC, event_id DESC) = 1"""


@query("upsert_update", with_views(LATEST, "event_reports"))
def _(t):
    rows = t.event_reports()
    day = F.to_date("ts")
    target = upsert.latest_per_key(rows.filter(day <= F.lit("2024-01-20")), DAILY, ["ts", "event_id"])
    merged = upsert.upsert_update(target, rows.filter(day >= F.lit("2024-01-10")), DAILY, ["ts", "event_id"])
    return merged.select(*DAILY, "revenue")


@query("upsert_insert_absent", """
SELECT name, source FROM (SELECT s_name AS name, 'old' AS source FROM supplier UNION ALL
  (SELECT n, 'new' FROM (SELECT DISTINCT CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey < 5 THEN 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE c_name END AS n FROM customer)
   WHERE n IS NULL OR n NOT IN (SELECT s_name FROM supplier)))""")
def _(t):
    target = t.raw("supplier").select(F.col("s_name").alias("name"), F.lit("old").alias("source"))
    name = F.when(F.col("c_nationkey") != 0, F.when(
        F.col("c_nationkey") < 5, F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))).otherwise(F.col("c_name")))
    incoming = t.raw("customer").select(name.alias("name"), F.lit("new").alias("source"), "c_custkey")
    return upsert.insert_absent(target, incoming.drop("c_custkey"), ["name"], ["source"])


@query("upsert_coalesce", """
SELECT coalesce(p_partkey, c_custkey) AS id, coalesce(CASE WHEN c_nationkey > 5 THEN c_mktsegment END, p_brand) AS owner, coalesce(c_name, p_name) AS label
FROM part FULL JOIN customer ON c_custkey = p_partkey""")
def _(t):
    stored = t.raw("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("owner"), F.col("p_name").alias("label"))
    changes = t.raw("customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("owner"), F.col("c_name").alias("label"))
    return upsert.upsert_coalesce(stored, changes, ["id"], ["owner", "label"])


@query("upsert_outcomes", with_views(
    """, raw AS (SELECT media_id, award_category_id, year, CASE WHEN id % 3 = 0 THEN NULL ELSE talent_id END AS talent_id, outcome, id FROM nominations),
       firsts AS (SELECT *, row_number() OVER (PARTITION BY media_id, award_category_id, year, talent_id ORDER BY id) AS up,
         row_number() OVER (PARTITION BY media_id, award_category_id, year, talent_id ORDER BY id DESC) AS down FROM raw)
       SELECT a.media_id, a.award_category_id, a.year, a.talent_id, b.outcome, a.id AS first_id
       FROM firsts a JOIN firsts b ON a.media_id = b.media_id AND a.award_category_id = b.award_category_id AND a.year = b.year
         AND a.talent_id IS NOT DISTINCT FROM b.talent_id WHERE a.up = 1 AND b.down = 1""", "nominations").replace(")\n, raw", "),\nraw"))
def _(t):
    raw = t.nominations.select(
        "media_id", "award_category_id", "year", F.when(F.col("id") % 3 != 0, F.col("talent_id")).alias("talent_id"),
        F.lit(None).cast("bigint").alias("song_id"), "outcome", F.col("id").alias("first_id"))
    stored = upsert.first_per_key(raw, NOMINATION_KEYS, ["first_id"])
    return upsert_nominations(stored, raw, ["first_id"]).drop("song_id")


@query("upsert_table", with_views(LATEST, "event_reports"))
def _(t):
    """Three overlapping batches, the last one a replay of the first, into one partitioned table."""
    schema = f"film_id BIGINT, state_code STRING, revenue {MONEY}, event_id BIGINT, ts TIMESTAMP_NTZ, report_date DATE"
    folder = fresh_folder(t.spark, "upsert-table")
    rows, day = t.event_reports(), F.to_date("ts")
    batches = [rows.filter(day <= F.lit("2024-01-20")), rows.filter(day >= F.lit("2024-01-10")), rows.filter(day <= F.lit("2024-01-20"))]
    for number, batch in enumerate(batches):
        changes = upsert.latest_per_key(batch, DAILY, ["ts", "event_id"])
        upsert.upsert_table(t.spark, f"{folder}/table", f"{folder}/staged/{number}", changes, schema, DAILY, ["ts", "event_id"], "report_date")
    return t.spark.read.schema(schema).parquet(f"{folder}/table").select(*DAILY, "revenue")


@query("export_mart", with_views("SELECT studio_id, count(*) AS films FROM films GROUP BY studio_id", "films"))
def _(t):
    folder = fresh_folder(t.spark, "mart")
    writers.export_mart(t.films.groupBy("studio_id").agg(F.count("*").alias("films")), folder)
    return t.spark.read.parquet(folder)


@query("stage_report", with_views(
    """SELECT 0 AS position, 'films' AS "table", (SELECT count(*) FROM films) AS rows, 'written' AS state
       UNION ALL SELECT 1, 'media', NULL, 'skipped' UNION ALL SELECT 2, 'talent', (SELECT count(*) FROM talent), 'written'""",
    "films", "talent"))
def _(t):
    plan = [("films", lambda: t.films), ("media", lambda: t.media), ("talent", lambda: t.talent)]
    return stages.run_stages(t.spark, plan, fresh_folder(t.spark, "stages"), skip=["media"])


# ---------------------------------------------------------------- streams

BAD = "CASE event_type WHEN 'error' THEN event_id % 4 ELSE 9 END"


def message_folder(t):
    """The events as files of JSON lines {partition, offset, value}; some of the error events are spoiled."""
    value = F.to_json(F.struct(
        F.lit("revenue_report").alias("event_type"), F.col("user_id").alias("film_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("report_date"), F.col("event_type").alias("state_code"),
        F.col("value").alias("revenue"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))
    bad = F.expr(BAD)
    spoiled = (
        F.when(bad == 0, F.substring(value, 1, 20))
        .when(bad == 1, F.regexp_replace(value, r'"report_date":"[^"]*",', ""))
        .when((bad == 2) & (F.col("event_id") % 8 == 2), F.regexp_replace(value, r'("report_date":"[^"]*)"', '$1garbage"'))
        .when(bad == 2, F.regexp_replace(value, r'"report_date":"[^"]*"', '"report_date":"soon"'))
        .when(bad == 3, F.regexp_replace(value, r'"revenue":[^,}]*,', ""))
        .otherwise(value)
    )
    folder = fresh_folder(t.spark, "messages")
    messages = t.raw("events").select((F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"), spoiled.alias("value"))
    messages.write.option("maxRecordsPerFile", 2500).json(folder)
    return folder


DELIVERIES = 8


def in_deliveries(t, folder, files):
    """The messages of a folder as a stream: batches of so many files, or of an eighth of all files where that is more.

    So the number of batches, each of which rewrites what it touches, does not grow with the events.
    """
    found = len(t.spark.read.schema("value STRING").json(folder).inputFiles())
    return streams.read_folder(t.spark, folder, "revenue-events", max_files=max(files, -(-found // DELIVERIES)))


GOOD = f"SELECT * FROM event_reports e JOIN events USING (event_id) WHERE {BAD.replace('event_type', 'events.event_type')} = 9"


@query("stream_upsert_daily", with_views(
    LATEST.replace("FROM event_reports", f"FROM (SELECT * FROM event_reports WHERE {BAD.replace('event_type', 'state_code')} = 9)"), "event_reports"))
def _(t):
    """Batches of two or more files in no particular order; a second query then replays everything at once."""
    folder = fresh_folder(t.spark, "daily")
    source = message_folder(t)
    first, replay = in_deliveries(t, source, 2), streams.read_folder(t.spark, source, "revenue-events")
    for run, messages in (("first", first), ("replay", replay)):
        revenue.upsert_daily(messages, f"{folder}/table", f"{folder}/quarantine-{run}", f"{folder}/{run}").awaitTermination()
    stored = t.spark.read.schema(revenue.DAILY_SCHEMA).parquet(f"{folder}/table")
    return stored.select(*revenue.DAILY_KEYS, "revenue")


@query("stream_quarantine", f"""
SELECT event_id AS _kafka_offset, CASE {BAD} WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing_key' WHEN 2 THEN 'bad_date' ELSE 'missing_revenue' END AS reason
FROM events WHERE {BAD} < 9""")
def _(t):
    folder = fresh_folder(t.spark, "quarantine")
    messages = in_deliveries(t, message_folder(t), 2)
    revenue.upsert_daily(messages, f"{folder}/table", f"{folder}/quarantine", f"{folder}/work").awaitTermination()
    return t.spark.read.parquet(f"{folder}/quarantine").select("_kafka_offset", "reason")


@query("stream_land_json", """
SELECT 'revenue-events' AS topic, CAST(user_id % 3 AS BIGINT) AS _kafka_partition, count(*) AS messages, min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events GROUP BY user_id % 3""")
def _(t):
    folder = fresh_folder(t.spark, "landing")
    messages = in_deliveries(t, message_folder(t), 1)
    landing.land_topics(messages, f"{folder}/raw", f"{folder}/work").awaitTermination()
    landed = t.spark.read.schema("value STRING, _kafka_partition BIGINT, _kafka_offset BIGINT, topic STRING, ingest_date DATE").json(f"{folder}/raw")
    return landed.groupBy("topic", "_kafka_partition").agg(
        F.count("*").alias("messages"), F.min("_kafka_offset").alias("first_offset"), F.max("_kafka_offset").alias("last_offset"))


STREAM_FACTS = f""", latest AS (
    SELECT film_id, report_date, state_code, revenue FROM (SELECT * FROM event_reports WHERE {BAD.replace('event_type', 'state_code')} = 9)
    QUALIFY row_number() OVER (PARTITION BY film_id, report_date, state_code ORDER BY ts DESC, event_id DESC) = 1),
  first AS (SELECT film_id, min(report_date) AS release FROM latest GROUP BY film_id),
  dated AS (SELECT l.*, m.title AS film_title, m.year AS film_year, isodow(report_date) >= 5 AS is_weekend,
      CAST(date_diff('day', release, report_date) // 7 + 1 AS INTEGER) AS week_number
    FROM latest l JOIN first USING (film_id) LEFT JOIN media m ON m.id = film_id)"""


def kept_facts(t, table):
    """A table of the facts after batches of two or more files each; titles come from the catalogue."""
    folder = fresh_folder(t.spark, "facts")
    titles = t.media.select(F.col("id").alias("film_id"), F.col("title").alias("film_title"), F.col("year").alias("film_year"))
    messages = in_deliveries(t, message_folder(t), 2)
    facts.keep_facts(messages, f"{folder}/tables", f"{folder}/quarantine", f"{folder}/work", titles, buckets=16).awaitTermination()
    return t.spark.read.schema(facts.SCHEMAS[table]).parquet(f"{folder}/tables/{table}").drop("id", facts.BUCKET)


@query("stream_weekly_facts", with_views(
    STREAM_FACTS + """, weeks AS (
      SELECT film_id, film_title, film_year, week_number, sum(revenue) AS total_revenue, CAST(sum(revenue) AS DOUBLE) / count(*) AS avg_daily_revenue,
        count(*) AS days_reporting, count(DISTINCT report_date) AS distinct_days, coalesce(sum(revenue) FILTER (is_weekend), 0) AS weekend_revenue,
        coalesce(sum(revenue) FILTER (NOT is_weekend), 0) AS weekday_revenue, count(DISTINCT state_code) AS states_reporting FROM dated GROUP BY ALL),
      chained AS (SELECT *, lag(total_revenue) OVER (PARTITION BY film_id ORDER BY week_number) AS previous FROM weeks)
    SELECT film_id, film_title, film_year, week_number, CAST(total_revenue AS DOUBLE) AS total_revenue, avg_daily_revenue, days_reporting, distinct_days,
      CAST(weekend_revenue AS DOUBLE) AS weekend_revenue, CAST(weekday_revenue AS DOUBLE) AS weekday_revenue, states_reporting,
      CAST(previous AS DOUBLE) AS prev_week_revenue,
      CASE WHEN previous > 0 THEN CAST(total_revenue - previous AS DOUBLE) / CAST(previous AS DOUBLE) END AS wow_change FROM chained""",
    "event_reports", "media").replace(")\n, latest", "),\nlatest"))
def _(t):
    return kept_facts(t, "weekly")


@query("stream_total_facts", with_views(
    STREAM_FACTS + """ SELECT film_id, film_title, film_year, CAST(sum(revenue) AS DOUBLE) AS total_revenue, min(report_date) AS first_report_date,
      max(report_date) AS last_report_date, max(week_number) AS weeks_in_release, count(DISTINCT report_date) AS days_in_release,
      count(DISTINCT state_code) AS states_reached, CAST(sum(revenue) FILTER (week_number = 1) AS DOUBLE) AS opening_week_revenue,
      CAST(sum(revenue) AS DOUBLE) / count(DISTINCT report_date) AS avg_daily_revenue FROM dated GROUP BY ALL""",
    "event_reports", "media").replace(")\n, latest", "),\nlatest"))
def _(t):
    return kept_facts(t, "total")


@query("stream_daily_window", with_views(
    """SELECT report_date, state_code, CAST(sum(revenue) AS DOUBLE) AS total, count(*) AS reports FROM event_reports
       GROUP BY report_date, state_code""", "event_reports"))
def _(t):
    """Daily totals by state of all windows, closed and open."""
    folder = fresh_folder(t.spark, "windows")
    t.raw("events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("state_code"),
                           F.col("value").cast(MONEY).alias("revenue")).write.parquet(f"{folder}/events")
    rows = t.spark.readStream.schema(f"ts TIMESTAMP, state_code STRING, revenue {MONEY}").parquet(f"{folder}/events")
    totals = windows.windowed_totals(rows, "ts", ["state_code"], "revenue", "1 day", "1 day")
    windows.write_windows(totals, f"{folder}/totals", f"{folder}/work").awaitTermination()
    return t.spark.read.parquet(f"{folder}/totals").select(F.to_date("window_start").alias("report_date"), "state_code", "total", "reports")


@query("release_weeks", with_views(
    """SELECT film_id, report_date, state_code, CAST(date_diff('day', min(report_date) OVER (PARTITION BY film_id), report_date) // 7 + 1 AS INTEGER) AS week_number, event_id
       FROM event_reports""", "event_reports"))
def _(t):
    return revenue.with_week_number(t.event_reports(), ["film_id"]).select("film_id", "report_date", "state_code", "week_number", "event_id")


@query("films_complete_bucketed", with_views(FILMS_COMPLETE, "films", "media", "studios", "franchises", "total"))
def _(t):
    layout = {"media": "id", "films": "media_id", "box_office_total": "film_id"}
    root = fresh_folder(t.spark, "buckets")
    bucketed = write_bucketed(t.spark, t, root, root.rsplit("/", 1)[-1].replace("-", "_"), layout, 8)
    return marts.films_complete(bucketed)
