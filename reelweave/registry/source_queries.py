"""Sources and optional outputs: the given rows are written below the shared folder and read back through the readers."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelweave.operators import documents as doc
from reelweave.operators import gram_index, offsets
from reelweave.plans import boxoffice as bo
from reelweave.registry import query
from reelweave.registry.catalogue import with_views
from reelweave.session import fresh_folder, handoff
from reelweave.sinks import writers
from reelweave.sources import readers


@query("read_ndjson", """
SELECT p_name AS title, CAST(p_size + 1970 AS INTEGER) AS year, p_brand AS studio,
  CASE WHEN p_size % 2 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-01-16' END AS ingest_date FROM part""")
def _(t):
    root = fresh_folder(t.spark, "ndjson")
    rows = t.raw("part").select(F.col("p_name").alias("title"), (F.col("p_size") + 1970).alias("year"), F.col("p_brand").alias("studio"), "p_size")
    for rest, day in enumerate(("2024-01-15", "2024-01-16")):
        rows.filter(F.col("p_size") % 2 == rest).drop("p_size").write.json(f"{root}/{day}")
    return readers.read_ndjson(t.spark, root, "title STRING, year INT, studio STRING")


@query("read_documents", """
SELECT 'docs of ' || r_name AS source_dir, n_name AS title, CAST(1990 + n_nationkey AS INTEGER) AS year, true AS dated
FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA'""")
def _(t):
    """One document per file, in folders with spaces; one folder is left out, and a broken file in each."""
    root = fresh_folder(t.spark, "documents")
    title = F.concat("n_name", F.lit(" ("), F.col("n_nationkey") + 1990, F.lit(")"))
    rows = t.raw("nation").join(t.raw("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    files = rows.select(F.concat(F.lit("docs of "), "r_name").alias("folder"), F.array(title).alias("films"))
    files.write.partitionBy("folder").option("maxRecordsPerFile", 1).json(root)
    docs = readers.read_documents(t.spark, root, skip_dirs=("folder=docs of ASIA",))
    stamped = doc.media_rows(docs)
    stamp = readers.with_source(t.spark.read.schema("films ARRAY<STRING>").option("recursiveFileLookup", "true").json(root))
    dated = stamp.groupBy("source_file").agg(F.max(F.col("extracted_at").isNotNull()).alias("dated"))
    return stamped.join(dated, "source_file").select(
        F.regexp_replace("source_dir", "^folder=", "").alias("source_dir"), "title", "year", "dated")


@query("optional_tables", with_views(
    "SELECT name, CAST(0 AS BIGINT) AS films, true AS in_catalogue FROM studios", "studios"))
def _(t):
    """Stored studios as a view and as an external table, beside films that were never written."""
    root, database = fresh_folder(t.spark, "tables"), f"reel_{uuid.uuid4().hex}"
    writers.write_table(t.studios, f"{root}/studios")
    readers.register_tables(t.spark, root, ["studios", "films"])
    counts = t.spark.sql("SELECT s.id, s.name, count(f.id) AS films FROM studios s LEFT JOIN films f ON f.studio_id = s.id GROUP BY s.id, s.name")
    for _ in range(2):
        readers.create_external_tables(t.spark, root, database, ["studios"])
    stored = t.spark.table(f"{database}.studios").select("id", F.lit(True).alias("in_catalogue"))
    return counts.join(stored, "id").select("name", "films", "in_catalogue")


@query("write_if_any", with_views(
    "SELECT 'films' AS name, true AS written, count(*) AS rows FROM films UNION ALL SELECT 'none', false, 0", "films"))
def _(t):
    root, report = fresh_folder(t.spark, "any"), []
    for name, rows in (("films", t.films), ("none", t.films.filter("id IS NULL"))):
        written = writers.write_if_any(rows, f"{root}/{name}")
        stored = readers.read_or_empty(t.spark, f"{root}/{name}", rows.schema)
        report.append(stored.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), F.lit(written).alias("written"), "rows"))
    return report[0].unionByName(report[1])


@query("transform_hook", "SELECT event_type, count(*) AS events FROM events WHERE event_type <> 'error' GROUP BY event_type")
def _(t):
    rows = readers.apply_hook(t.raw("events"), lambda d: d.filter(F.col("event_type") != "error"))
    return readers.apply_hook(rows, None).groupBy("event_type").agg(F.count("*").alias("events"))


@query("weekly_without_film_id", with_views(
    """, base AS (SELECT CASE WHEN film_id % 4 <> 0 THEN film_id END AS film_id, 'Film ' || film_id AS film_title,
         CAST(date_diff('day', DATE '2024-01-01', report_date) // 7 + 1 AS INTEGER) AS week_number, sum(revenue) AS total
       FROM event_reports GROUP BY ALL)
       SELECT film_id, film_title, week_number, CAST(total AS DOUBLE) AS total_revenue,
         CAST(lag(total) OVER (PARTITION BY film_title ORDER BY week_number) AS DOUBLE) AS prev_week_revenue FROM base""",
    "event_reports").replace(")\n, base", "),\nbase"))
def _(t):
    """Films without an id keep series of their own, told apart by title and year."""
    daily = t.event_reports().select(
        F.when(F.col("film_id") % 4 != 0, F.col("film_id")).alias("film_id"), F.concat(F.lit("Film "), "film_id").alias("film_title"),
        F.lit(2000).alias("film_year"), "report_date", "state_code", "revenue",
        (F.floor(F.date_diff("report_date", F.lit("2024-01-01").cast("date")) / 7) + 1).cast("int").alias("week_number"),
        (F.weekday("report_date") >= 4).alias("is_weekend"))
    return bo.build_weekly(daily).select("film_id", "film_title", "week_number", "total_revenue", "prev_week_revenue")


INDEXED = ["th", "the", "Thless", "tionsh", "ción", "absent words", "e. In", "https://", "x"]


@query("search_indexed", "SELECT wanted, doc_id, source FROM documents, (VALUES " + ", ".join(f"('{w}')" for w in INDEXED) + """) AS v(wanted)
WHERE contains(lower(text), lower(wanted)) OR contains(lower(source), lower(wanted))""")
def _(t):
    """Documents whose text or source contains a text, by the gram index of both columns."""
    path = fresh_folder(t.spark, "grams")
    gram_index.build_index(t.raw("documents"), "doc_id", ["text", "source"], path)
    found = [gram_index.search(t.spark, path, ["text", "source"], w).select(F.lit(w).alias("wanted"), F.col("key").alias("doc_id"), "source") for w in INDEXED]
    return reduce(DataFrame.unionByName, found)


@query("offset_ledger", """
WITH landed AS (SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS place FROM events WHERE event_type <> 'error'
  UNION ALL SELECT 'events', CAST(event_id % 4 AS INTEGER), event_id // 4 FROM events WHERE event_type = 'click' AND user_id % 10 = 0),
once AS (SELECT topic, partition, place, count(*) AS records FROM landed GROUP BY ALL),
numbered AS (SELECT *, place - row_number() OVER (PARTITION BY topic, partition ORDER BY place) AS island FROM once),
ranges AS (SELECT topic, partition, min(place) AS first, max(place) AS last, CAST(sum(records) AS BIGINT) AS records FROM numbered GROUP BY topic, partition, island),
gaps AS (SELECT topic, partition, last + 1 AS first, lead(first) OVER (PARTITION BY topic, partition ORDER BY first) - 1 AS last FROM ranges)
SELECT 'landed' AS kind, topic, partition, first, last, records, records - (last - first + 1) AS repeats FROM ranges
UNION ALL SELECT 'missing', topic, partition, first, last, 0, 0 FROM gaps WHERE last IS NOT NULL
UNION ALL SELECT 'commit', topic, partition, min_by(last, first) + 1, max(last), CAST(sum(records) AS BIGINT),
  CAST(sum(records - (last - first + 1)) AS BIGINT) FROM ranges GROUP BY topic, partition""")
def _(t):
    """Events as records of a topic with four partitions: errors never land, some clicks land again in a second batch."""
    path = fresh_folder(t.spark, "ledger")
    rows = t.raw("events").select(
        F.lit("events").alias("_kafka_topic"), (F.col("event_id") % 4).cast("int").alias("_kafka_partition"),
        F.expr("event_id div 4").alias("_kafka_offset"), "event_type", "user_id")
    offsets.write_batch(rows.where("event_type <> 'error'"), path, 0)
    offsets.write_batch(rows.where("event_type = 'click' AND user_id % 10 = 0"), path, 1)
    ledger = handoff(offsets.read_ledger(t.spark, path))  # read three times below
    none = F.lit(0).cast("bigint")
    landed = ledger.select(
        F.lit("landed").alias("kind"), "*", (F.col("records") - (F.col("last") - F.col("first") + 1)).alias("repeats"))
    missing = offsets.missing_ranges(ledger).select(F.lit("missing").alias("kind"), "*", none.alias("records"), none.alias("repeats"))
    commits = offsets.commit_points(ledger).select(
        F.lit("commit").alias("kind"), "topic", "partition", F.col("next_offset").alias("first"), F.col("highest").alias("last"), "records", "repeats")
    return landed.unionByName(missing).unionByName(commits)
