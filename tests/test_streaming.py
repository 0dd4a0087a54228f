import json
from types import SimpleNamespace

from pyspark.sql import functions as F

from reelweave.registry import sink_queries
from reelweave.sources import streams
from reelweave.streaming import landing, revenue, windows


def message(offset, film=1, day="2024-01-05", state="CA", value=1.0, at="2024-01-05T10:00:00", **change):
    body = {"event_type": "revenue_report", "film_id": film, "report_date": day, "state_code": state, "revenue": value, "timestamp": at}
    return {"partition": 0, "offset": offset, "value": json.dumps({k: v for k, v in {**body, **change}.items() if v != "drop"})}


def write(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(m) for m in messages))


def test_upsert_keeps_the_newest_and_quarantines_the_rest(spark, tmp_path, values):
    source = tmp_path / "in"
    write(source, "1.json", message(1, value=1.0), message(2, value=2.0, at="2024-01-05T11:00:00"), message(3, state="NY", value=5.0),
          message(4, day="soon"), message(14, day="2024-01-05garbage"), message(15, day="2024-01-05 garbage"), message(16, state="WA", value=3.0, day="2024-01-05T23:00:00"), message(5, report_date="drop"), {"partition": 0, "offset": 6, "value": "{bad"}, message(7, value=None), message(12, value="much"), {"partition": 0, "offset": 13, "value": "[1, 2]"}, message(8, value=0.1, state="TX"))
    # an older event with a higher offset, a duplicate and a newer one
    write(source, "2.json", message(9, value=9.0, at="2024-01-05T09:00:00"), message(3, state="NY", value=5.0), message(10, state="NY", value=6.0, at="2024-01-06T00:00:00"))

    def run(work):
        messages = streams.read_folder(spark, str(source), "revenue-events", max_files=1)
        revenue.upsert_daily(messages, f"{tmp_path}/daily", f"{tmp_path}/{work}-bad", f"{tmp_path}/{work}").awaitTermination()
        rows = spark.read.schema(revenue.DAILY_SCHEMA).parquet(f"{tmp_path}/daily")
        return values(rows.select("film_id", F.col("report_date").cast("string"), "state_code", F.col("revenue").cast("double")))

    expected = [(1, "2024-01-05", "CA", 2.0), (1, "2024-01-05", "NY", 6.0), (1, "2024-01-05", "TX", 0.1), (1, "2024-01-05", "WA", 3.0)]
    assert run("first") == expected
    bad = spark.read.parquet(f"{tmp_path}/first-bad")
    assert values(bad, "_kafka_offset", "reason") == [
        (12, "malformed"), (13, "malformed"), (14, "bad_date"), (15, "bad_date"), (4, "bad_date"), (5, "missing_key"), (6, "malformed"), (7, "missing_revenue")]
    # everything replayed by another query, then more input for the first one
    assert run("replay") == expected
    write(source, "3.json", message(11, state="TX", value=7.0, at="2024-01-07T00:00:00", day="2024-01-06"))
    assert run("first") == [*expected, (1, "2024-01-06", "TX", 7.0)]


def test_landing_keeps_every_message(spark, tmp_path, values):
    write(tmp_path / "in", "1.json", message(1), {"partition": 1, "offset": 2, "value": "{bad"})
    messages = streams.read_folder(spark, str(tmp_path / "in"), "raw-films", max_files=1)
    landing.land_topics(messages, f"{tmp_path}/raw", f"{tmp_path}/w", transform=lambda d: d.filter("_kafka_offset < 100")).awaitTermination()
    folders = list((tmp_path / "raw" / "topic=raw-films").glob("ingest_date=*"))
    assert len(folders) == 1
    landed = spark.read.json(str(tmp_path / "raw"))
    assert values(landed, "_kafka_offset") == [(1,), (2,)]


def test_open_and_closed_windows_are_published(spark, tmp_path, values):
    rows = spark.createDataFrame(
        [("2024-01-01 05:00:00", "CA", 1.0), ("2024-01-01 06:00:00", "CA", 2.0), ("2024-01-02 01:00:00", "CA", 4.0), ("2024-01-04 00:00:00", "NY", 8.0)],
        "ts STRING, s STRING, v DOUBLE").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    totals = windows.windowed_totals(stream, "ts", ["s"], "v", "1 day", "12 hours")
    windows.write_windows(totals, f"{tmp_path}/out", f"{tmp_path}/w").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").select(F.to_date("window_start").cast("string"), "s", "total", "reports")
    assert values(out) == [("2024-01-01", "CA", 3.0, 2), ("2024-01-02", "CA", 4.0, 1), ("2024-01-04", "NY", 8.0, 1)]


def test_week_number(table, values):
    daily = table("film_id INT, report_date STRING", (1, "2024-01-05"), (1, "2024-01-11"), (1, "2024-01-12"), (2, "2024-01-12"))
    rows = revenue.with_week_number(daily.withColumn("report_date", F.col("report_date").cast("date")), ["film_id"])
    assert values(rows.select("film_id", F.col("report_date").cast("string"), "week_number")) == [
        (1, "2024-01-05", 1), (1, "2024-01-11", 1), (1, "2024-01-12", 2), (2, "2024-01-12", 1)]


def test_many_files_make_no_more_batches(spark, tmp_path):
    source = tmp_path / "in"
    for n in range(20):
        write(source, f"{n}.json", message(n))
    messages = sink_queries.in_deliveries(SimpleNamespace(spark=spark), str(source), 1)
    landing.land_topics(messages, f"{tmp_path}/raw", f"{tmp_path}/work").awaitTermination()
    assert len(list((tmp_path / "work" / "checkpoint" / "commits").glob("[0-9]*"))) <= 8
    assert spark.read.json(f"{tmp_path}/raw").count() == 20
