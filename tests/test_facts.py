"""Facts kept current by batches equal a full rebuild, and batches leave other films alone."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelweave.sinks.upsert import latest_per_key
from reelweave.streaming import facts
from reelweave.streaming.revenue import DAILY_KEYS, DAILY_SCHEMA, SEQUENCE

BUCKETS = 8


def row(film, day, state, revenue, at):
    return (film, date(2024, 1, 1) + timedelta(days=day), state, Decimal(revenue), datetime(2024, 3, 1) + timedelta(minutes=at), 0, at)


def batches():
    rng = random.Random(3)
    first = [row(f, rng.randint(20, 60), rng.choice(["CA", "NY", "TX"]), rng.randint(1, 999), k) for k, f in enumerate(rng.choices(range(12), k=150))]
    moved = [row(3, 2, "CA", 50, 1000), row(3, 2, "CA", 60, 1001), row(5, 40, "NY", 7, 1002)]  # film 3 starts earlier
    late = [row(5, 40, "NY", 8, 10), row(None, 1, "CA", 5, 1003), row(40, 9, "TX", 1, 1004)]  # an older change, new films
    return [first, moved, late]


@pytest.fixture
def titles(table):
    return table("film_id BIGINT, film_title STRING, film_year INT", *[(k, f"Film {k}", 2000 + k) for k in range(12)])


def frame(spark, rows):
    return spark.createDataFrame(rows, DAILY_SCHEMA)


def read(spark, root, table):
    return spark.read.schema(facts.SCHEMAS[table]).parquet(f"{root}/{table}")


def assert_rebuilt(spark, root, given, titles, values):
    rows = latest_per_key(frame(spark, given), DAILY_KEYS, SEQUENCE)
    weekly, total = facts.facts_of(rows.where("film_id IS NOT NULL"), titles)
    known = read(spark, root, "daily").where("film_id IS NOT NULL")
    assert values(known.drop(facts.BUCKET)) == values(rows.where("film_id IS NOT NULL").select(known.drop(facts.BUCKET).columns))
    assert values(read(spark, root, "weekly").drop(facts.BUCKET).where("film_id IS NOT NULL")) == values(weekly)
    assert values(read(spark, root, "total").drop(facts.BUCKET).where("film_id IS NOT NULL")) == values(total)


def test_batches_equal_a_full_rebuild(spark, tmp_path, titles, values):
    root, given = str(tmp_path / "facts"), []
    for number, rows in enumerate(batches()):
        given += rows
        for attempt in ("first", "repeated"):  # a batch may come again, with its staged tables or without them
            staging = str(tmp_path / f"staged-{number}") if attempt == "first" else str(tmp_path / f"again-{number}")
            facts.update_facts(spark, root, staging, frame(spark, rows), titles, BUCKETS)
        assert_rebuilt(spark, root, given, titles, values)
    moved = read(spark, root, "total").where("film_id = 3").first()
    assert moved.first_report_date == date(2024, 1, 3) and moved.opening_week_revenue == 60
    assert read(spark, root, "daily").where("film_id = 5 AND report_date = '2024-02-10' AND state_code = 'NY'").first().revenue == 7
    assert read(spark, root, "total").where("film_id = 40").first().film_title is None
    facts.update_facts(spark, root, str(tmp_path / "none"), frame(spark, []), titles, BUCKETS)


def test_untouched_films_are_neither_read_nor_written(spark, tmp_path, titles, values):
    root = tmp_path / "facts"
    first, moved, _ = batches()
    facts.update_facts(spark, str(root), str(tmp_path / "s0"), frame(spark, first), titles, BUCKETS)
    bucket = facts.bucket_of(F.col("film_id"), BUCKETS)
    touched = {r[0] for r in frame(spark, moved).select(bucket).distinct().collect()}
    spoiled = []
    for table in facts.SCHEMAS:
        for file in sorted((root / table).glob(f"{facts.BUCKET}=*/*.parquet")):
            if int(file.parent.name.split("=")[1]) not in touched:
                file.write_bytes(b"not parquet")
                Path(file.parent / f".{file.name}.crc").unlink(missing_ok=True)
                spoiled.append(file)
    assert len({f.parent for f in spoiled}) > 3 * 2
    facts.update_facts(spark, str(root), str(tmp_path / "s1"), frame(spark, moved), titles, BUCKETS)
    assert all(f.read_bytes() == b"not parquet" for f in spoiled)
    one = spark.read.schema(facts.SCHEMAS["total"]).parquet(str(root / "total")).where(F.col(facts.BUCKET).isin(sorted(touched)))
    weekly, total = facts.facts_of(latest_per_key(frame(spark, first + moved), DAILY_KEYS, SEQUENCE), titles)
    assert values(one.drop(facts.BUCKET)) == values(total.where(bucket.isin(sorted(touched))))


def test_a_batch_that_died_between_its_tables_is_completed(spark, tmp_path, titles, values, monkeypatch):
    root, staging = str(tmp_path / "facts"), str(tmp_path / "s0")
    first, moved, _ = batches()
    facts.update_facts(spark, root, str(tmp_path / "s"), frame(spark, first), titles, BUCKETS)
    write, seen = facts.write_partitions, []

    def dies(df, path, partition, mode):
        seen.append(path)
        if len(seen) == 4:  # weekly rows are staged, their replacement is lost
            raise RuntimeError("lost")
        write(df, path, partition, mode)

    monkeypatch.setattr(facts, "write_partitions", dies)
    with pytest.raises(RuntimeError):
        facts.update_facts(spark, root, staging, frame(spark, moved), titles, BUCKETS)
    monkeypatch.setattr(facts, "write_partitions", write)
    facts.update_facts(spark, root, staging, frame(spark, moved), titles, BUCKETS)
    assert_rebuilt(spark, root, first + moved, titles, values)
