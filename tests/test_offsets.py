"""The ledger of landed offsets against plain sets."""

import random

import pytest
from pyspark.sql import functions as F
from reelweave.operators import offsets

MESSAGE = "_kafka_topic STRING, _kafka_partition INT, _kafka_offset BIGINT, value STRING"


def plain(messages):
    """Ranges, gaps and contiguous ends by partition."""
    ranges, gaps, ends = [], [], {}
    for key in {m[:2] for m in messages}:
        landed = [m[2] for m in messages if m[:2] == key and m[2] is not None]
        runs = []
        for at in sorted(set(landed)):
            if runs and runs[-1][1] == at - 1:
                runs[-1][1] = at
            else:
                runs.append([at, at])
        ranges += [(*key, a, b, sum(a <= x <= b for x in landed)) for a, b in runs]
        gaps += [(*key, x[1] + 1, y[0] - 1) for x, y in zip(runs, runs[1:], strict=False)]
        if runs:
            ends[key] = (runs[0][1] + 1, runs[-1][1], len(landed), len(landed) - len(set(landed)))
    return ranges, gaps, [(*k, *v) for k, v in ends.items()]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])


@pytest.fixture(scope="module")
def messages():
    rng = random.Random(3)
    rows = [("a", 0, k, "x") for k in range(400) if k % 37 and not 130 <= k < 210]
    rows += [("a", 1, rng.randrange(300), "x") for _ in range(250)] + [("b", 0, 7, "x")] * 3
    rows += [(None, None, 5, "x"), (None, None, 6, "x"), ("b", 1, None, "x"), ("a", 2, -3, "x"), ("a", 2, -2, None), ("a", 2, 0, "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [1, 16, offsets.SLICE])
def test_batches_merge_to_what_has_landed(spark, messages, tmp_path, size):
    for batch, rows in enumerate((messages[:300], messages[300:], messages[:0])):
        for _ in range(2):  # a repeated batch replaces its own ranges
            offsets.write_batch(spark.createDataFrame(rows, MESSAGE), str(tmp_path), batch, size)
    ledger = offsets.read_ledger(spark, str(tmp_path), size)
    ranges, gaps, ends = plain(messages)
    assert ordered(ledger.collect()) == ordered(ranges)
    assert ordered(offsets.missing_ranges(ledger, size).collect()) == ordered(gaps)
    assert ordered(offsets.commit_points(ledger).collect()) == ordered(ends)


def test_commit_points_move_over_whole_ranges_only(table, values):
    ledger = table(offsets.RANGES, ("a", 0, 0, 9, 10), ("a", 0, 20, 29, 12), ("a", 1, 5, 6, 2), ("a", 2, 5, 6, 2), (None, 0, 1, 4, 4))
    committed = table("topic STRING, partition INT, offset BIGINT", ("a", 0, 20), ("a", 0, 3), ("a", 1, 3), (None, 0, 5), ("c", 0, 1))
    found = offsets.commit_points(ledger, committed).select("topic", "partition", "next_offset", "repeats")
    assert ordered(found.collect()) == ordered([("a", 0, 30, 2), ("a", 1, 3, 0), ("a", 2, 7, 0), (None, 0, 5, 0)])


def test_no_rows_and_bad_ranges(table):
    odd = table(offsets.RANGES, ("a", 0, 9, 3, 1), ("a", 0, None, 3, 1), ("a", 0, 3, None, 1))
    assert offsets.merge_ranges(odd).count() == 0
    assert offsets.missing_ranges(odd.limit(0)).count() == 0 and offsets.commit_points(odd.limit(0)).count() == 0


def test_a_hot_partition_is_merged_in_slices(spark):
    """One partition with all offsets: no group before the merge of edges holds more than a slice."""
    rows = spark.range(100_000).select(F.lit("a").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("first"),
                                       F.col("id").alias("last"), F.lit(1).cast("bigint").alias("records")).where("id % 1000 <> 999")
    merged = offsets.merge_ranges(rows, 4096)
    assert merged.count() == 100 and merged.agg(F.sum("records")).first()[0] == 99_900
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan.split("Window")[-1]


def test_stream_keeps_the_ledger(spark, messages, tmp_path):
    source = str(tmp_path / "in")
    for part in (messages[:200], messages[200:]):
        spark.createDataFrame(part, MESSAGE).coalesce(1).write.mode("append").json(source)
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).json(source)
    offsets.track_offsets(stream, str(tmp_path / "ledger"), str(tmp_path / "work")).awaitTermination()
    assert len(list((tmp_path / "ledger").glob("batch=*"))) == 2
    assert ordered(offsets.read_ledger(spark, str(tmp_path / "ledger")).collect()) == ordered(plain(messages)[0])
