"""Rows that are numbered are computed once and dealt out by number; grams are taken in one pass."""

import pytest
from pyspark.sql import functions as F

from reelweave.operators import gram_index, keys


def test_numbered_rows_are_computed_once_and_dealt_out_by_number(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS", 100)
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("n")).mapInArrow(look, "n LONG")
    numbered = keys.dense_index(rows, [F.col("n")], "at", start=0)
    found = numbered.withColumn("part", F.spark_partition_id()).orderBy("n").collect()
    assert [r["at"] for r in found] == list(range(1000))
    assert seen.value == 1000
    assert len({r["part"] for r in found}) > 8


TEXTS = ["", "a", "ab", "abc", "aaaa", "ABCabc", "line\nbreak\r\n\t x", "straße É İ", "\U0001f600b\U0001f601c", "\U0001f600\U0001f601\U0001f602", None]


@pytest.mark.parametrize("other", [None, "xyzabc"])
def test_grams_are_those_of_a_plain_loop(spark, other):
    rows = spark.createDataFrame([(i, t, other) for i, t in enumerate(TEXTS)], "i INT, t STRING, o STRING")
    found = rows.select(F.lower("t"), F.lower("o"), gram_index.grams_of(F.col("t"), F.col("o"))).orderBy("i").collect()
    for text, second, grams in found:
        plain = [s[k : k + 3] for s in (text or "", second or "") for k in range(len(s) - 2)]
        assert grams == list(dict.fromkeys(plain))


def test_no_function_is_called_per_letter(spark):
    rows = spark.createDataFrame([("a", "b")], "t STRING, o STRING").select(gram_index.grams_of(F.col("t"), F.col("o")))
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
