from types import SimpleNamespace

import pytest

from reelweave import session


def fake(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=SimpleNamespace(master=master))


def test_the_folder_the_cluster_names_is_used(spark):
    assert session.shared_folder(fake("spark://host:7077", "hdfs://shared/ck")) == "hdfs://shared/ck"
    assert session.fresh_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")


def test_a_local_folder_only_on_a_local_master():
    assert session.shared_folder(fake("local[2]"))
    with pytest.raises(RuntimeError):
        session.shared_folder(fake("spark://host:7077"))


def test_handoff_cuts_the_lineage(spark):
    rows = spark.range(10).selectExpr("id % 3 AS k").groupBy("k").count()
    cut = session.handoff(rows)
    assert "Aggregate" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, cut.collect())) == [(0, 4), (1, 3), (2, 3)]


def test_a_written_table_is_as_large_as_its_files(spark, tmp_path):
    """Rows that a flattening made of few bytes must not look as small as these bytes: they would be broadcast."""
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/few")
    rows = spark.read.parquet(f"{tmp_path}/few").selectExpr("explode(sequence(0, 20000)) AS n").selectExpr("xxhash64(n) AS h")
    size = lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size(rows) < 10_000
    table = session.written(rows)
    assert size(table) > 100_000 and table.count() == 200_010
