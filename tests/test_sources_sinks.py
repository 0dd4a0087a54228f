import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reelweave.schemas import RAW_FILMS
from reelweave.sinks import upsert, writers
from reelweave.sources import readers

FILMS = "id INT, v INT, seq INT"


def test_ndjson_with_date_folders(spark, tmp_path, values):
    for day, title in (("2024-01-15", "A"), ("2024-01-16", "B"), ("latest", "C")):
        (tmp_path / "films" / day).mkdir(parents=True)
        (tmp_path / "films" / day / "batch_1.json").write_text(json.dumps({"title": title, "year": 2001, "other": 1}) + "\n{bad\n")
    rows = readers.read_ndjson(spark, str(tmp_path / "films"), RAW_FILMS).filter("title IS NOT NULL")
    assert values(rows.select("title", "year", F.col("ingest_date").cast("string"))) == [("A", 2001, "2024-01-15"), ("B", 2001, "2024-01-16"), ("C", 2001, None)]


def test_read_or_empty_only_forgives_a_missing_path(spark, tmp_path):
    empty = readers.read_or_empty(spark, str(tmp_path / "none"), "a INT, b DATE")
    assert empty.count() == 0 and empty.schema.simpleString() == "struct<a:int,b:date>"
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception) as error:
        readers.read_or_empty(spark, str(tmp_path / "bad"), "a INT").count()
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"


def test_external_tables_and_views(spark, tmp_path, values):
    writers.write_table(readers.genders(spark), str(tmp_path / "genders"))
    readers.register_tables(spark, str(tmp_path), ["genders", "films"])
    assert spark.table("films").count() == 0
    for _ in range(2):
        readers.create_external_tables(spark, str(tmp_path), "reel_test", ["genders"])
    assert spark.sql("SELECT count(*) AS n FROM reel_test.genders").first().n == 5


def test_lookups(spark, values):
    assert readers.roles(spark).count() == 14
    assert readers.award_categories(spark).count() == 16
    parents = readers.species_with_parent(readers.species(spark)).filter("parent_name IS NOT NULL")
    assert values(parents, "name", "parent_name") == [("blue tang", "fish"), ("clownfish", "fish")]
    plan = readers.roles(spark)._jdf.queryExecution().optimizedPlan()
    assert int(str(plan.stats().sizeInBytes())) < 10_000


def test_source_columns_and_hook(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f.json").write_text('{"title": "A"}')
    row = readers.apply_hook(readers.with_source(spark.read.schema("title STRING").json(str(tmp_path / "d"))), lambda d: d.filter("title = 'A'")).first()
    assert (row.source_file, row.source_dir) == ("f.json", "d") and row.extracted_at is not None


def test_names_of_files_are_as_on_disk(spark, tmp_path):
    (tmp_path / "my folder").mkdir()
    (tmp_path / "my folder" / "lion king+50%.json").write_text('{"films": ["A (2001)"]}')
    row = readers.read_documents(spark, str(tmp_path)).first()
    assert (row.source_file, row.source_dir) == ("lion king+50%.json", "my folder")
    row = readers.with_source(spark.read.schema("films ARRAY<STRING>").json(str(tmp_path / "my folder"))).first()
    assert (row.source_file, row.source_dir) == ("lion king+50%.json", "my folder")


def test_write_if_any_and_export(spark, tmp_path, table):
    assert not writers.write_if_any(table("a INT"), str(tmp_path / "none"))
    assert writers.write_if_any(table("a INT", (1,)), str(tmp_path / "one"))
    rows = spark.range(100).repartition(8)
    writers.export_mart(rows, str(tmp_path / "small"), files=1)
    assert len(list((tmp_path / "small").glob("*.parquet"))) == 1
    writers.export_mart(rows, str(tmp_path / "large"))
    assert len(list((tmp_path / "large").glob("*.parquet"))) == 8
    assert spark.read.parquet(str(tmp_path / "large")).count() == 100


def test_keyed_json(table):
    events = table("film_id BIGINT, report_date STRING, state_code STRING, revenue DOUBLE", (7, "2024-01-05", "CA", 1.5))
    message = writers.revenue_messages(events).first()
    assert message.key == "7-2024-01-05-CA" and json.loads(message.value)["revenue"] == 1.5


def test_upsert_update_is_idempotent_and_ordered(table, values):
    target, changes = table(FILMS, (1, 10, 5), (2, 20, 5)), table(FILMS, (1, 11, 6), (1, 12, 7), (2, 19, 4), (3, 30, 1))
    once = upsert.upsert_update(target, changes, ["id"], ["seq"])
    assert values(once) == [(1, 12, 7), (2, 20, 5), (3, 30, 1)]
    assert values(upsert.upsert_update(once, changes, ["id"], ["seq"])) == values(once)


def test_insert_absent_with_null_keys(table, values):
    target, new = table("k STRING, v INT", ("a", 1), (None, 2)), table("k STRING, v INT", ("a", 9), (None, 9), ("b", 4), ("b", 3))
    assert values(upsert.insert_absent(target, new, ["k"], ["v"])) == [("a", 1), ("b", 3), (None, 2)]


def test_upsert_coalesce(table, values):
    kind = "k INT, a STRING, b STRING"
    target, new = table(kind, (1, "x", None), (2, "y", "y")), table(kind, (1, None, "n"), (3, "z", None))
    assert values(upsert.upsert_coalesce(target, new, ["k"], ["a", "b"])) == [(1, "x", "n"), (2, "y", "y"), (3, "z", None)]


def test_upsert_columns_changes_only_those(table, values):
    kind = "k INT, o STRING, other STRING, seq INT"
    target, new = table(kind, (1, "nominated", "keep", 0), (None, "won", "keep", 0)), table(kind, (1, "won", "x", 1), (None, "nominated", "x", 1), (2, "won", "new", 1))
    assert values(upsert.upsert_columns(target, new, ["k"], ["o"], ["seq"]), "k", "o", "other") == [(1, "won", "keep"), (2, "won", "new"), (None, "nominated", "keep")]


def test_upsert_table_rewrites_touched_partitions_and_survives_a_retry(spark, tmp_path, table, values):
    schema, keys, root = "id INT, v INT, seq INT, d DATE", ["id", "d"], str(tmp_path)

    def batch(number, *rows):
        changes = table("id INT, v INT, seq INT, d STRING", *rows).withColumn("d", F.col("d").cast("date"))
        upsert.upsert_table(spark, f"{root}/t", f"{root}/staged/{number}", changes, schema, keys, ["seq"], "d")

    def stored():
        return values(spark.read.schema(schema).parquet(f"{root}/t").select("id", "v", F.col("d").cast("string")))

    batch(0, (1, 1, 1, "2024-01-01"), (2, 2, 1, "2024-01-02"))
    untouched = {p.name for p in (tmp_path / "t" / "d=2024-01-02").iterdir()}
    batch(1, (1, 5, 2, "2024-01-01"), (3, 3, 1, "2024-01-01"))
    expected = [("1", "5", "2024-01-01"), ("2", "2", "2024-01-02"), ("3", "3", "2024-01-01")]
    assert [tuple(map(str, r)) for r in stored()] == expected
    assert {p.name for p in (tmp_path / "t" / "d=2024-01-02").iterdir()} == untouched

    # the job dies while it replaces partitions: the day is gone, the staged rows are complete
    for file in (tmp_path / "t" / "d=2024-01-01").iterdir():
        file.unlink()
    batch(1, (1, 5, 2, "2024-01-01"), (3, 3, 1, "2024-01-01"))
    assert [tuple(map(str, r)) for r in stored()] == expected
