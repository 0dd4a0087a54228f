"""Cross-site line removal against SQL, against plain Python, and on odd rows."""

import check_oracle
from pyspark.sql import functions as F
from reelweave.llm import line_spread

FOLDER = "/root/testdata/sf0.001"


def plain(rows, min_sites):
    sites, first = {}, {}
    for doc, text, site in sorted(rows):
        for n, line in enumerate((text or "").split("\n")):
            mark = line.strip(" ").lower()
            if mark:
                sites.setdefault(mark, set()).add(site)
                first.setdefault(mark, (doc, n))
    out = {}
    for doc, text, _ in rows:
        keep = []
        for n, line in enumerate((text or "").split("\n")):
            mark = line.strip(" ").lower()
            if not mark or len(sites[mark]) < min_sites or first[mark] == (doc, n):
                keep.append(line)
        out[doc] = None if text is None else "\n".join(keep)
    return out


def test_query_against_sql(spark):
    assert check_oracle.compare(spark, check_oracle.connect(FOLDER), FOLDER, "op8_line_spread") == ""


def test_thresholds_on_both_sides_of_the_band(spark):
    rows, n = [], 0
    for sites in (1, 2, 3, 9, 10, 11, 28, 29, 30, 31, 32, 60):
        for k in range(sites):
            rows.append((n, f"own line {n}\n  Shared by {sites} \n\nshared BY {sites}", f"site {k}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    for threshold in (1, 2, 10, 30):
        found = {r["row"].doc_id: r["row"].text for r in line_spread.remove_spread_lines(docs, threshold).collect()}
        assert found == plain(rows, threshold)


def test_odd_rows(table, values):
    rows = table(
        "doc_id BIGINT, text STRING, source STRING, line STRING, n_lines STRING",
        (1, "x\ny", "a", "l", "m"), (2, "X \n", None, "l", "m"), (3, None, "b", "l", "m"), (4, "", "c", "l", "m"), (None, "x", "d", "l", "m"),
        (5, "x\nx", "a", "l", "m"), (5, "x\nx", "a", "l", "m"),
    )
    found = line_spread.remove_spread_lines(rows, 3)
    assert values(found, "row.doc_id", "row.text", "n_lines", "n_removed") == [
        (1, "y", 2, 1), (2, "", 2, 1), (3, None, 0, 0), (4, "", 1, 0), (5, "", 2, 2), (5, "", 2, 2), (None, "x", 1, 0),
    ]
    assert found.select("row.*").columns == rows.columns
    counted = line_spread.counted_rows(line_spread.remove_spread_lines(rows.withColumn("N_Removed", F.lit("x")), 3))
    assert counted.columns == ["doc_id", "text", "source", "line", "n_lines", "n_removed"]
    assert values(counted, "n_lines", "n_removed") == sorted(values(found, "n_lines", "n_removed"))
    assert line_spread.remove_spread_lines(rows.limit(0)).count() == 0


def test_plan_is_native(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for frame in (line_spread.remove_spread_lines(docs), line_spread.line_occurrences(docs, "doc_id", "text", "source").groupBy("h1").agg(F.hll_sketch_agg("site"))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        for operator in ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop"):
            assert operator not in plan
