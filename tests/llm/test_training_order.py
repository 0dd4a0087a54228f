"""Training-order shards: permutation, round trip, resuming."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from reelweave.llm import training_order as to
from reelweave.llm.queries import QUERIES, vocabulary
from reelweave.session import fresh_folder

PATH = vocabulary("byte_bpe_multi_50k.tiktoken")
END = 50256


def test_permutation_is_keyed_and_stays_in_its_domain():
    for domain in (1, 2, 3, 7, 1000, 12_345):
        for key in (0, 5):
            assert sorted(to.permute(np.arange(domain), domain, key).tolist()) == list(range(domain))
    assert to.permute(np.arange(1000), 1000, 1).tolist() != to.permute(np.arange(1000), 1000, 2).tolist()
    big = to.permute(np.arange(1 << 62, (1 << 62) + 100), (1 << 62) + 100, 3)
    assert len(set(big.tolist())) == 100 and int(big.max()) < (1 << 62) + 100


def sequences(texts, size):
    coder = to.rank_encoder(PATH)
    out = {}
    for i, t in texts:
        ids = coder.encode_ordinary(t or "") + [END]
        for k in range(0, len(ids), size):
            out.setdefault((i, k // size), []).append(ids[k : k + size])
    return out


def rows_of(df):
    return [(r.slot, r.doc_id, r.place, np.frombuffer(r.ids, "<u2")[: r.n_tokens].tolist()) for r in df.orderBy("slot").collect()]


def test_round_trip_and_resuming(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = fresh_folder(spark, "shards")
    to.write_shards(docs, path, PATH, sequence_tokens=64, shard_rows=100)
    rows = rows_of(to.read_slots(spark, path, sequence_tokens=64))
    want = sequences([(r.doc_id, r.text) for r in docs.collect()], 64)
    assert [r[0] for r in rows] == list(range(len(want)))
    assert {(d, p): [ids] for _, d, p, ids in rows} == want
    assert to.manifest(spark, path, 64).count() > 5
    assert rows_of(to.read_slots(spark, path, 333, 777, 64)) == rows[333:777]
    assert rows_of(to.read_slots(spark, path, len(want) - 3, None, 64)) == rows[-3:]
    assert to.read_slots(spark, path, 10**9, None, 64).count() == 0
    again, other = fresh_folder(spark, "shards"), fresh_folder(spark, "shards")
    to.write_shards(docs.repartition(5), again, PATH, sequence_tokens=64, shard_rows=100)
    assert rows_of(to.read_slots(spark, again, sequence_tokens=64)) == rows
    to.write_shards(docs, other, PATH, key=43, sequence_tokens=64, shard_rows=100)
    assert [r[1:3] for r in rows_of(to.read_slots(spark, other, sequence_tokens=64))] != [r[1:3] for r in rows]
    places = np.array([r[1] for r in rows], dtype=float)
    assert abs(np.corrcoef(places, np.arange(len(places)))[0, 1]) < 0.1


def test_shards_have_a_fixed_stride(spark):
    path = fresh_folder(spark, "shards")
    to.write_shards(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), path, PATH, shard_rows=50)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    assert files.where(F.col("length") % to.record_type(256).itemsize != 0).count() == 0
    assert files.groupBy("shard").count().where("count > 1").count() == 0


def test_odd_rows(spark, table):
    texts = [(5, None), (5, "a b"), (5, "a b"), (None, ""), (-7, "minus"), (2**62, "large"), (6, " " * 300_000), (7, "w" * 30_000), (8, "z " * 250_000)]
    rows = table("doc_id BIGINT, text STRING, shard STRING", *[(i, t, "x") for i, t in texts])
    path = fresh_folder(spark, "shards")
    to.write_shards(rows, path, PATH)
    found = {}
    for _, d, p, ids in rows_of(to.read_slots(spark, path)):
        found.setdefault((d, p), []).append(ids)
    want = sequences(texts, 256)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    empty = fresh_folder(spark, "shards")
    to.write_shards(rows.limit(0), empty, PATH)
    assert to.manifest(spark, empty).count() == 0 and to.checked(to.read_slots(spark, empty)).count() == 0
    assert to.read_slots(spark, empty).columns == ["slot", "doc_id", "place", "n_tokens", "ids"]


def test_null_and_repeated_ids_are_spread_over_the_shards(spark):
    for doc_id in (None, 7):
        rows = spark.range(3000).select(F.lit(doc_id).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
        path = fresh_folder(spark, "shards")
        to.write_shards(rows, path, PATH, shard_rows=200)
        sizes = [r.rows for r in to.manifest(spark, path).collect()]
        assert sum(sizes) == 3000 and len(sizes) > 5 and max(sizes) < 600


def test_slots_are_the_ranks_of_the_permuted_numbers(spark):
    texts = [(k, f"some text {k} " * (k % 40)) for k in range(80)]
    rows = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    path = fresh_folder(spark, "shards")
    to.write_shards(rows, path, PATH, sequence_tokens=16, shard_rows=50)
    hashes = {r.doc_id: r.h for r in rows.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    made = sequences(texts, 16)
    numbers = {(d, p): ((hashes[d] % (1 << 64)) >> (64 - to.ID_BITS)) << to.PLACE_BITS | p for d, p in made}
    permuted = to.permute(np.array(list(numbers.values()), dtype=np.uint64), 1 << (to.ID_BITS + to.PLACE_BITS), 42)
    order = [k for _, k in sorted(zip(permuted.tolist(), numbers, strict=True))]
    found = to.read_slots(spark, path, sequence_tokens=16)
    assert [r[1:3] for r in rows_of(found)] == order
    crc = {(r.doc_id, r.place): r.ids_crc32 for r in to.checked(found).collect()}
    padded = {k: np.array([*v[0], *[END] * (16 - len(v[0]))], "<u2").tobytes() for k, v in made.items()}
    assert crc == {k: zlib.crc32(v) for k, v in padded.items()}


def test_wide_vocabularies_are_refused(spark, table):
    with pytest.raises(Exception, match="16 bits"):
        to.write_shards(table("doc_id BIGINT, text STRING", (1, "a")), fresh_folder(spark, "shards"), PATH, end_id=70_000)


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op10_training_order"](spark, folder).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert {(r.doc_id, r.place): r.n_tokens for r in found} == {k: len(v[0]) for k, v in sequences(docs, 256).items()}
    assert sorted(r.slot for r in found) == list(range(len(found)))
