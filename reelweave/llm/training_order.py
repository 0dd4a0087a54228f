"""Token ids in training order, as fixed-stride binary shards.

Method: a document's tokens and an end mark are cut into sequences. Every sequence has a number, a hash of its document's id
and text and its place in it, and a keyed Feistel network with cycle-walking permutes the domain of these numbers, so that order needs no
count of sequences and no numbering pass. Equal ranges of the permuted domain are the shards; a sequence's global slot is the
number of sequences permuted before it: the rows of the shards before its own, and its place in its shard. A record has a
fixed size, so a slot is found by multiplication, and a reader resumes at any slot with the shards from there on.

Shards are written by Spark's text writer, whose commit protocol drops the files of lost tasks: the line separator is the
end mark of a record, and so a part of the stride.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.llm.bpe import text_slices
from reelweave.llm.common import stored

SEQUENCE_TOKENS = 256
SHARD_ROWS = 32_768
PLACE_BITS = 20  # room for the place of a sequence in its document
ID_BITS = 43
ROUNDS = 4
END_MARK = "EOR\n"
NO_ID = -(1 << 63)  # stands for a null document id


def record_type(sequence_tokens: int) -> np.dtype:
    """A record: document, place in it, number of tokens that count, ids (padded with the end mark's id), end mark."""
    return np.dtype(
        [("doc_id", "<i8"), ("place", "<u4"), ("n_tokens", "<u4"), ("ids", "<u2", (sequence_tokens,)), ("mark", f"S{len(END_MARK)}")]
    )


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    x = values + np.uint64(key & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, domain: int, key: int) -> np.ndarray:
    """The keyed permutation of 0 … domain - 1: a balanced Feistel network over the next even number of bits, walked along
    its cycle until it comes back into the domain."""
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.asarray(numbers, dtype=np.uint64).copy()
    outside = np.ones(len(out), bool)
    while outside.any():
        x = out[outside]
        left, right = x >> shift, x & mask
        with np.errstate(over="ignore"):
            for turn in range(ROUNDS):
                left, right = right, left ^ (_mixed(right, key * 0x9E3779B97F4A7C15 + turn) & mask)
        out[outside] = left << shift | right
        outside = out >= np.uint64(domain)
    return out


_LOADED: dict[str, object] = {}


def rank_encoder(path: str):
    """The byte-pair encoder of a file of ranks, one per Python worker."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def _pieces(text: str, most: int = 200_000) -> Iterator[str]:
    """A long text in parts that end before a space between two other characters, where its words are independent."""
    while len(text) > most:
        cut = next((k for k in range(most, 0, -1) if text[k] == " " and not text[k - 1].isspace() and not text[k + 1 : k + 2].isspace()), 0)
        if not cut:
            break
        yield text[:cut]
        text = text[cut:]
    yield text


def numbers_of(documents: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of a sequence: bits of its document's hash, then its place; places beyond their bits are folded into them.
    Sequences that share a number are ordered by their records."""
    folded = documents.view(np.uint64) >> np.uint64(64 - ID_BITS)
    return (folded << np.uint64(PLACE_BITS)) | (places.astype(np.uint64) & np.uint64((1 << PLACE_BITS) - 1))


def write_shards(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 50256, key: int = 42, doc_id: str = "doc_id", text: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS, shard_rows: int = SHARD_ROWS,
) -> None:
    """Writes the tokens of all whole texts as shards below a new folder; other columns are ignored.

    Texts are encoded by a file of byte-pair ranks; every document ends with ``end_id``, which also pads its last sequence.
    A null or empty text is a sequence of the end mark alone. A null id is stored as the smallest integer. Rows that share an
    id, null ones too, have numbers of their own unless their texts are equal as well; such copies are equal records, which lie
    side by side in one shard. The number of shards follows from the bytes of all texts (about 0.42 tokens a byte), shards have
    about ``shard_rows`` records. The order depends on ids, texts and key alone. Ids of the vocabulary must fit into 16 bits.
    A table without rows gives a folder without shards.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("hash"))
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    domain = 1 << (ID_BITS + PLACE_BITS)
    sequences = size[1] / 2 + (size[0] or 0) * 0.42 / sequence_tokens
    shards = max(1, round(sequences / shard_rows))
    width = -(-domain // shards)
    layout = record_type(sequence_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rank_encoder(vocabulary)
        for batch in batches:
            for rows_, texts in text_slices(batch, 1):
                parts = []
                names = [NO_ID if i is None else i for i in rows_.column(0).to_pylist()]
                counts = []
                for name, whole in zip(names, texts, strict=True):
                    tokens = [coder.encode_to_numpy(p, disallowed_special=()) for p in _pieces(whole) if p]
                    tokens = np.concatenate([*tokens, [end_id]])
                    if tokens.max() >> 16:
                        raise ValueError("an id of the vocabulary does not fit into 16 bits")
                    tokens = tokens.astype("<u2")
                    count = -(-len(tokens) // sequence_tokens)
                    made = np.zeros(count, layout)
                    padded = np.full(count * sequence_tokens, end_id, "<u2")
                    padded[: len(tokens)] = tokens
                    made["doc_id"], made["place"], made["ids"] = name, np.arange(count), padded.reshape(count, -1)
                    made["n_tokens"] = sequence_tokens
                    made["n_tokens"][-1] = len(tokens) - (count - 1) * sequence_tokens
                    made["mark"] = END_MARK.encode()
                    parts.append(made)
                    counts.append(count)
                made = np.concatenate(parts)
                hashed = np.repeat(rows_.column(2).to_numpy(zero_copy_only=False), counts)
                at = permute(numbers_of(hashed, made["place"]), domain, key)
                stride, kept = layout.itemsize, layout.itemsize - len(END_MARK)
                raw = made.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((at // np.uint64(width)).astype(np.int64)), pa.array(at.astype(np.int64)),
                        pa.array([raw[k : k + kept] for k in range(0, len(raw), stride)], pa.binary()),
                    ],
                    names=["shard", "at", "record"],
                )

    placed = rows.mapInArrow(run, "shard bigint, at bigint, record binary")
    placed = placed.repartition(F.col("shard")).sortWithinPartitions("shard", "at", "record")
    lines = placed.select("shard", F.col("record").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("lineSep", END_MARK).text(path)


def _shard_files(spark: SparkSession, path: str) -> DataFrame:
    """``shard, length, content`` of the files of a folder; the folder of an empty table has no shards."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if "shard" not in files.columns:
        files = files.limit(0).withColumn("shard", F.lit(None))
    return files.select(F.col("shard").cast("bigint").alias("shard"), "length", "content")


def manifest(spark: SparkSession, path: str, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """``shard, rows, first_slot`` of every shard, from the lengths of the files alone; no rows without shards."""
    stride = record_type(sequence_tokens).itemsize
    sizes = _shard_files(spark, path).groupBy("shard").agg((F.sum("length") / stride).cast("bigint").alias("rows"))
    before = F.sum("rows").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    return sizes.withColumn("first_slot", F.coalesce(before, F.lit(0)))


def read_slots(
    spark: SparkSession, path: str, start: int = 0, stop: int | None = None, sequence_tokens: int = SEQUENCE_TOKENS
) -> DataFrame:
    """``slot, doc_id, place, n_tokens, ids`` of the sequences at slots start to stop (without stop).

    Only shards that hold such slots are read. A shard is one file, written by the task that held the shard. Slots beyond the
    last one, and a folder without shards, give no rows; an id that was null is null again.
    """
    layout = record_type(sequence_tokens)
    shards = stored(manifest(spark, path, sequence_tokens), "manifest")
    wanted = shards.where(F.col("first_slot") + F.col("rows") > start)
    if stop is not None:
        wanted = wanted.where(F.col("first_slot") < stop)
    first, last = wanted.agg(F.min("shard"), F.max("shard")).first()
    files = _shard_files(spark, path).select("shard", "content")
    files = files.where(F.col("shard").between(first, last) if first is not None else F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = batch.column(0)[k].as_py()
                records = np.frombuffer(batch.column(1)[k].as_py(), layout)
                if (records["mark"] != END_MARK.encode()).any():
                    raise ValueError("a record does not end with its mark")
                for at in range(0, len(records), 5000):
                    part = records[at : at + 5000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), shard)), pa.array(np.arange(at, at + len(part))),
                            pa.array(part["doc_id"], mask=part["doc_id"] == NO_ID), pa.array(part["place"].astype(np.int32)),
                            pa.array(part["n_tokens"].astype(np.int32)), pa.array([x.tobytes() for x in part["ids"]], pa.binary()),
                        ],
                        names=["shard", "slot", "doc_id", "place", "n_tokens", "ids"],
                    )

    found = files.mapInArrow(run, "shard bigint, slot bigint, doc_id bigint, place int, n_tokens int, ids binary")
    found = found.join(shards.select("shard", "first_slot"), "shard").withColumn("slot", F.col("first_slot") + F.col("slot"))
    found = found.where(F.col("slot") >= start)
    if stop is not None:
        found = found.where(F.col("slot") < stop)
    return found.select("slot", "doc_id", "place", "n_tokens", "ids")


def checked(sequences: DataFrame) -> DataFrame:
    """The sequences with the CRC-32 of their ids in place of the ids."""
    return sequences.withColumn("ids_crc32", F.crc32("ids")).drop("ids")

