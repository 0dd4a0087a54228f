"""SimHash near-duplicates: fingerprints of word shingles, linked by an inverted index of positional bytes.

Method: a fingerprint is eight bytes, and two fingerprints that differ in at most four bits agree in at least four of these
positions: that is the guaranteed minimum of the count filter. The index lists fingerprints by the bytes they have at certain
positions. A list for a single positional byte would hold a 256th of everything, so that pairs drawn from it would grow with
the square of the corpus; the lists here are for choices of three positions (an argument), one fewer than the minimum. Every
pair that reaches the minimum meets in a list, in fact in several. In a list, the positional bytes that each pair shares are
tallied over all eight positions; pairs below the minimum are dropped, and the others are verified by their differing bits.

Lists never emit pairs. A task walks its lists in sorted order, many of them in one step: it gives the edges of a spanning
forest of their links, which keep the members connected. Members of long lists are dealt into blocks, and each two blocks are
compared as a list of their own. Equal fingerprints are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave.llm.bpe import map_texts
from reelweave.llm.common import connected_components
from reelweave.llm.vectors import Forest
from reelweave.session import handoff, written

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
POSITIONS = 8
BLOCK = 4096  # fingerprints of a list that are compared with as many others
ROWS = 256  # of them at a time
SHORT = 64  # lists of up to so many rows are compared together with other such lists


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """SimHash of all shingles of a text, as an unsigned integer; 0 without words.

    Words are runs of other than ASCII white space, A to Z in lower case; a text of fewer words is one shingle.
    """
    return _fingerprints([text], words)[0]


def _fingerprints(texts: list[str], words: int = SHINGLE_WORDS) -> list[int]:
    out = []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        parts = text.encode().lower().split()
        if not parts:
            out.append(0)
            continue
        line = b" ".join(parts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths + 1) - 1
        width = min(words, len(parts))
        begins = (ends - lengths)[: len(parts) - width + 1].tolist()
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(begins, ends[width - 1 :].tolist(), strict=True)], dtype="<u8")
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at : at + (1 << 14)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
        out.append(int(bits.view("<u8")[0]))
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``key, fp bigint`` (the fingerprint's 64 bits) of every row; null texts have no words."""
    field = pa.field("fp", pa.int64())

    def make(texts: list[str]) -> list:
        return [np.array(_fingerprints(texts, words), dtype=np.uint64).view(np.int64)]

    return map_texts(docs, [key], text, [field], "fp bigint", make)


def index_keys(fp: str, listed: int) -> Column:
    """The lists that a fingerprint belongs to: each choice of ``listed`` positions, with the bytes it has there."""
    lists = []
    for choice, positions in enumerate(combinations(range(POSITIONS), listed)):
        mask = sum(0xFF << (8 * p) for p in positions)
        mask = mask - (1 << 64) if mask >> 63 else mask
        lists.append(F.struct(F.lit(choice).cast("short").alias("choice"), F.col(fp).bitwiseAND(F.lit(mask)).alias("bytes")))
    return F.explode(F.array(*lists))


def near_pairs(first: np.ndarray, second: np.ndarray, minimum: int, max_bits: int) -> np.ndarray:
    """Which pairs of fingerprints (arrays of one shape after broadcasting) link: the tally of shared positional bytes
    rejects those below the minimum, the differing bits decide the others."""
    differ = np.bitwise_xor(first, second)
    shared = np.zeros(differ.shape, np.uint8)
    for p in range(POSITIONS):
        shared += (differ >> np.uint64(8 * p)) & np.uint64(0xFF) == 0
    near = shared >= minimum
    near[near] = np.bitwise_count(differ[near]) <= max_bits
    return near


def _list_links(rows: pd.DataFrame, begins: np.ndarray, minimum: int, max_bits: int) -> pd.DataFrame:
    """Links of a spanning forest of whole lists, which begin at the given rows."""
    prints, side = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["side"].to_numpy()
    within = (rows["low"] == rows["high"]).to_numpy()
    nodes, node = np.unique(prints, return_inverse=True)
    forest = Forest(len(nodes))
    lengths = np.diff(np.append(begins, len(prints)))
    short = np.nonzero(np.repeat(lengths <= SHORT, lengths))[0]
    number = np.repeat(np.arange(len(lengths)), lengths)[short]
    for apart in range(1, min(SHORT, len(short))):
        i = np.nonzero(number[:-apart] == number[apart:])[0]
        if not len(i):
            break
        i, j = short[i], short[i + apart]
        meet = within[i] | (side[i] != side[j])
        i, j = i[meet], j[meet]
        near = near_pairs(prints[i], prints[j], minimum, max_bits)
        forest.add(node[i[near]], node[j[near]])
    for begin, length in zip(begins[lengths > SHORT], lengths[lengths > SHORT], strict=True):
        at = np.arange(begin, begin + length)
        left = at[side[at] == 0]
        right = left if within[begin] else at[side[at] == 1]
        for k in range(0, len(left), ROWS):
            part = left[k : k + ROWS]
            i, j = np.nonzero(near_pairs(prints[part][:, None], prints[right][None, :], minimum, max_bits))
            forest.add(node[part[i]], node[right[j]])
    i, j = forest.edges()
    return pd.DataFrame({"a": nodes[i].view(np.int64), "b": nodes[j].view(np.int64)})


def _compare(minimum: int, max_bits: int):
    keys = ["choice", "bytes", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the list that the batch before ended in
        for rows in batches:
            if rest is not None:
                rows = pd.concat([rest, rows], ignore_index=True)
            if not len(rows):
                continue
            values = rows[keys].to_numpy(np.int64)
            begins = np.append(0, np.nonzero((values[1:] != values[:-1]).any(axis=1))[0] + 1)
            rest = rows.iloc[begins[-1] :]
            if len(begins) > 1:
                yield _list_links(rows.iloc[: begins[-1]], begins[:-1], minimum, max_bits)
        if rest is not None:
            yield _list_links(rest, np.zeros(1, int), minimum, max_bits)

    return run


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, listed: int | None = None) -> DataFrame:
    """``a, b``: links between different fingerprints (column ``fp``, distinct) that connect all that differ in at most
    ``max_bits`` bits, directly or in steps. Lists with one member are dropped before anything is compared.

    ``listed`` positions make a list, by default one fewer than the minimum that near fingerprints share (and at least one). With
    as many as the minimum itself lists are shorter, but more, which pays beyond some hundred million fingerprints.
    """
    minimum = POSITIONS - max_bits
    if minimum < 1:
        raise ValueError("fingerprints must share a positional byte, so that at most 7 bits may differ")
    listed = max(1, minimum - 1) if listed is None else listed
    if not 1 <= listed <= minimum:
        raise ValueError("lists of more positions than the minimum would lose links")
    lists = prints.select("fp", index_keys("fp", listed).alias("list")).select("fp", "list.choice", "list.bytes")
    sizes = handoff(lists.groupBy("choice", "bytes").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    # of both sides the planner knows the size of the fingerprints before they were laid out by list, many times too small: it
    # would broadcast them through the driver, so the join is told to sort
    members = lists.hint("merge").join(sizes, ["choice", "bytes"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    members = members.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # the left side with every block from its own on, the right side with every block before its own
    left = F.transform(F.sequence("mine", F.col("blocks") - 1), lambda o: F.struct(F.col("mine").alias("low"), o.alias("high"), F.lit(0).alias("side")))
    right = F.transform(F.sequence(F.lit(0), F.col("mine")), lambda o: F.struct(o.alias("low"), F.col("mine").alias("high"), F.lit(1).alias("side")))
    cells = F.concat(left, F.filter(right, lambda x: x["low"] < x["high"]))
    placed = members.select("fp", "choice", "bytes", F.explode(cells).alias("at"))
    placed = placed.select("fp", "choice", "bytes", "at.*")
    width = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["choice", "bytes", "low", "high"]
    placed = placed.repartition(width, *keys).sortWithinPartitions(*keys)  # a number, so that AQE does not merge small bytes of costly work
    return placed.mapInPandas(_compare(minimum, max_bits), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``key, fp, component_id`` of every row; the component is the smallest key reachable over links.

    Rows with equal fingerprints are linked, texts without words (null, empty, blank) among them, whose fingerprint is 0.
    Repeated rows come back as often as they came. A null key is never the smallest one unless a component has no other;
    then the component is null. Further columns are dropped.
    """
    # written plainly: packed, the files of texts that often repeat look small enough to be broadcast
    prints = written(fingerprints(docs, key, text, words))
    smallest = written(prints.groupBy("fp").agg(F.min(key).alias("smallest")))
    links = fingerprint_links(smallest.select("fp"), max_bits)
    groups = connected_components(links)
    named = smallest.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "smallest", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = written(named.join(handoff(least), "component").select(F.col("fp").alias("_fp"), "component_id"))
    return prints.join(named, F.col("fp") == F.col("_fp")).select(key, "fp", "component_id")


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
