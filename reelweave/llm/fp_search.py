"""Ranked search of all documents for a set of items, over frequency-ordered prefix trees of restricted term vectors.

Method: only terms of the items can score, so a document is the vector of its counts of those terms. With the terms in order of
falling document frequency, vectors are paths, and a tree over them (a document FP-tree) shares their beginnings. Every node
keeps, over the documents below it, the largest count of each term and the smallest length measure m. As a term's part of a score grows
with its count and falls with m, the score of these extremes bounds all scores below the node. An item's search goes depth first,
best child first, and leaves out every node whose bound is below the tenth score found so far; only the documents of the leaves
that remain are scored. Bounds and scores are the same integer arithmetic, so nothing is lost.

Documents are tokenised once per block of items, in a pass without a shuffle that writes the vectors. The corpus counts are taken
from these. Then each task builds trees of a bounded number of documents and carries the best documents of every item from
tree to tree; ten rows per item and task are ranked by a window whose limit applies before its shuffle.

The items are a stated set of queries. They are worked off in blocks of ``BLOCK_ITEMS``, whose terms travel with the tasks.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from reelweave.llm.bpe import map_texts
from reelweave.llm.common import stored

BEST = 10
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 18  # items and different terms of a block; one item may have more terms
TREE_DOCUMENTS, TREE_ENTRIES = 16_384, 1 << 20
LEAF = 32  # documents that are scored at once
PART = 1 << 20  # bytes of a text that are cut into terms at a time
#: ASCII letters (in lower case) and digits, and all bytes of other characters, belong to terms; the rest is white space.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def parts_of_terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text with repeats, a part of the text at a time."""
    data = (text or "").encode().translate(TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def restricted(text: str, numbers: dict[bytes, int]) -> tuple[int, list[int], list[int]]:
    """Number of all terms of a text with repeats, and the numbers and counts of those that ``numbers`` has."""
    n, counts = 0, Counter()
    for terms in parts_of_terms(text):
        n += len(terms)
        counts.update(filter(numbers.__contains__, terms))
    return n, [numbers[t] for t in counts], list(counts.values())


def term_vectors(docs: DataFrame, numbers: dict[bytes, int], key: str, text: str) -> DataFrame:
    """``key, n, terms, counts`` of every row: the number of its terms, and its restricted vector."""
    ints = pa.list_(pa.int32())
    fields = [pa.field("n", pa.int64()), pa.field("terms", ints), pa.field("counts", ints)]
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return map_texts(
        rows, ["key"], "text", fields, "n bigint, terms array<int>, counts array<int>",
        lambda texts: list(zip(*[restricted(t, numbers) for t in texts], strict=True)),
    )


def part_of_score(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for each unit of its weight; 0 for a count of 0."""
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _largest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, each with the largest of its values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    heads = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    return keys[heads], np.maximum.reduceat(values, heads)


class DocumentTree:
    """A tree over documents given by their lengths, term ranks (0: in most documents), counts and m.

    A node stands for a run of the documents in path order. Its children are the runs with one next term; neighbouring runs
    and documents that end at the node are put together to leaves of up to ``LEAF`` documents, and nodes with a single child are skipped.
    """

    def __init__(self, sizes: np.ndarray, ranks: np.ndarray, counts: np.ndarray, m: np.ndarray, terms: int, leaf: int = LEAF):
        self.terms = max(1, terms)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inner = np.lexsort((ranks, owner))
        ranks, counts = ranks[inner].astype(np.int64), counts[inner].astype(np.int64)
        ends = np.cumsum(sizes)
        raw = ranks.astype(">u4").tobytes()
        paths = [raw[4 * a : 4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        self.order = np.array(sorted(range(len(sizes)), key=paths.__getitem__), dtype=np.int64)
        place = np.empty(len(sizes), np.int64)
        place[self.order] = np.arange(len(sizes))
        moved = np.argsort(place[owner], kind="stable")
        self.sizes, self.m = sizes[self.order], m[self.order]
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.ranks = ranks[moved]
        self.entry_keys = place[owner][moved] * self.terms + self.ranks
        self.entry_counts = counts[moved]
        self._grow(leaf)
        self._measure()

    def _grow(self, leaf: int) -> None:
        spans, depths = [(0, len(self.sizes))], [0]
        self.children: list[tuple[int, int]] = []
        self.parent, self.level = [-1], [0]
        at = 0
        while at < len(spans):
            (low, high), depth = spans[at], depths[at]
            pieces: list[tuple[int, int]] = []
            while high - low > leaf:
                ended = low + int(np.searchsorted(self.sizes[low:high] > depth, True))
                labels = self.ranks[self.begins[ended:high] + depth] if ended < high else np.zeros(0, np.int64)
                cuts = [*(ended + np.nonzero(labels[1:] != labels[:-1])[0] + 1).tolist()]
                if ended == low and not cuts:  # one next term for all
                    depth += 1
                    continue
                runs = [(k, min(k + leaf, ended)) for k in range(low, ended, leaf)]
                runs += list(zip([ended, *cuts], [*cuts, high], strict=True)) if ended < high else []
                for a, b in runs:
                    if pieces and b - pieces[-1][0] <= leaf:
                        pieces[-1] = (pieces[-1][0], b)
                    else:
                        pieces.append((a, b))
                break
            self.children.append((len(spans), len(spans) + len(pieces)))
            spans += pieces
            depths += [depth] * len(pieces)
            self.parent += [at] * len(pieces)
            self.level += [self.level[at] + 1] * len(pieces)
            at += 1
        self.spans = spans

    def _measure(self) -> None:
        """The largest counts and the smallest m of every node, from the leaves up."""
        parent, level = np.array(self.parent), np.array(self.level)
        self.least = np.array([self.m[a:b].min() if b > a else 0 for a, b in self.spans], dtype=np.int64)
        leaf_of = np.zeros(len(self.sizes), np.int64)
        for node, ((a, b), (first, last)) in enumerate(zip(self.spans, self.children, strict=True)):
            if first == last:
                leaf_of[a:b] = node
        node_of = np.repeat(leaf_of, self.sizes)
        keys, counts = _largest(node_of * self.terms + self.ranks, self.entry_counts)
        levels = level[keys // self.terms]
        done, upper = [], (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for k in range(int(level.max()), -1, -1):
            here = levels == k
            both = _largest(np.concatenate([keys[here], upper[0]]), np.concatenate([counts[here], upper[1]]))
            done.append(both)
            nodes = both[0] // self.terms
            upper = (parent[nodes] * self.terms + both[0] % self.terms, both[1])
        keys, counts = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(keys)
        self.node_keys, self.node_counts = keys[order], counts[order]

    def _scores(self, keys: np.ndarray, counts: np.ndarray, things: np.ndarray, m: np.ndarray, ranks: np.ndarray, weights: np.ndarray):
        wanted = things[:, None] * self.terms + ranks
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = np.where(keys[at] == wanted, counts[at], 0)
        return (weights * part_of_score(found, m[:, None])).sum(axis=1)

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Offers ``best`` every document that may belong to it; the number of documents that were scored."""
        if not len(self.node_keys) or not len(ranks):
            return 0
        scored = 0
        stack = [(0, 0)]
        while stack:
            bound, node = stack.pop()
            if node and bound < best.least:
                continue
            first, last = self.children[node]
            if first == last:
                documents = np.arange(*self.spans[node])
                scores = self._scores(self.entry_keys, self.entry_counts, documents, self.m[documents], ranks, weights)
                scored += len(documents)
                for k in np.nonzero(scores >= best.least)[0].tolist():
                    best.offer(int(scores[k]), int(self.order[documents[k]]))
            else:
                nodes = np.arange(first, last)
                bounds = self._scores(self.node_keys, self.node_counts, nodes, self.least[nodes], ranks, weights)
                near = np.nonzero(bounds >= best.least)[0]
                near = near[np.argsort(bounds[near], kind="stable")]
                stack += zip(bounds[near].tolist(), nodes[near].tolist(), strict=True)
        return scored


class _Worse:
    """Orders a document behind those it loses against: lower scores, then larger keys, null ones last."""

    __slots__ = ("score", "key")

    def __init__(self, score: int, key):
        self.score, self.key = score, key

    def __lt__(self, other: _Worse) -> bool:
        if self.score != other.score:
            return self.score < other.score
        if self.key is None or other.key is None:
            return self.key is None and other.key is not None
        return self.key > other.key


class Best:
    """The documents of highest score for one item, over all trees of a task."""

    def __init__(self, most: int):
        self.most, self.heap, self.keys = most, [], []
        self.least = 1  # lower scores cannot enter

    def offer(self, score: int, place: int) -> None:
        if score < self.least:
            return
        found = _Worse(score, self.keys[place])
        if len(self.heap) < self.most:
            heapq.heappush(self.heap, found)
        elif self.heap[0] < found:
            heapq.heapreplace(self.heap, found)
        if len(self.heap) == self.most:
            self.least = self.heap[0].score


def weight_of(documents: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


def _trees(batches: Iterator[pa.RecordBatch], rank_of: np.ndarray, documents: int, length: int) -> Iterator[tuple[list, DocumentTree]]:
    """Trees of the vectors that come in, each with the keys of its documents."""
    keys: list = []
    held: list[list[np.ndarray]] = [[], [], [], []]

    def tree() -> tuple[list, DocumentTree]:
        sizes, terms, counts, n = (np.concatenate(x) for x in held)
        m = 10 + (90 * n * documents) // length
        made = keys.copy(), DocumentTree(sizes, rank_of[terms], counts, m, len(rank_of))
        keys.clear()
        for x in held:
            x.clear()
        return made

    for batch in batches:
        step = max(1, min(batch.num_rows, TREE_DOCUMENTS // 16))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            terms = part.column(2)
            keys += part.column(0).to_pylist()
            held[0].append(terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            held[1].append(terms.flatten().to_numpy(zero_copy_only=False))
            held[2].append(part.column(3).flatten().to_numpy(zero_copy_only=False))
            held[3].append(part.column(1).to_numpy(zero_copy_only=False))
            if len(keys) >= TREE_DOCUMENTS or sum(map(len, held[1])) >= TREE_ENTRIES:
                yield tree()
    if keys:
        yield tree()


def _search_block(docs: DataFrame, block: list[tuple], item_type: str, key: str, text: str, most: int) -> DataFrame:
    wanted = [sorted({t for part in parts_of_terms(words) for t in part}) for _, words in block]
    numbers = {t: k for k, t in enumerate(sorted({t for terms in wanted for t in terms}))}
    vectors = stored(term_vectors(docs, numbers, key, text), "vectors")
    documents, length = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    spread = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    frequency = np.zeros(len(numbers), np.int64)  # one row per term of the block came back
    for row in spread:
        frequency[row["term"]] = row["df"]
    order = np.argsort(-frequency, kind="stable")
    rank_of = np.empty(len(numbers), np.int64)
    rank_of[order] = np.arange(len(numbers))
    items = []
    for terms in wanted:
        used = np.array([numbers[t] for t in terms if frequency[numbers[t]]], dtype=np.int64)
        weights = np.array([weight_of(documents, int(frequency[t])) for t in used], dtype=np.int64)
        ranks = rank_of[used]
        falling = np.argsort(ranks)
        items.append((ranks[falling], weights[falling]))
    names = [name for name, _ in block]
    kind, out_type = docs.schema[key].dataType.simpleString(), to_arrow_type(docs.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(most) for _ in items]
        for keys, tree in _trees(batches, rank_of, documents, length):
            for (ranks, weights), best in zip(items, found, strict=True):
                best.keys = keys
                tree.search(ranks, weights, best)
        rows = [(q, hit.key, hit.score) for q, best in enumerate(found) for hit in best.heap]
        if rows:
            columns = list(zip(*rows, strict=True))
            types = [pa.int32(), out_type, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["q", "key", "score"])

    hits = vectors.where(F.size("terms") > 0).mapInArrow(run, f"q int, key {kind}, score bigint")
    order_by = W.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = hits.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= most)
    named = docs.sparkSession.createDataFrame(list(enumerate(names)), f"q int, item {item_type}")  # one row per item of the block
    return stored(ranked.join(F.broadcast(named), "q").select("item", "rank", "key", "score"), "hits")


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    block, terms = [], set()
    for row in items.toLocalIterator():
        block.append((row[0], row[1]))
        for part in parts_of_terms(row[1]):
            terms.update(part)
        if len(block) >= BLOCK_ITEMS or len(terms) >= BLOCK_TERMS:
            yield block
            block, terms = [], set()
    yield block


def search(
    docs: DataFrame, items: DataFrame, item: str = "item_id", key: str = "doc_id", text: str = "text", item_text: str = "text",
    most: int = BEST,
) -> DataFrame:
    """``item, rank, key, score`` of the documents with the highest scores above 0 of every row of ``items``.

    Equal scores are ranked by key, null keys last. A null or empty text has no terms: such a document is found by nothing
    and such an item finds nothing. Repeated documents are documents of their own, repeated items are answered each.
    Texts of any length are taken whole; further columns are ignored. Without documents, items or common terms the result is empty.
    """
    asked = items.select(F.col(f"`{item}`"), F.col(f"`{item_text}`"))
    kind = items.schema[item].dataType.simpleString()
    blocks = [_search_block(docs, block, kind, key, text, most) for block in _blocks(asked)]
    found = reduce(DataFrame.unionByName, blocks)
    return found.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
