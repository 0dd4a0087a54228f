"""Nearest neighbours by cosine: one vantage-point tree per shard, all trees searched by all query blocks.

Method: on unit vectors the chord length is a metric that falls as the cosine rises. Each shard builds a tree: a vantage point
splits its rows at the median of their distances to it, down to leaves. A block of queries walks a tree together; at a node,
queries go to the side they are nearer to first. A side whose rows lie at distances low to high from the vantage point cannot
hold anything nearer than max(low - d, d - high); it is left out for a query if ``factor`` times that bound exceeds the
distance of its k-th best so far. Factor 1 is the exact search; larger factors leave out more. Scores of the rows found are
computed again on the original vectors, and the shards' candidates are ranked together.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.llm.common import stored
from reelweave.llm.vectors import cosines, matrix, units, usable
from reelweave.session import handoff

SHARD_ROWS = 4096
BLOCK_QUERIES = 4096
LEAF_ROWS = 128
FACTOR = 4.0
SAME = 1e-9  # cosines this near to the k-th best are all scored again, so that ties are settled by id
SLACK = 1e-6  # a chord near 0 is the root of a cosine's rounding: no side is left out for less


class VantageTree:
    """A tree over distinct vectors; every vector lists the ids that have it, smallest first."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], leaf_rows: int = LEAF_ROWS, most: int = 6):
        self.vectors, self.leaf_rows, self.most = vectors, leaf_rows, most
        self.ids = [x[:most] for x in ids]
        self.units = units(vectors)
        self.root = self._grow(np.arange(len(vectors)))

    def _grow(self, rows: np.ndarray):
        if len(rows) <= self.leaf_rows:
            return rows
        point = self.units[rows[0]]
        far = np.sqrt(np.maximum(0.0, 2 - 2 * (self.units[rows] @ point)))
        order = np.argsort(far, kind="stable")
        half = len(rows) // 2
        inner, outer = order[:half], order[half:]
        middle = (far[inner[-1]] + far[outer[0]]) / 2
        return (
            rows[0], middle,
            (far[inner[0]], far[inner[-1]], self._grow(rows[inner])),
            (far[outer[0]], far[outer[-1]], self._grow(rows[outer])),
        )

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float) -> pd.DataFrame:
        """The k nearest ids of every query that the walk finds, without the query itself."""
        if k >= self.most:
            raise ValueError(f"the index was built for up to {self.most - 1} neighbours")
        self.queries, self.k, self.factor = units(queries), k + 1, factor  # one more, as the query may be among them
        self.best = np.full((len(queries), self.k), np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._visit(self.root, np.arange(len(queries)))
        query, row, cosine = (np.concatenate(x) if x else np.zeros(0, int) for x in zip(*self.found, strict=True))
        # what was among the best at the time, against the final bound
        limit = 1 - self.best[query, -1] ** 2 / 2 if len(query) else np.zeros(0)
        near = np.isinf(self.best[query, -1]) | (cosine >= limit - SAME) if len(query) else np.zeros(0, bool)
        query, row = query[near], row[near]
        lists = [self.ids[r][: self.k] for r in row]
        sizes = [len(x) for x in lists]
        query, row = np.repeat(query, sizes), np.repeat(row, sizes)
        ids = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        score = cosines(queries[query], self.vectors[row]) if len(query) else np.zeros(0)
        out = pd.DataFrame({"query_id": query_ids[query], "vec_id": ids, "score": score})
        out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        out = out.drop_duplicates(["query_id", "vec_id"])
        return out.groupby("query_id", sort=False).head(k)

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            self._look(node, active)
            return
        point, middle, inner, outer = node
        far = np.sqrt(np.maximum(0.0, 2 - 2 * (self.queries[active] @ self.units[point])))
        nearer = far <= middle
        for first, second, side in ((inner, outer, nearer), (outer, inner, ~nearer)):
            going, away = active[side], far[side]
            self._enter(first, going, away)
            self._enter(second, going, away)

    def _enter(self, side: tuple, active: np.ndarray, far: np.ndarray) -> None:
        low, high, node = side
        bound = np.maximum(0.0, np.maximum(low - far, far - high))
        self._visit(node, active[(bound - SLACK) * self.factor <= self.best[active, -1] + SLACK])

    def _look(self, rows: np.ndarray, active: np.ndarray) -> None:
        for at in range(0, len(active), 1024):
            part = active[at : at + 1024]
            cosine = self.queries[part] @ self.units[rows].T
            # a vector that several ids have counts as often in the bound
            weight = np.minimum([len(self.ids[r]) for r in rows], self.k)
            far = np.repeat(np.sqrt(np.maximum(0.0, 2 - 2 * cosine)), weight, axis=1)
            both = np.concatenate([self.best[part], far], axis=1)
            self.best[part] = np.sort(np.partition(both, self.k - 1, axis=1)[:, : self.k], axis=1)
            worst = self.best[part, -1]
            limit = np.where(np.isinf(worst), -2.0, 1 - worst**2 / 2)
            i, j = np.nonzero(cosine >= limit[:, None] - SAME)
            self.found.append((part[i], rows[j], cosine[i, j]))


def _build(leaf_rows: int, most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        values = matrix(rows["vector"])
        distinct, where = np.unique(values, axis=0, return_inverse=True)
        where = where.reshape(-1)
        order = np.argsort(where, kind="stable")
        ids = np.split(rows["id"].to_numpy(np.int64)[order], np.cumsum(np.bincount(where))[:-1])
        tree = VantageTree(distinct, [np.unique(x) for x in ids], leaf_rows, most)
        return pd.DataFrame({"dims": rows["dims"].iat[0], "shard": rows["shard"].iat[0], "tree": [pickle.dumps(tree)]})

    return run


def _search(k: int, factor: float):
    def run(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(trees) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree = pickle.loads(trees["tree"].iat[0])
        return tree.search(matrix(queries["vector"]), queries["id"].to_numpy(np.int64), k, factor)

    return run


def build_index(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 6,
    shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``dims, shard, tree``: one row per shard of about ``shard_rows`` vectors. Searches for up to ``most - 1`` neighbours."""
    rows = _rows(vectors, key, vector)
    sizes = rows.groupBy("dims").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    rows = rows.join(handoff(sizes), "dims").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
    # as many partitions as a shuffle has: merged to a few by their small size, the trees would be built by a few tasks
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trees = rows.select("dims", "shard", "id", "vector").repartition(tasks, "dims", "shard").groupBy("dims", "shard")
    return stored(trees.applyInPandas(_build(leaf_rows, most), "dims int, shard int, tree binary"), "trees")


def _rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    rows = rows.where(F.coalesce(usable("vector") & F.col("id").isNotNull(), F.lit(False)))
    return rows.withColumn("dims", F.size("vector"))


def nearest(
    index: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, key: str = "vec_id", vector: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of the index for every query, by falling cosine, then by id.

    Each tree meets each block of queries once, in a task of its own. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null key, take no part, neither as queries nor as candidates; vectors of
    different lengths are not compared. A query does not find its own id. Rows that repeat an id count once, with the
    largest of their cosines. Fewer than k candidates are all returned; an empty table gives no rows. An index that was
    built for fewer than k neighbours raises an error.
    """
    wanted = _rows(queries, key, vector)
    sizes = wanted.groupBy("dims").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("blocks"))
    shards = index.groupBy("dims").agg((F.max("shard") + 1).alias("shards"))
    sizes = handoff(sizes.join(shards, "dims"))
    trees = index.join(sizes, "dims").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wanted = wanted.join(sizes, "dims").withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int"))
    wanted = wanted.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    by = ["dims", "shard", "block"]
    found = (
        trees.select(*by, "tree").groupBy(*by)
        .cogroup(wanted.select(*by, "id", "vector").groupBy(*by))
        .applyInPandas(_search(k, factor), "query_id bigint, vec_id bigint, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
