"""Near-duplicate embeddings of one label: cells by spherical k-means, blocked cosine products inside them.

Method: for every label of two or more vectors, spherical k-means is fitted on a bounded sample. Each vector
is at home in the cell of its nearest centre. Vectors that could be linked across a border also visit the other cell: a
vector at an angle of at most t from x can lie nearer to centre b than to x's own centre a only if x.(a - b) is at most
sin(t) |a - b|, so no link is lost. In a cell, homes are compared with homes and visitors in blocks; links are counted for the
homes, and a spanning forest of them is passed on, never the pairs. Groups are the connected components, and the vector with
the smallest id represents its group. Equal vectors of a label are compared once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.llm.common import connected_components, stored
from reelweave.llm.vectors import Forest, cosines, matrix, units, usable
from reelweave.session import handoff

MIN_COSINE = 0.93
CELL_ROWS = 1024  # a label gets a cell per so many rows
MIN_CELLS = 2  # and at least so many, if it has as many vectors
MAX_CELLS = 1024
SAMPLE = 20_000  # rows of a label that its centres are fitted on, in the order of a hash
BLOCK = 2048  # rows of a cell that one task compares with as many others
ROUNDS = 8
BORDER = 1e-9  # cosines this near to the limit are computed again, summed in one order


def spherical_kmeans(rows: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of unit rows. Starts from evenly spaced rows; a cell that runs empty keeps its centre."""
    centres = rows[np.linspace(0, len(rows) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        lengths = np.sqrt((sums * sums).sum(axis=1))
        moved = lengths > 1e-12
        centres[moved] = sums[moved] / lengths[moved, None]
    return centres


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    centres = spherical_kmeans(units(matrix(rows["vector"])), int(rows["cells"].iat[0]))
    return pd.DataFrame(
        {"label": rows["label"].iat[0], "dims": rows["dims"].iat[0], "cell": np.arange(len(centres)), "centre": list(centres)}
    )


def _assign(min_cosine: float):
    reach = math.sqrt(max(0.0, 1 - min_cosine * min_cosine)) + 1e-9

    def run(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"node": [], "visits": [], "home": []})
        if not len(centres):
            return pd.DataFrame({"node": rows["node"], "home": 0, "visits": [[0]] * len(rows)})
        centre = matrix(centres.sort_values("cell")["centre"])
        products = units(matrix(rows["vector"])) @ centre.T
        home = products.argmax(axis=1)
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * np.clip(centre @ centre.T, -1, 1)))
        visits = products.max(axis=1)[:, None] - products <= reach * apart[home] + 1e-12
        return pd.DataFrame({"node": rows["node"], "home": home, "visits": [np.nonzero(v)[0] for v in visits]})

    return run


def _compare(min_cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "other": [], "links": []})
        a, b = matrix(left["vector"]), matrix(right["vector"])
        unit_a, unit_b = units(a), units(b)
        ids = np.concatenate([left["node"].to_numpy(np.int64), right["node"].to_numpy(np.int64)])
        mine, theirs = ids[: len(a)], ids[len(a) :]
        copies = right["n"].to_numpy(np.int64)
        forest, links = Forest(len(ids)), np.zeros(len(a), np.int64)
        same, where = np.unique(ids, return_inverse=True)  # a vector may be on both sides
        for at in range(0, len(a), 512):
            near = unit_a[at : at + 512] @ unit_b.T
            i, j = np.nonzero(near >= min_cosine - BORDER)
            unsure = near[i, j] < min_cosine + BORDER
            if unsure.any():
                keep = ~unsure
                keep[unsure] = cosines(a[at + i[unsure]], b[j[unsure]]) >= min_cosine
                i, j = i[keep], j[keep]
            i = i + at
            other = mine[i] != theirs[j]
            i, j = i[other], j[other]
            links += np.bincount(i, weights=copies[j], minlength=len(a)).astype(np.int64)
            forest.add(where[i], where[len(a) + j])
        first, second = forest.edges()
        counted = np.nonzero(links)[0]
        return pd.DataFrame(
            {
                "node": np.concatenate([mine[counted], same[first]]),
                "other": pd.array([None] * len(counted) + same[second].tolist(), dtype="Int64"),
                "links": np.concatenate([links[counted], np.zeros(len(first), np.int64)]),
            }
        )

    return run


def near_duplicate_vectors(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cell_rows: int = CELL_ROWS,
    block: int = BLOCK,
    sample: int = SAMPLE,
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row; further columns are dropped.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or key, link with
    nothing and are kept. Vectors of different lengths never link. Equal rows are vectors of their own, linked with each
    other; different vectors under one key are one node, with the links of both. Without rows the result is empty.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    takes_part = F.coalesce(usable("vector") & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False))
    good = stored(rows.where(takes_part), "vectors")
    distinct = good.groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("n"))
    distinct = stored(distinct.withColumn("dims", F.size("vector")), "distinct")

    labels = distinct.groupBy("label", "dims").agg(F.count("*").alias("rows"))
    wanted = F.least(F.greatest(F.ceil(F.col("rows") / cell_rows), F.lit(MIN_CELLS)), F.lit(MAX_CELLS))
    cells = F.least(wanted, "rows").cast("int")
    labels = handoff(labels.withColumn("cells", cells).withColumn("shares", F.ceil(F.col("rows") / 16384).cast("int")))
    spread = distinct.join(labels, ["label", "dims"])
    first = F.row_number().over(W.partitionBy("label", "dims").orderBy(F.xxhash64("node"), "node"))
    sampled = spread.where(F.col("cells") > 1).withColumn("place", first).where(F.col("place") <= sample)
    kinds = f"label {good.schema['label'].dataType.simpleString()}, dims int"
    node_type = good.schema["id"].dataType.simpleString()
    centres = sampled.select("label", "dims", "cells", "vector").groupBy("label", "dims")
    centres = stored(centres.applyInPandas(_fit, f"{kinds}, cell int, centre array<double>"), "centres")

    shares = spread.withColumn("share", F.pmod(F.xxhash64("node", F.lit(3)), F.col("shares")).cast("int"))
    every = centres.join(labels, ["label", "dims"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    by = ["label", "dims", "share"]
    homes = (
        shares.select(*by, "node", "vector").groupBy(*by)
        .cogroup(every.select(*by, "cell", "centre").groupBy(*by))
        .applyInPandas(_assign(min_cosine), f"node {node_type}, home int, visits array<int>")
    )
    homes = stored(homes, "homes")

    members = distinct.join(homes, "node").withColumn("cell", F.explode("visits"))
    members = members.withColumn("at_home", F.col("cell") == F.col("home"))
    sizes = members.groupBy("label", "dims", "cell").agg(F.count("*").alias("all"), F.sum(F.col("at_home").cast("long")).alias("homes"))
    sizes = handoff(sizes)
    members = members.join(sizes, ["label", "dims", "cell"])
    blocks, home_blocks = F.ceil(F.col("all") / block).cast("int"), F.greatest(F.lit(1), F.ceil(F.col("homes") / block)).cast("int")
    members = members.withColumn("column", F.pmod(F.xxhash64("node", F.lit(5)), blocks).cast("int")).withColumn(
        "line", F.pmod(F.xxhash64("node", F.lit(7)), home_blocks).cast("int")
    )
    as_home = F.transform(
        F.when(F.col("at_home"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>")),
        lambda c: F.struct(F.col("line").alias("line"), c.alias("column"), F.lit(0).alias("side")),
    )
    as_member = F.transform(
        F.sequence(F.lit(0), home_blocks - 1), lambda r: F.struct(r.alias("line"), F.col("column").alias("column"), F.lit(1).alias("side"))
    )
    placed = members.select("label", "dims", "cell", "node", "n", "vector", F.explode(F.concat(as_home, as_member)).alias("at"))
    placed = placed.select("label", "dims", "cell", "node", "n", "vector", "at.*")
    found = placed.groupBy("label", "dims", "cell", "line", "column").applyInPandas(
        _compare(min_cosine), f"node {node_type}, other {node_type}, links bigint"
    )
    found = stored(found, "links")
    groups = connected_components(found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("links").alias("links"))

    named = distinct.join(counts, "node", "left").join(groups, "node", "left").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"),
    )
    named = stored(named, "named")
    linked = good.join(named, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")))
    others = rows.where(~takes_part).withColumn("n_links", F.lit(0).cast("bigint")).withColumn("component_id", F.col("id"))
    every = linked.select("id", "n_links", "component_id").unionByName(others.select("id", "n_links", "component_id"))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return every.select(F.col("id").alias(key), "n_links", "component_id", kept.alias("kept"))
