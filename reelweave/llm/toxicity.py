"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters.

Method: a word's input is a learned vector of the word itself, if the training texts have it often enough, plus the mean of
learned vectors of its hashed character trigrams. A text is cut into overlapping windows of words; the network runs over each
window in both directions, attention weighs its states, and a logistic unit scores their sum. A text scores as its highest
window. The network is trained in numpy on the driver, on a bounded sample of labelled rows, with its highest windows standing
for each text; scoring runs in Spark tasks over all windows of all whole texts. The input projections of a word are computed
once per Python worker and kept in a bounded cache.
"""

from __future__ import annotations

import hashlib
import pickle
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelweave.llm.bpe import map_texts, text_slices

WINDOW, STRIDE = 32, 16  # words
UNITS, INPUTS, ATTENTION, BUCKETS = 8, 12, 8, 4096
MAX_VOCABULARY, MIN_DOCUMENTS = 4000, 3
ROUNDS, EPOCHS, BATCH, RATE, DECAY = 4, 6, 64, 0.01, 1e-4
CACHE_WORDS, BLOCK_WORDS = 100_000, 8192


class Sample(NamedTuple):
    """Bounds of the training sample: texts with and without the label, in the order of a hash of their id, bytes of one
    text (longer ones do not train, as their label may rest on a single window), and bytes of all texts."""

    toxic: int = 1200
    clean: int = 2400
    text_bytes: int = 60_000
    bytes: int = 1 << 26


SAMPLE = Sample()
EDGES = string.punctuation + "«»“”„‘’…–—¡¿"
PAD, BLANK = 0, 1  # rows of the input table: behind the end of a short text, and words without letters


def normal_word(chunk: str) -> str:
    return chunk.lower().strip(EDGES)


def trigram_means(words: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means of the trigram vectors of words that are not empty, with the trigrams' buckets and each word's first one."""
    raw = [b"<" + w.encode() + b">" for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    letters = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    hashed = (letters[:-2] * np.uint32(0x9E3779B1)) ^ (letters[1:-1] * np.uint32(0x85EBCA6B)) ^ (letters[2:] * np.uint32(0xC2B2AE35))
    hashed = ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - (BUCKETS - 1).bit_length())
    ends = np.cumsum(sizes)
    inside = np.ones(len(letters), bool)
    inside[ends - 1] = inside[ends - 2] = False
    buckets = hashed[inside[: len(hashed)]].astype(np.int64)
    first = ends - sizes - 2 * np.arange(len(sizes))
    return np.add.reduceat(table[buckets], first, axis=0) / (sizes - 2)[:, None], buckets, first


class Network:
    """Parameters and the passes of the network; ``train`` fits them."""

    def __init__(self, vocabulary: dict[str, int], weights: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.1, shape)
        self.vocabulary = vocabulary  # word -> row of the word table, from 1; row 0 is for all other words
        self.p = {"word": small(len(vocabulary) + 1, INPUTS), "char": small(BUCKETS, INPUTS), "blank": small(1, INPUTS)}
        self.p["word"][0] = 0
        self.p["word"][1:, 0] = weights
        for way in "fb":
            self.p |= {f"in_{way}": small(INPUTS, 3 * UNITS) * 3, f"re_{way}": small(UNITS, 3 * UNITS) * 3, f"bias_{way}": np.zeros(3 * UNITS)}
        self.p |= {"att": small(2 * UNITS, ATTENTION) * 3, "pick": small(ATTENTION) * 3, "out": small(2 * UNITS) * 3, "base": np.zeros(1) - 1}

    # -- inputs ----------------------------------------------------------------------------------------------------

    def word_inputs(self, words: list[str]) -> np.ndarray:
        """Input vectors of normalised words that are not empty."""
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        out = self.p["word"][rows]
        for k in range(0, len(words), BLOCK_WORDS):  # every trigram of a block is looked up at once
            out[k : k + BLOCK_WORDS] += trigram_means(words[k : k + BLOCK_WORDS], self.p["char"])[0]
        return out

    def projected(self, inputs: np.ndarray, way: str) -> np.ndarray:
        return (inputs @ self.p[f"in_{way}"] + self.p[f"bias_{way}"]).astype(np.float32)

    # -- passes ----------------------------------------------------------------------------------------------------

    def _run(self, x: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """States after every step; x holds the projected inputs (steps, windows, 3 * units): keep, reset, candidate."""
        steps, size, _ = x.shape
        recurrent = self.p[f"re_{way}"].astype(x.dtype)
        h, states = np.zeros((size, UNITS), x.dtype), np.empty((steps, size, UNITS), x.dtype)
        u = UNITS
        for t in range(steps):
            g = h @ recurrent
            gates = 0.5 + 0.5 * np.tanh(0.5 * (x[t, :, : 2 * u] + g[:, : 2 * u]))
            c = np.tanh(x[t, :, 2 * u :] + gates[:, u:] * g[:, 2 * u :])
            if keep is not None:
                keep.append((h, gates, c, g[:, 2 * u :]))
            h = c + gates[:, :u] * (h - c)
            states[t] = h
        return states

    def forward(self, forth: np.ndarray, back: np.ndarray, padded: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows. ``forth``, ``back``: projected inputs in both directions; ``padded``: (steps, windows)."""
        kept: dict[str, list | None] = {w: None if keep is None else [] for w in "fb"}
        states = np.concatenate([self._run(forth, "f", kept["f"]), self._run(back[::-1], "b", kept["b"])[::-1]], axis=2)
        attended = np.tanh(states @ self.p["att"].astype(states.dtype))
        score = attended @ self.p["pick"].astype(states.dtype)
        score[padded] = -1e9
        score -= score.max(axis=0)
        share = np.exp(score)
        share /= share.sum(axis=0)
        pooled = (share[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep |= {"kept": kept, "states": states, "attended": attended, "share": share, "pooled": pooled}
        return pooled @ self.p["out"].astype(states.dtype) + self.p["base"].astype(states.dtype)

    def _run_back(self, kept: list, way: str, d_states: np.ndarray, grads: dict) -> np.ndarray:
        recurrent, u = self.p[f"re_{way}"], UNITS
        d_x, d_h = np.empty((*d_states.shape[:2], 3 * u)), np.zeros(d_states.shape[1:])
        d_re = np.zeros_like(recurrent)
        for t in range(len(kept) - 1, -1, -1):
            before, gates, c, g_c = kept[t]
            z, r = gates[:, :u], gates[:, u:]
            d_h = d_h + d_states[t]
            d_c = d_h * (1 - z) * (1 - c * c)
            d_z = d_h * (before - c) * z * (1 - z)
            d_r = d_c * g_c * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_c * r], axis=1)
            d_x[t] = np.concatenate([d_z, d_r, d_c], axis=1)
            d_re += before.T @ d_g
            d_h = d_h * z + d_g @ recurrent.T
        grads[f"re_{way}"] = d_re
        return d_x

    def gradients(self, words: list[str], index: np.ndarray, padded: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of windows: ``index`` (steps, windows) into ``words``, whose first one stands for blanks."""
        p, u = self.p, UNITS
        means, buckets, first = trigram_means(words[1:], p["char"])
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in words[1:]), np.int64, len(words) - 1)
        inputs = np.concatenate([p["blank"], p["word"][rows] + means])
        x = {w: inputs @ p[f"in_{w}"] + p[f"bias_{w}"] for w in "fb"}
        steps = {w: x[w][index] for w in "fb"}
        for w in "fb":
            steps[w][padded, :u] = 30.0  # a padded step keeps the state
        keep: dict = {}
        logits = self.forward(steps["f"], steps["b"], padded, keep)
        score = 1 / (1 + np.exp(-logits))
        loss = float(np.mean(np.logaddexp(0, logits) - labels * logits))
        d_logit = (score - labels) / len(labels)
        grads = {"out": keep["pooled"].T @ d_logit, "base": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["out"]
        share, states, attended = keep["share"], keep["states"], keep["attended"]
        d_states = share[:, :, None] * d_pooled
        d_share = (states * d_pooled).sum(axis=2)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        grads["pick"] = np.tensordot(d_score, attended, ((0, 1), (0, 1)))
        d_att = d_score[:, :, None] * p["pick"] * (1 - attended * attended)
        grads["att"] = np.tensordot(states, d_att, ((0, 1), (0, 1)))
        d_states = d_states + d_att @ p["att"].T
        d_inputs = np.zeros_like(inputs)
        for w in "fb":
            mine = d_states[:, :, :u] if w == "f" else d_states[::-1, :, u:]
            d_x = self._run_back(keep["kept"][w], w, mine, grads)
            d_x = d_x if w == "f" else d_x[::-1]
            d_x[padded] = 0
            d_table = np.zeros_like(x[w])
            np.add.at(d_table, index, d_x)
            grads[f"in_{w}"], grads[f"bias_{w}"] = inputs.T @ d_table, d_table.sum(axis=0)
            d_inputs += d_table @ p[f"in_{w}"].T
        grads["blank"] = d_inputs[:1]
        grads["word"], grads["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(grads["word"], rows, d_inputs[1:])
        grads["word"][0] = 0
        counts = np.diff(np.append(first, len(buckets)))
        np.add.at(grads["char"], buckets, np.repeat(d_inputs[1:] / counts[:, None], counts, axis=0))
        return loss, grads


class Scorer:
    """Scores whole texts with a network; keeps the projected inputs of words it has seen."""

    def __init__(self, network: Network):
        self.network = network
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[str, int] = {}
        blank = self.network.p["blank"]
        start = {w: np.concatenate([np.zeros((1, 3 * UNITS), np.float32), self.network.projected(blank, w)]) for w in "fb"}
        for w in "fb":
            start[w][PAD, :UNITS] = 30.0
        self.tables, self.used = start, 2

    def _learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.rows]
        if self.used + len(new) > CACHE_WORDS and self.used > 2:
            self._reset()
            new = list(chunks)
        normal = {c: normal_word(c) for c in new}
        words = sorted({w for w in normal.values() if w})
        place = {w: self.used + k for k, w in enumerate(words)} | {"": BLANK}
        if words:
            inputs = self.network.word_inputs(words)
            for w in "fb":
                table = self.tables[w]
                if self.used + len(words) > len(table):
                    table = np.concatenate([table[: self.used], np.empty((max(len(words), self.used), 3 * UNITS), np.float32)])
                table[self.used : self.used + len(words)] = self.network.projected(inputs, w)
                self.tables[w] = table
            self.used += len(words)
        self.rows.update({c: place[w] for c, w in normal.items()})

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word rows of all windows (windows, steps), and the text that each belongs to. Texts without words have none."""
        cut = [t.split() for t in texts]
        self._learn({c for words in cut for c in words})
        row = self.rows.__getitem__
        out, owner = [], []
        for k, words in enumerate(cut):
            if words:
                out.append(window_rows(np.fromiter(map(row, words), np.int32, len(words)), PAD))
                owner.append(np.full(len(out[-1]), k))
        if not out:
            return np.zeros((0, WINDOW), np.int32), np.zeros(0, np.int64)
        return np.concatenate(out), np.concatenate(owner)

    def logits(self, index: np.ndarray) -> np.ndarray:
        out = np.empty(len(index), np.float32)
        for at in range(0, len(index), 2048):
            part = index[at : at + 2048].T
            out[at : at + 2048] = self.network.forward(self.tables["f"][part], self.tables["b"][part], part == PAD)
        return out

    def scores(self, texts: list[str]) -> list[float]:
        """The score of each text: its highest window's; 0 for a text without words."""
        index, owner = self.windows(texts)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, self.logits(index))
        with np.errstate(over="ignore"):
            return (1 / (1 + np.exp(-best))).tolist()


def window_rows(ids: np.ndarray, pad: int) -> np.ndarray:
    """All overlapping windows of a text's word rows; the last one ends with the text, a short text is padded."""
    if len(ids) <= WINDOW:
        out = np.full((1, WINDOW), pad, np.int32)
        out[0, : len(ids)] = ids
        return out
    starts = np.append(np.arange(0, len(ids) - WINDOW, STRIDE), len(ids) - WINDOW)
    return ids[starts[:, None] + np.arange(WINDOW)]


def choose_vocabulary(table: list[str], texts: list[np.ndarray], labels: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
    """Words that enough training texts have, by how much the label depends on them, and their starting weights: smoothed
    log odds of the label, shrunk for words that few texts have. Texts are rows of the table of words."""
    counts = np.zeros((2, len(table)))
    for ids, label in zip(texts, labels, strict=True):
        counts[int(label), np.unique(ids)] += 1
    clean, toxic = counts
    n_toxic, n_clean = labels.sum(), len(labels) - labels.sum()
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    weight = odds * (toxic + clean) / (toxic + clean + 5)
    known = [k for k in np.nonzero(toxic + clean >= MIN_DOCUMENTS)[0].tolist() if table[k]]
    chosen = sorted(known, key=lambda k: (-abs(weight[k]), table[k]))[:MAX_VOCABULARY]
    return {table[k]: n for n, k in enumerate(chosen, 1)}, weight[chosen]


def word_rows(texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct normalised words of all texts, the empty one first, and each text as rows of that table."""
    place, seen, out = {"": 0}, {}, []
    for text in texts:
        chunks = text.split()
        for chunk in chunks:
            if chunk not in seen:
                seen[chunk] = place.setdefault(normal_word(chunk), len(place))
        out.append(np.fromiter(map(seen.__getitem__, chunks), np.int32, len(chunks)))
    return list(place), out


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """Fits a network to labelled texts. The same texts in the same order give the same network."""
    target = np.array(labels, dtype=np.float64)
    table, rows = word_rows(texts)
    vocabulary, weights = choose_vocabulary(table, rows, target)
    network = Network(vocabulary, weights, seed)
    if not len(target) or target.min() == target.max():
        network.p["out"][:] = 0
        network.p["base"][:] = np.log((target.sum() + 0.5) / (len(target) - target.sum() + 0.5))
        return network
    rng = np.random.default_rng(seed)
    value = np.array([weights[vocabulary[w] - 1] if w in vocabulary else 0.0 for w in table])
    filled = [k for k, ids in enumerate(rows) if len(ids)]
    windows = [window_rows(rows[k], -1) for k in filled]
    index, owner = np.concatenate(windows), np.repeat(filled, [len(w) for w in windows])
    del windows, rows
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    best, turn = np.where(index >= 0, value[index], -9.0).max(axis=1), 0
    for round_ in range(ROUNDS):
        order = np.lexsort((-best, owner))
        heads = np.append(0, np.nonzero(np.diff(owner[order]))[0] + 1)
        chosen, second = order[heads], order[np.minimum(heads + 1, len(order) - 1)]
        labelled = target[owner[chosen]]
        if round_ > 1:  # texts whose label nothing in them explains teach nothing
            clear = (labelled == 0) | (best[chosen] > -2)
            chosen, labelled, second = chosen[clear], labelled[clear], second[clear]
        more = second[(labelled == 0) & (target[owner[second]] == 0)]
        chosen, labelled = np.concatenate([chosen, more]), np.concatenate([labelled, np.zeros(len(more))])
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // BATCH)):
                used, local = np.unique(np.maximum(index[chosen[part]], 0), return_inverse=True)
                local = local.reshape(len(part), WINDOW).T
                shift = 0 if used[0] == 0 else 1  # the first word always stands for blanks
                names = [table[k] for k in used[1 - shift :]]
                padded = index[chosen[part]].T < 0
                _, grads = network.gradients(["", *names], local + shift, padded, labelled[part])
                turn += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    g = g + DECAY * network.p[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    network.p[k] -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-6)
                network.p["word"][0] = 0
        both = {w: np.zeros((len(table) + 1, 3 * UNITS), np.float32) for w in "fb"}  # the last row is for padded steps
        for at in range(0, len(table), BLOCK_WORDS):
            words = table[max(at, 1) : at + BLOCK_WORDS]
            inputs = [network.p["blank"]] * (at == 0) + [network.word_inputs(words)] * bool(words)
            for w in "fb":
                both[w][at : at + BLOCK_WORDS][: len(table) - at] = network.projected(np.concatenate(inputs), w)
        for w in "fb":
            both[w][-1, :UNITS] = 30.0
        best = np.concatenate(
            [network.forward(both["f"][i], both["b"][i], i < 0) for i in (index[a : a + 2048].T for a in range(0, len(index), 2048))]
        )
    return network


def held_out(key: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: Sample = SAMPLE
) -> tuple[list[str], list[int]]:
    """The bounded sample of labelled texts that are not held out, in the order of a hash of their id.

    Of repeated labels the largest counts, of repeated documents the smallest text; null labels and ids, null texts and texts
    beyond the sample's bytes are left out. A label's ids are cut to a range of the hash that holds about twice the wanted
    number before they are ranked, so that the rank never sees all ids of a label.
    """
    marks = labels.select(F.col(key).alias("k"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("k").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("k")))
    marks = marks.groupBy("k").agg(F.max("toxic").alias("toxic")).withColumn("at", F.xxhash64("k"))
    kinds = {True: sample.toxic, False: sample.clean}
    counts = marks.groupBy((F.col("toxic") == 1).alias("kind")).agg(F.count("*").alias("n")).collect()  # two rows
    chosen = F.lit(False)
    for row in counts:
        share = min(1.0, (2 * kinds[row["kind"]] + 1000) / row["n"])
        last = min((1 << 63) - 1, -(1 << 63) + round(share * (1 << 64)))
        chosen = chosen | (((F.col("toxic") == 1) == F.lit(row["kind"])) & (F.col("at") <= F.lit(last)))
    rank = F.row_number().over(W.partitionBy("toxic").orderBy("at", "k"))
    most = F.when(F.col("toxic") == 1, sample.toxic).otherwise(sample.clean)
    marks = marks.where(chosen).withColumn("rank", rank).where(F.col("rank") <= most)
    # at most as many ids as the sample has
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).where(F.octet_length("text") <= sample.text_bytes)
    found = rows.join(F.broadcast(marks), "k").groupBy("k").agg(*[F.min(c).alias(c) for c in ("at", "toxic", "text")])
    before = F.sum(F.octet_length("text")).over(W.orderBy("at", "k").rowsBetween(W.unboundedPreceding, 0))
    found = found.withColumn("bytes", before).where(F.col("bytes") <= sample.bytes).orderBy("at", "k").collect()
    return [r["text"] for r in found], [r["toxic"] for r in found]


_LOADED: dict[str, Scorer] = {}


def _scorer(token: str, dumped: bytes) -> Scorer:
    if token not in _LOADED:
        _LOADED.clear()
        _LOADED[token] = Scorer(pickle.loads(dumped))
    return _LOADED[token]


def score_texts(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every row's whole text; a null text, or one without words, scores 0. One pass, no shuffle."""
    dumped = pickle.dumps(network)
    token = hashlib.sha1(dumped).hexdigest()
    return map_texts(docs, [key], text, [pa.field("score", pa.float64())], "score double", lambda t: [_scorer(token, dumped).scores(t)])


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: Sample = SAMPLE
) -> DataFrame:
    """``key, held_out, score, predicted`` of every row. Trains on the labelled rows, then scores all whole texts.

    Without labels of both kinds the score is the share of the label; texts that are null or without words score 0 even then.
    Null keys are not held out. Repeated rows score alike; an empty table gives an empty one. Labels, and all columns but the
    text, are no inputs of a score.
    """
    network = train(*training_rows(docs, labels, key, text, sample))
    scored = score_texts(docs, network, key, text)
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: Sample = SAMPLE
) -> DataFrame:
    """The rows, with all their columns, whose text scores below 0.5.

    Null and empty texts score 0 and stay, repeated rows stay or go together, an empty table gives an empty one.
    """
    network = train(*training_rows(docs, labels, key, text, sample))
    dumped = pickle.dumps(network)
    token = hashlib.sha1(dumped).hexdigest()
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, place):
                scores = _scorer(token, dumped).scores(texts)
                yield part.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
