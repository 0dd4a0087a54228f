"""Byte-pair encoding and decoding over a public vocabulary file.

Method: the distinct words of a batch are inserted into a trie of bytes; a depth-first walk carries, for every prefix, the
last token of that prefix's encoding. A token ends a prefix's encoding exactly if it fits behind the last token of the
shorter prefix, so the encoding of a prefix that many words share is computed once, and a word's ids are read back from
the last tokens along its path. Encodings of whole chunks are kept in a bounded cache per Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from reelweave.llm.common import TwoGenerations

CACHE_CHUNKS, CACHE_WORDS = 300_000, 200_000
MEMO = 400_000  # remembered pairs of tokens and moves of the automaton
NEVER = 1 << 60
DEPENDENT = re.compile(r" (?:\s|$)|\s ").search  # a space that touches other white space or the end
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are laid out as little-endian 32-bit integers")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBpe:
    """Encoder and decoder of one byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level vocabulary without normalizer and prefix space is needed")
        letters = byte_letters()
        ids = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items()}
        merges = [tuple(bytes(letters[c] for c in part) for part in merge) for merge in spec["model"]["merges"]]
        size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.rank = [-1] * size  # of the merge that makes the token; single bytes have none
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.pair_rank: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            made = ids[left + right]
            self.pair_rank[ids[left], ids[right]] = rank
            if self.halves[made] is None:
                self.rank[made], self.halves[made] = rank, (ids[left], ids[right])
        self._match_tokens(ids)
        self.moves: dict[int, int] = {}
        self.bytes_of: list[bytes] = [b""] * size
        for word, i in ids.items():
            self.bytes_of[i] = word
        self.size_of = [len(word) for word in self.bytes_of]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for word, i in self.special.items():
            self.bytes_of[i] = word.encode()
        self.special_pattern = regex.compile("|".join(regex.escape(w) for w in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.words_of = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ).findall
        self.fits: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.spaced = TwoGenerations(CACHE_CHUNKS)  # chunk without its leading space -> ids of " " + chunk
        self.words = TwoGenerations(CACHE_WORDS)  # word of the pre-tokenizer -> ids

    # -- words ---------------------------------------------------------------------------------------------------

    def stable(self, left: int, right: int) -> bool:
        """Whether the joined bytes of the two tokens are encoded as just these two tokens.

        Undoes the merges of the two tokens from the latest to the first and looks, at every state in which two parts
        face each other, whether they would have merged before the step that was just undone.
        """
        limit = NEVER
        while True:
            if self.pair_rank.get((left, right), NEVER) < limit:
                return False
            left_rank, right_rank = self.rank[left], self.rank[right]
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                limit = left_rank
                left = self.halves[left][1]
            else:  # of equal merges the left one came first; a merge across would have come before the right one
                limit = right_rank + 1
                right = self.halves[right][0]

    def reachable(self, token: int) -> bool:
        """Whether the token's bytes are encoded as the token itself."""
        known = self.alone.get(token)
        if known is None:
            halves = self.halves[token]
            known = self.alone[token] = halves is None or (
                self.reachable(halves[0]) and self.reachable(halves[1]) and self._meet(*halves, self.rank[token])
            )
        return known

    def _meet(self, left: int, right: int, rank: int) -> bool:
        """Whether nothing merges across the two halves before the merge of the given rank joins them."""
        made = self.pair_rank.pop((left, right))
        try:
            return self.stable(left, right)
        finally:
            self.pair_rank[left, right] = made

    def _match_tokens(self, ids: dict[bytes, int]) -> None:
        """The automaton of all tokens: ``step`` holds its moves, ``ends`` the tokens that end in a state, longest first."""
        self.step: dict[int, int] = {}
        self.ends: list[tuple] = [()]
        self.back = [0]
        for word, token in ids.items():
            state = 0
            for byte in word:
                key = state << 8 | byte
                state = self.step.get(key)
                if state is None:
                    state = self.step[key] = len(self.ends)
                    self.ends.append(())
                    self.back.append(0)
            self.ends[state] = ((len(word), token),)
        tree: dict[int, list[tuple[int, int]]] = {}
        for key, state in self.step.items():
            tree.setdefault(key >> 8, []).append((key & 255, state))
        level = [state for _, state in tree[0]]
        while level:  # by length, so that the state behind is complete
            deeper = []
            for state in level:
                self.ends[state] += self.ends[self.back[state]]
                for byte, child in tree.get(state, ()):
                    self.back[child] = self._move(self.back[state], byte)
                    deeper.append(child)
            level = deeper

    def _move(self, state: int, byte: int) -> int:
        while state and state << 8 | byte not in self.step:
            state = self.back[state]
        return self.step.get(state << 8 | byte, 0)

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids (little-endian unsigned 32-bit) of distinct words of the pre-tokenizer.

        The sorted words are the trie in depth-first order: a word keeps the states of the prefix it shares with the word
        before it, and only its remaining bytes are new nodes.
        """
        moves, ends, fits, sizes = self.moves, self.ends, self.fits, self.size_of
        found: dict[str, bytes] = {}
        # for every prefix on the path: the last token of its encoding and the automaton's state
        last, states, before = [-1], [0], b""
        for word, text in sorted((w.encode(), w) for w in words):
            shared = 0
            for mine, other in zip(word, before):  # noqa: B905
                if mine != other:
                    break
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state, end = states[shared], shared
            for byte in word[shared:]:
                key = state << 8 | byte
                state = moves.get(key)
                if state is None:
                    state = moves[key] = self._move(key >> 8, byte)
                states.append(state)
                end += 1
                for length, token in ends[state]:
                    if length == end:
                        fit = self.reachable(token)
                    else:
                        key = last[end - length] << 32 | token
                        fit = fits.get(key)
                        if fit is None:
                            fit = fits[key] = self.stable(key >> 32, token)
                    if fit:
                        last.append(token)
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
            before = word
            at, tokens = len(word), []
            while at:
                token = last[at]
                tokens.append(token)
                at -= sizes[token]
            tokens.reverse()
            found[text] = array("I", tokens).tobytes()
        for memo in (fits, moves):  # both fill again quickly
            if len(memo) > MEMO:
                memo.clear()
        return found

    # -- texts ---------------------------------------------------------------------------------------------------

    def split_words(self, text: str) -> list[str]:
        """Words of the pre-tokenizer. The pattern module knows newer letters than the library, so texts beyond the
        Latin blocks are split by the library's own pre-tokenizer."""
        if max(text, default="") < "ɐ":
            return self.words_of(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of every whole text, as little-endian unsigned 32-bit integers."""
        parts: list[list] = []
        chunks: set[str] = set()
        words: set[str] = set()
        for text in texts:
            piece: list = []
            begin = 0
            for match in self.special_pattern.finditer(text):
                piece += [text[begin : match.start()], self.special[match.group()]]
                begin = match.end()
            piece.append(text[begin:])
            for k, x in enumerate(piece):
                if isinstance(x, str):
                    piece[k] = self._cut(x, chunks, words)
            parts.append(piece)
        new = {c: self.split_chunk(c) for c in self.spaced.missing(chunks)}
        words.update(w for split in new.values() for w in split)
        self.words.update(self.encode_words(self.words.missing(words)))
        known = self.words
        self.spaced.update({c: known[s[0]] if len(s) == 1 else b"".join([known[w] for w in s]) for c, s in new.items()})
        out = [b"".join([x for piece in pieces for x in self._ids(piece)]) for pieces in parts]
        self.spaced.age()
        self.words.age()
        return out

    def split_chunk(self, chunk: str) -> list[str]:
        """Words of a chunk behind a single space; most are letters with at most one mark behind them."""
        if chunk.isalpha():
            return [" " + chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [" " + chunk[:-1], chunk[-1]]
        return self.split_words(" " + chunk)

    def _cut(self, text: str, chunks: set[str], words: set[str]) -> tuple[list[str], list[str]]:
        """A text as (leading words, chunks behind single spaces). Where white space runs touch a space, or at the
        edges, chunks are not independent; such a text is split as a whole."""
        if DEPENDENT(text):
            split, rest = self.split_words(text), []
        else:
            first, *rest = text.split(" ")
            split = self.split_words(first)
        chunks.update(rest)
        words.update(split)
        return split, rest

    def _ids(self, piece) -> Iterable[bytes]:
        if isinstance(piece, int):
            return [array("I", [piece]).tobytes()]
        split, rest = piece
        return [*[self.words[w] for w in split], *map(self.spaced.__getitem__, rest)]

    def decode(self, ids: bytes) -> str:
        """The text of ids given as little-endian unsigned 32-bit integers; ids beyond the vocabulary are left out and
        bytes that are no UTF-8 become U+FFFD."""
        table, size = self.bytes_of, len(self.bytes_of)
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist() if i < size]).decode("utf-8", "replace")


_LOADED: dict[str, TrieBpe] = {}


def encoder(path: str) -> TrieBpe:
    """One encoder, with its caches, per Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = TrieBpe(path)
    return _LOADED[path]


def text_slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows of a batch with about ``most`` bytes of text at a time, and their texts, null ones empty: Python
    objects are made for one slice only, so that a worker's memory does not follow the size of a batch."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.nonzero(np.diff(group))[0] + 1).tolist(), batch.num_rows]
    for begin, end in pairwise(cuts):
        if begin < end:
            part = batch.slice(begin, end - begin)
            yield part, [t or "" for t in part.column(column).to_pylist()]


def map_texts(df: DataFrame, keys: list[str], text: str, fields: list[pa.Field], schema: str, make: Callable) -> DataFrame:
    """Runs ``make(list of texts) -> list of columns`` over all texts; null texts arrive as empty ones.

    One pass without a shuffle; a lost task is simply run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, len(keys)):
                columns = make(texts)
                arrays = [part.column(k) for k in range(len(keys))]
                arrays += [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *[f.name for f in fields]])

    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)
    return df.select(*keys, text).mapInArrow(run, f"{types}, {schema}" if types else schema)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids binary`` (little-endian unsigned 32-bit) of every row's whole text; a null text is empty.

    Repeated rows and null keys are encoded like any other; further columns are dropped.
    """
    return map_texts(df, [key], text, [pa.field("ids", pa.binary())], "ids binary", lambda t: [encoder(path).encode_batch(t)])


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of every row's ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encoder(path).decode(b or b"") for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: every text encoded, its ids decoded again, both as digests.

    Both steps run in one pass over a batch, so ids are never shuffled or stored.
    """
    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]

    def make(texts: list[str]) -> list[list]:
        bpe = encoder(path)
        ids = bpe.encode_batch(texts)
        return [
            [len(x) // 4 for x in ids],
            [hashlib.sha256(x).hexdigest() for x in ids],
            [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids],
        ]

    return map_texts(df, [key], text, fields, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
