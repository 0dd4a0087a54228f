"""Counting the tokens of a unigram tokenizer without making them.

Method: an Aho-Corasick automaton over the vocabulary enumerates all pieces in a word; dynamic programming carries the best
score and the number of pieces for every end, and keeps no back pointers. Ties go as in the unigram model of the tokenizers
library: of equal scores the piece that starts first wins, and a piece wins over an unknown character. Words repeat, so
counts are kept in a bounded cache per Python worker.

The vocabulary is read from a public sentencepiece file: its ordinary pieces, scored by how early they stand in it. A
character without a piece of its own costs the library's penalty and counts as its UTF-8 bytes, which the vocabulary holds.
"""

from __future__ import annotations

import math

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from reelweave.llm.bpe import map_texts
from reelweave.llm.common import TwoGenerations

SPACE = "▁"  # stands for a space in the vocabulary
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 300_000


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece file in its order, as a unigram vocabulary: unknown, control and byte pieces score 0,
    the n-th ordinary piece the logarithm of 1 / (n + 1)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out, n = [], 0
    for i in range(model.get_piece_size()):
        ordinary = not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
        n += ordinary
        out.append((model.id_to_piece(i), -math.log(n + 1) if ordinary else 0.0))
    return out


class UnigramCounter:
    """Counts tokens as a unigram tokenizer does that marks every space, and the begin of a text, with ``SPACE``."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.pieces = ahocorasick.Automaton()
        self.singles = {p for p, _ in vocabulary if len(p) == 1}
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.counts = TwoGenerations(CACHE_WORDS)

    def count_word(self, word: str) -> int:
        size = len(word)
        best: list[float | None] = [None] * (size + 1)
        count = [0] * (size + 1)
        best[0] = 0.0
        at = 0  # ends before this one are settled
        for end, (length, score) in self.pieces.iter(word):  # by end, longest first
            end += 1
            while at < end - 1:
                at += 1
                self._settle(word, at, best, count)
            before = best[end - length]
            if before is not None:
                total = before + score
                known = best[end]
                if known is None or total > known:
                    best[end], count[end] = total, count[end - length] + 1
        while at < size:
            at += 1
            self._settle(word, at, best, count)
        return count[size]

    def _settle(self, word: str, end: int, best: list, count: list) -> None:
        """The unknown character that ends here, if it has no piece, comes after all pieces with this end."""
        letter = word[end - 1]
        if letter not in self.singles and best[end - 1] is not None:
            total = best[end - 1] + self.unknown
            if best[end] is None or total > best[end]:
                best[end], count[end] = total, count[end - 1] + len(letter.encode())

    def count_batch(self, texts: list[str]) -> list[int]:
        cut, words = [], set()
        for text in texts:
            parts = text.replace(SPACE, " ").split(" ") if text else []
            if parts and not parts[0]:
                del parts[0]  # a text that begins with a space gets no further mark
            cut.append(parts)
            words.update(parts)
        self.counts.update({w: self.count_word(SPACE + w) for w in self.counts.missing(words)})
        known = self.counts.__getitem__
        out = [sum(map(known, parts)) for parts in cut]
        self.counts.age()
        return out


_LOADED: dict[str, UnigramCounter] = {}


def counter(path: str) -> UnigramCounter:
    """One counter, with its cache, per Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = UnigramCounter(unigram_vocabulary(path))
    return _LOADED[path]


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens`` of every row's whole text; null and empty texts have none.

    Repeated rows and null keys are counted like any other; further columns are dropped. One pass without a shuffle.
    """
    field = pa.field("n_tokens", pa.int64())
    return map_texts(df, [key], text, [field], "n_tokens bigint", lambda texts: [counter(path).count_batch(texts)])
