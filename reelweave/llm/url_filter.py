"""URL filter rules as one bit-parallel wildcard automaton.

Method: every rule is a glob over the canonical URL. The places between a glob's symbols are bits; the bits of all globs stand
next to each other in words of 64 bits. One character moves all rules at once (Shift-And): the state is shifted by one bit,
masked by the places that may be entered with this character, and joined with the places whose wildcard lets it pass. All URLs
of a slice take this step together, so the cost of a character grows with the number of words and not with the number of rules
that still fit. A URL leaves the run once only places are left that any further character keeps.

The canonical URL is a dot, the host, and the path: ``.blog.example.org/en/1``. In a glob ``*`` stands for any run of characters
without a slash, ``**`` for any run, ``?`` for one character but a slash, a backslash takes the next character as it is, and
all else stands for itself. The whole URL must fit. The rules are configuration: they travel with the tasks, and their
number is limited by ``MAX_BITS``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 20
SLICE_CHARACTERS = 1 << 19
SLICE_WORDS = 1 << 21  # state words of the URLs that run together
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE, RUN, ANY = object(), object(), object()  # the symbols ?, * and **


class Rule(NamedTuple):
    name: str
    glob: str
    verdict: str
    length: int  # of several rules that fit, the one of the largest length decides; of equal ones the first


def escaped(text: str) -> str:
    return "".join("\\" + c if c in "\\*?" else c for c in text)


def prefix_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """A rule for the host and all its subdomains, and all paths that begin with the path."""
    return Rule(host + path, f"*.{escaped(host)}{escaped(path)}**", verdict, len(host) + len(path))


def symbols(glob: str) -> list:
    """The glob as characters and wildcards; runs of wildcards are brought to one."""
    out, k = [], 0
    while k < len(glob):
        if glob[k] == "\\":
            if k + 1 == len(glob):
                raise ValueError(f"a glob ends in a backslash: {glob}")
            out.append(glob[k + 1])
            k += 2
        elif glob[k] == "*":
            end = k
            while end < len(glob) and glob[end] == "*":
                end += 1
            out.append(RUN if end - k == 1 else ANY)
            k = end
        else:
            out.append(ONE if glob[k] == "?" else glob[k])
            k += 1
    return out


class WildcardAutomaton:
    """All rules as masks over words of 64 bits, by class of character."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = list(rules)
        steps: list[tuple[int, object]] = []  # bit, symbol that enters it
        loops: list[tuple[int, object]] = []  # bit, wildcard that keeps it
        starts, ends = [], []
        bit = 0
        for rule in self.rules:
            starts.append(bit)
            for symbol in symbols(rule.glob):
                if symbol is RUN or symbol is ANY:
                    loops.append((bit, symbol))
                else:
                    bit += 1
                    steps.append((bit, symbol))
            ends.append(bit)
            bit += 1
        if bit > MAX_BITS:
            raise ValueError(f"the rules take {bit} bits, more than {MAX_BITS}")
        self.words = max(1, -(-bit // 64))
        letters = sorted({ord(s) for _, s in steps if isinstance(s, str)} | {ord("/")})
        self.alphabet = np.array(letters, dtype=np.uint32)
        slash = letters.index(ord("/")) + 1
        classes = len(letters) + 1  # class 0 is every character that no rule names
        self.enter = np.zeros((classes, self.words), np.uint64)
        self.stay = np.zeros((classes, self.words), np.uint64)
        for at, symbol in steps:
            chosen = [c for c in range(classes) if c != slash] if symbol is ONE else [letters.index(ord(symbol)) + 1]
            self.enter[chosen, at >> 6] |= np.uint64(1 << (at & 63))
        for at, symbol in loops:
            chosen = [c for c in range(classes) if symbol is ANY or c != slash]
            self.stay[chosen, at >> 6] |= np.uint64(1 << (at & 63))
        self.start = self._bits(starts)
        self.final = self._bits(ends)
        # places that every character keeps and none leaves: the ends of globs that end in **
        self.settled = self._bits([at for at, symbol in loops if symbol is ANY and at in set(ends)])
        self.best = np.full(self.words * 64, -1, np.int64)  # rank of the rule that ends in a bit, the larger the stronger
        self.order = sorted(range(len(self.rules)), key=lambda k: (self.rules[k].length, -k))
        for rank, k in enumerate(self.order):
            self.best[ends[k]] = rank

    def _bits(self, places: list[int]) -> np.ndarray:
        mask = np.zeros(self.words, np.uint64)
        for at in places:
            mask[at >> 6] |= np.uint64(1 << (at & 63))
        return mask

    def match(self, urls: list[str]) -> list[int | None]:
        """The number of the rule that decides each canonical URL, None where no rule fits."""
        out: list[int | None] = []
        most = max(1, SLICE_WORDS // self.words)
        at = 0
        while at < len(urls):
            end, characters = at, 0
            while end < len(urls) and end - at < most and (end == at or characters + len(urls[end]) <= SLICE_CHARACTERS):
                characters += len(urls[end])
                end += 1
            out += self._match_slice(urls[at:end])
            at = end
        return out

    def _match_slice(self, urls: list[str]) -> list[int | None]:
        points = np.frombuffer("".join(urls).encode("utf-32-le"), dtype="<u4")
        found = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        classes = np.where(self.alphabet[found] == points, found + 1, 0).astype(np.int32)
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        offsets = np.cumsum(lengths) - lengths
        states = np.tile(self.start, (len(urls), 1))
        active, step = np.arange(len(urls)), 0
        while len(active := active[lengths[active] > step]):
            c = classes[offsets[active] + step]
            old = states[active]
            new = old << np.uint64(1)
            new[:, 1:] |= old[:, :-1] >> np.uint64(63)
            new &= self.enter[c]
            new |= old & self.stay[c]
            states[active] = new
            active = active[(new & ~self.settled).any(axis=1)]
            step += 1
        return self._decide(states & self.final)

    def _decide(self, ended: np.ndarray) -> list[int | None]:
        ranks = np.full(len(ended), -1, np.int64)
        for w in np.nonzero(ended.any(axis=0))[0].tolist():
            rows = np.nonzero(ended[:, w])[0]
            bits = np.unpackbits(ended[rows, w].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ranks[rows] = np.maximum(ranks[rows], np.where(bits == 1, self.best[w * 64 : w * 64 + 64], -1).max(axis=1))
        return [None if r < 0 else self.order[r] for r in ranks.tolist()]


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` of every row: the strongest rule that fits and its verdict.

    Where no rule fits, the rule is null and the verdict is ``default``. A null URL, one without ``://`` and an empty one have an
    empty host and path, which only a glob without dots and letters could fit. Hosts keep ports and user names. Rows with null
    or repeated keys are judged each by itself; very long URLs are taken whole; further columns are dropped. Without rules
    all verdicts are ``default``; an empty table gives an empty one. One pass, no shuffle.
    """
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"))
    rows = rows.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WildcardAutomaton(rules)
        for batch in batches:
            hosts, paths = (batch.column(k).to_pylist() for k in (1, 2))
            found = automaton.match(["." + host + path for host, path in zip(hosts, paths, strict=True)])
            names = [None if k is None else rules[k].name for k in found]
            verdicts = [default if k is None else rules[k].verdict for k in found]
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "host", "path", "rule", "verdict"])

    judged = rows.mapInArrow(run, f"key {kind}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("key", key) if key != "key" else judged
