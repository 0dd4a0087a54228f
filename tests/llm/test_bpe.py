"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from reelweave.llm import bpe
from reelweave.llm.queries import QUERIES, vocabulary
from tokenizers import Tokenizer

PATH = vocabulary("byte_bpe_50k.json")
ODD = [
    "", "a", " a", "  a", "a  b", "a \n b", "\n\n", "x<|endoftext|>y <|endoftext|>", "<|endoftext|>", "é ü 漢字 テスト", "😀 😀😀",
    "I'll don't 've", "a" * 3000, "   ", "　 a", "a՘b ꟎ x", "\x1c\x1d a\x85b", "tab\tb \t c", " lead", "trail ", "==== ____ ----",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)

    def encode(texts):
        return [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    encode.decode = lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
    return encode


def test_same_ids_as_the_library(library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab the in.\n é'sllr0129\t-_漢") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    assert bpe.encoder(PATH).encode_batch(texts) == library(texts)


def test_every_token_is_its_own_encoding(library):
    coder = bpe.encoder(PATH)
    whole = [b.decode() for b in coder.bytes_of if b.decode("utf-8", "ignore").encode() == b]
    assert coder.encode_batch(whole) == library(whole)


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 5)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "MEMO", 10)
    coder = bpe.TrieBpe(PATH)
    for _ in range(3):
        for text in ODD:
            assert coder.encode_batch([text, "some more words, and more"]) == library([text, "some more words, and more"])


def test_decode_of_odd_ids(library):
    ids = [0, 250, 251, 50256, 199, 14, 222]
    assert bpe.encoder(PATH).decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids)
    assert bpe.encoder(PATH).decode(np.array([7, 99_999], dtype="<u4").tobytes()) == library.decode([7])


def test_frames(spark, table, values):
    rows = table("doc_id BIGINT, text STRING, ids STRING", (1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "y"))
    ids = bpe.encode(rows, PATH)
    assert ids.columns == ["doc_id", "ids"] and ids.count() == 4
    assert values(bpe.decode(ids, PATH)) == [(1, "a b"), (1, "a b"), (2, ""), (None, "")]
    empty = hashlib.sha256(b"").hexdigest()
    assert (None, 0, empty, empty) in values(bpe.round_trip(rows, PATH))
    assert bpe.round_trip(rows.limit(0), PATH).count() == 0


def test_query_on_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op2_bpe_encode_decode"](spark, folder).collect()}
    want = dict(zip(texts, library(list(texts.values())), strict=True))
    assert got == {
        k: (len(w) // 4, hashlib.sha256(w).hexdigest(), hashlib.sha256(texts[k].encode()).hexdigest()) for k, w in want.items()
    }
