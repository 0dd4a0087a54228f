"""Count-only Viterbi against the unigram model of the tokenizers library."""

import random

from reelweave.llm import token_count as tc
from reelweave.llm.queries import QUERIES, vocabulary
from tokenizers import Tokenizer, models, pre_tokenizers

PATH = vocabulary("piece_bpe_32k.model")


def library(pieces):
    tokenizer = Tokenizer(models.Unigram(pieces, 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_same_counts_as_the_library():
    rng = random.Random(2)
    pieces = tc.unigram_vocabulary(PATH)
    texts = ["", " ", "  ", " a", "a", "  a b ", "漢字 テスト 😀😀x", "a▁b", "▁", "\n\n x\ty", "աբգ ꟎꟎", " " * 7, "x" * 500, "▁▁a"]
    texts += ["".join(rng.choice("ab the in.\n é'sllr0129\t-_漢𐐷▁") for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    assert tc.UnigramCounter(pieces).count_batch(texts) == library(pieces)(texts)


def test_ties_and_unknown_characters():
    bytes_ = [(f"<0x{k:02X}>", 0.0) for k in range(256)]
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("ab", -2.5), ("b", -1.5), ("▁a", -2.0), *bytes_]
    rng = random.Random(3)
    texts = ["".join(rng.choice("aab zé") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert tc.UnigramCounter(pieces).count_batch(texts) == library(pieces)(texts)


def test_frames(spark, table, values, monkeypatch):
    rows = table("doc_id BIGINT, text STRING, n_tokens STRING", (1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "y"))
    counted = tc.count_tokens(rows, PATH)
    assert values(counted) == [(1, 2), (1, 2), (2, 0), (None, 0)]
    assert tc.count_tokens(rows.limit(0), PATH).count() == 0
    monkeypatch.setattr(tc, "CACHE_WORDS", 2)
    pieces, texts = tc.unigram_vocabulary(PATH), ["some words are here", "some more words"]
    small = tc.UnigramCounter(pieces)
    assert [small.count_batch(texts) for _ in range(3)] == [library(pieces)(texts)] * 3


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(texts, library(tc.unigram_vocabulary(PATH))(list(texts.values())), strict=True))
    assert {r.doc_id: r.n_tokens for r in QUERIES["op9_token_count"](spark, folder).collect()} == want
