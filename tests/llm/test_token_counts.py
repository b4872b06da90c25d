import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from qualitygate.llm import token_counts as tc

FILE = P.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "don't  stop\n\n 's it's X'LL", "<|endoftext|>", "a <|endoftext|>b<|endoftext|><|endof", "é日本語 ½ \x00\x1c　 x", "word " * 20000, "z" * 5000, "ab" * 3000, "a", "\n", "tail \n "]


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(FILE).encode_batch(texts, add_special_tokens=False)]


def test_counts_against_the_library(spark):
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choice("  \n'<|>endoftxtéß日Z19.,s") for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    docs = spark.createDataFrame([(i if i != 1 else None, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, n_bytes string")
    got = {r.doc_id if r.doc_id is not None else 1: r for r in tc.token_counts(docs.repartition(3), FILE, limit=50).collect()}
    want = library([t or "" for t in texts])
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert [got[i].over_limit for i in range(len(texts))] == [n > 50 for n in want]
    assert tc.token_counts(docs.limit(0), FILE).count() == 0
    assert tc.token_counts(docs.where("doc_id = 3").union(docs.where("doc_id = 3")), FILE).count() == 2


def test_whole_documents_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    got = {r.doc_id: r.n_tokens for r in tc.token_counts(docs, FILE).collect()}
    assert [got[r.doc_id] for r in rows] == library([r.text or "" for r in rows])


def test_words_forgotten_and_met_again(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 8)
    monkeypatch.setattr(tc, "LONG", 6)
    memory, rnd = tc._Remembered(tc.merges_of(FILE)), random.Random(1)
    for _ in range(200):
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(6)]
        assert memory.counts(words).tolist() == library(words)
        assert len(memory.recent) <= 4 + 6


def test_leftmost_of_equal_pairs_goes_first():
    a, b = 0, 1
    merges = tc.Merges([a] * 256, {a << tc.SYMBOL | a: b}, None)
    assert [tc.count_merged(b"x" * n, merges) for n in range(6)] == [0, 1, 1, 2, 2, 3]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tc.merges_of(P.path("word_bpe_49k.json"))
