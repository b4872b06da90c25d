import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from qualitygate.llm import byte_bpe, packing, pretokens
from qualitygate.llm.packing import packing_runs

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "a", "don't  stop\n\n 's it's X'LL <|endoftext|>", "é日本語 ½ \x00\x1c　 x", "word " * 30000, "z" * 5000, "a", "\n", "tail \n "]
SCHEMA = "doc_id long, text string, ids int, block string"


def table(spark, texts):
    return spark.createDataFrame([(i if i != 1 else None, t, 7, "b") for i, t in enumerate(texts)], SCHEMA)


def test_split_against_the_pattern(monkeypatch):
    rnd, pattern = random.Random(5), regex.compile(P.PATTERN)
    texts = ["".join(rnd.choice(" \n\t'stremvlLdx1²é_!　\x1c #'") for _ in range(rnd.randint(0, 14))) for _ in range(20000)]
    monkeypatch.setattr(pretokens, "CHUNK", 300)
    texts += ["".join(rnd.choice("ab  '\n!s") for _ in range(2000)) for _ in range(20)]
    tokens, counts = pretokens.split(texts)
    assert tokens == [w for t in texts for w in pattern.findall(t)]
    assert counts.tolist() == [len(pattern.findall(t)) for t in texts]


def test_encode_and_decode_against_the_library(spark):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.decode(byte_bpe.encode(table(spark, TEXTS).repartition(2), RANKS), RANKS).collect()
    want = sorted(((i if i != 1 else -1), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(TEXTS))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids, bytes(r.bytes)) for r in got) == want
    at_once = byte_bpe.encode(table(spark, TEXTS).repartition(2), RANKS, decoded=True).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids, bytes(r.bytes)) for r in at_once) == want
    assert byte_bpe.encode(table(spark, TEXTS).limit(0), RANKS).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_runs_place_every_piece_once_without_gaps(seed):
    rnd, histogram = random.Random(seed), {}
    for _ in range(rnd.choice([1, 5, 300, 4000])):
        x = min(100, max(1, int(rnd.choice([rnd.uniform(1, 101), rnd.expovariate(0.1), 60]))))
        histogram[x] = histogram.get(x, 0) + 1
    bins: dict = {}
    placed = set()
    for length, first, n, sequence, offset in packing_runs(histogram, 100):
        for i in range(n):
            assert (length, first + i) not in placed
            placed.add((length, first + i))
            bins.setdefault(sequence + i, []).append((offset, length))
    assert len(placed) == sum(histogram.values())
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 100
    least = -(-sum(x * n for x, n in histogram.items()) // 100)
    assert len(bins) <= least * 1.35 + 2  # of 100 units, where few lengths fit together


def test_real_lengths_fill_nearly_all_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.token_pieces(docs, P.path("byte_bpe_50k.json"))
    histogram = {r.length: r["count"] * 40 for r in pieces.groupBy("length").count().collect()}
    used = max(sequence + n for _, _, n, sequence, _ in packing_runs(histogram))
    assert used <= sum(x * n for x, n in histogram.items()) / 2048 * 1.01 + 1


def test_pieces_and_packing(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    pieces = packing.token_pieces(table(spark, TEXTS), P.path("byte_bpe_50k.json"), capacity=64)
    rows = packing.pack(pieces, 64).collect()
    for i, t in enumerate(TEXTS):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in rows if r.doc_id == (i if i != 1 else None)), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 64 for r in own[1:])
        for r in own:
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    fill: dict = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in fill.values():
        assert [o for o, _ in sorted(own)] == [sum(n for o2, n in own if o2 < o) for o, _ in sorted(own)] and sum(n for _, n in own) <= 64
    empty = packing.token_pieces(table(spark, TEXTS).limit(0), P.path("byte_bpe_50k.json"))
    assert packing.pack(empty).count() == 0
