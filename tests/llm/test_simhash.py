import random

import numpy as np
import pytest
import xxhash

from qualitygate.llm import simhash
from qualitygate.llm.components import components
from qualitygate.llm.simhash import drop_near_copies, fingerprint, near_duplicates, shingle_hashes

SCHEMA = "doc_id long, text string, fingerprint string, component int, kept_row int"


def brute_code(text, words):
    own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        own = own.replace(white, " ")
    own = [w for w in own.split(" ") if w]
    runs = [" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))] if own else []
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, bits):
    label = {c: c for c in codes}
    changed = True
    while changed:
        changed = False
        for a in label:
            least = min(label[b] for b in label if bin(a ^ b).count("1") <= bits)
            changed |= least != label[a]
            label[a] = least
    return label


def texts():
    rnd = random.Random(3)
    pool = [f"w{i}" for i in range(80)]
    out = [None, "", " \t\n", "One", "ONE", "É é  É", "a b c d", "A  b\nc d", "long " * 20000]
    for _ in range(25):
        base = [rnd.choice(pool) for _ in range(300)]
        out.append(" ".join(base))
        for _ in range(3):
            base[rnd.randrange(300)] = "x"
            out.append(" ".join(base))
    return out


@pytest.mark.parametrize("pairwise", [64, 1])
def test_near_duplicates_against_brute_force(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rows = [(i if i != 30 else None, t, "f", 1, 2) for i, t in enumerate(texts())] + [(7, "A  b\nc d", "f", 1, 2)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    codes = {(r[0], r[1]): brute_code(r[1], 4) for r in rows}
    label = brute_components(set(codes.values()), 4)
    least = {}
    for (i, _), c in codes.items():
        if i is not None:
            least[label[c]] = min(i, least.get(label[c], i))
    want = sorted(((-1 if r[0] is None else r[0]), f"{codes[r[0], r[1]]:016x}", least.get(label[codes[r[0], r[1]]])) for r in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert len({r.component_id for r in got}) < len(rows) - 40


def test_one_row_of_each_group_stays(spark):
    rows = [(3, "same words in here twice over", "f", 1, 2), (2, "same words in here twice over", "f", 1, 2), (2, "Same words in here twice over", "f", 1, 2), (None, "quite another text that stands alone", "f", 1, 2), (None, "quite another text that stands alone", "f", 1, 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2]
    assert drop_near_copies(docs.limit(0)).count() == near_duplicates(docs.limit(0)).count() == 0


def test_near_copies_against_brute_force(spark):
    rows = [(i, t, "f", 1, 2) for i, t in enumerate(texts())]
    random.Random(1).shuffle(rows)
    codes = {r[0]: brute_code(r[1], 4) for r in rows}
    label = brute_components(set(codes.values()), 4)
    least: dict = {}
    for i, c in codes.items():
        least[label[c]] = min(i, least.get(label[c], i))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert {r.doc_id for r in drop_near_copies(docs).collect()} == set(least.values())


def test_a_bucket_over_many_batches():
    import pyarrow as pa

    rnd = random.Random(6)
    keys = sorted([1] * 400 + [2] * 3 + [3] * 900 + [4])
    codes = [rnd.getrandbits(64) for _ in keys]
    codes[500] = codes[1200] ^ 5
    whole = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.array(codes, np.uint64).view(np.int64))], names=["key", "fingerprint"])
    for size in (7, 100, 5000):
        pieces = [whole.slice(i, size) for i in range(0, len(keys), size)] + [whole.slice(0, 0)]
        found = [tuple(np.array(list(r.values()), np.int64).view(np.uint64).tolist()) for b in simhash._links(4)(iter(pieces)) for r in b.to_pylist()]
        assert {frozenset(f) for f in found} == {frozenset((codes[500], codes[1200]))}


def test_every_pair_within_reach_shares_a_variant(spark):
    rnd = random.Random(1)
    for bits in (4, 5, 7):
        for _ in range(300):
            a = rnd.getrandbits(64)
            b = a
            for i in rnd.sample(range(64), rnd.randint(0, bits)):
                b ^= 1 << i
            assert any(bin((a ^ b) >> f & (1 << w) - 1).count("1") <= 1 for f, w in simhash._segments(bits))


def test_fingerprint_of_many_hashes():
    rnd = np.random.default_rng(2)
    for n in (1, 254, 255, 256, 1000):
        h = rnd.integers(0, 2**64, n, dtype=np.uint64)
        assert fingerprint(h) == sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > n)
    assert len(shingle_hashes("a b c d e", 4)) == 2


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(-5, -7), (500, 500), (1, 0)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, **{i: 200 for i in range(200, 209)}, -5: -7, -7: -7}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
