import random

import numpy as np
import pytest

from qualitygate.llm import repeats, suffix_dedup
from qualitygate.llm.repeats import Bytes, Words, contexts, removed
from qualitygate.llm.substring_dedup import drop_repeated_words
from qualitygate.llm.suffix_dedup import Run, _run_rows, common_prefix, drop_repeated_bytes, merge

SCHEMA = "doc_id long, text string, row int, seed string, start int"


def brute(units: list, length: int) -> list[list[bool]]:
    seen: dict = {}
    for i, own in enumerate(units):
        for a in range(len(own) - length + 1):
            seen.setdefault(tuple(own[a : a + length]), []).append((i, a))
    gone = [[False] * len(u) for u in units]
    for places in seen.values():
        if len(places) > 1:
            for i, a in places:
                gone[i][a : a + length] = [True] * length
    return gone


def corpus(rnd, n, size, alphabet):
    shared = ["".join(rnd.choice(alphabet) for _ in range(size)) for _ in range(4)]
    texts = [None, "", "a", "é" * size]
    for i in range(n):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(2 * size)))
        if i % 2:
            passage = rnd.choice(shared)
            cut = passage[rnd.randrange(size // 2) :]
            text = text + cut + ("" if i % 3 else rnd.choice(alphabet) + rnd.choice(shared))
        if i % 7 == 0:
            text += rnd.choice(alphabet) * size + " xy" * size
        texts.append(text)
    return [*texts, texts[5], texts[5], texts[6] + "!"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i if i % 9 else None, t, 1, "s", 2) for i, t in enumerate(texts)], SCHEMA)


def check(got, units, gone, key):
    want = []
    for i, (own, flags) in enumerate(zip(units, gone, strict=True)):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.array(flags, int), [0]])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        want.append((i if i % 9 else -1, len(own), spans, key([u for u, f in zip(own, flags, strict=True) if not f])))
    have = [(-1 if r.doc_id is None else r.doc_id, r.n_units, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in got]
    assert sorted(have) == sorted(want)


@pytest.mark.parametrize(("seed", "hot"), [(1, 20_000), (2, 3), (3, 2)])
def test_bytes_against_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT_SEED", hot)
    monkeypatch.setattr(suffix_dedup, "SEED", 6)
    monkeypatch.setattr(suffix_dedup, "PART", 50)
    texts = corpus(random.Random(seed), 40, 60, "ab \n")
    units = [list((t or "").encode()) for t in texts]
    got = drop_repeated_bytes(docs_of(spark, texts), 20).collect()
    check(got, units, brute(units, 20), bytes)


@pytest.mark.parametrize(("seed", "hot"), [(1, 20_000), (2, 3)])
def test_words_against_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT_SEED", hot)
    monkeypatch.setattr(repeats, "LEAST_SHARE", 1)
    texts = corpus(random.Random(seed), 40, 80, "ab \n\t")
    units = [(t or "").encode().split() for t in texts]
    got = drop_repeated_words(docs_of(spark, texts), 10).collect()
    check(got, units, brute(units, 10), b" ".join)


def test_chimeras_of_two_sources_and_sources_in_one_text(spark):
    a, b = ["".join(random.Random(s).choice("abcdefgh") for _ in range(500)) for s in (1, 2)]
    texts = [a, b, a[-300:] + b[:300], a[:450] + "x" + a[:450], a[100:499], a[100:500], "y" + b[50:480] + "z", b[50:480]]
    units = [list(t.encode()) for t in texts]
    check(drop_repeated_bytes(docs_of(spark, texts), 400).collect(), units, brute(units, 400), bytes)


def test_empty_table_and_lengths(spark):
    docs = docs_of(spark, ["a b"])
    assert drop_repeated_bytes(docs.limit(0)).count() == drop_repeated_words(docs.limit(0)).count() == 0
    assert drop_repeated_bytes(docs).select(removed()).first()[0] == 0


@pytest.mark.parametrize("units", [Bytes, Words])
def test_contexts_hold_every_window_once_and_depend_on_content(units):
    rnd = random.Random(3)
    raw = ["".join(rnd.choice("ab ") for _ in range(rnd.randrange(300))).encode() for _ in range(30)]
    text, anchor, first, last, seed = contexts(units, raw, 12, 4)
    held = [(t, w) for t, f, z in zip(text, first, last, strict=True) for w in range(f, z + 1)]
    assert sorted(held) == [(t, w) for t, r in enumerate(raw) for w in range(len(units.units(r)) - 11)]
    by_window: dict = {}
    for t, a, f, z, s in zip(text, anchor, first, last, seed, strict=True):
        assert f <= a and a + 4 <= z + 12 and a + 4 <= f + 12
        for w in range(f, z + 1):
            by_window.setdefault(tuple(units.units(raw[t])[w : w + 12]), set()).add((a - w, s))
    assert all(len(v) == 1 for v in by_window.values())


def test_merge_gives_sorted_order_and_common_prefixes():
    rnd = random.Random(4)
    for _ in range(200):
        runs, every = [], []
        for _ in range(rnd.randrange(1, 9)):
            own = {(0, bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 9))), b""): [(1, 2)] for _ in range(rnd.randrange(1, 12))}
            every += [r for _, r, _ in own]
            runs.append(Run(_run_rows(own, 1).to_pylist()[0]))
        got = [(run.head, prefix) for run, prefix in merge(runs)]
        assert [g[0] for g in got] == sorted(every)
        assert [g[1] for g in got[1:]] == [common_prefix(x[0], y[0]) for x, y in zip(got, got[1:], strict=False)]
