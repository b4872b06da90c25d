"""Suffix-array dedup by a distributed merge sort that knows common prefixes.

Suffixes start at the anchors of repeated contexts (see ``repeats``), so that every window
that can be repeated is a stretch of one suffix and of the text before its anchor. Each task
sorts its suffixes into runs and front-codes them: a suffix is sent as the length of the prefix it
shares with the one before, and the rest. A part of the seeds is merged by a loser tree
that compares two suffixes only beyond the prefix both are known to share with the last one
put out. The merged order and its common prefixes are a suffix array of the part, in which windows
that occur twice are read off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitygate.llm import repeats
from qualitygate.llm.repeats import Base, Bytes, factored_spans, flagged_contexts, repeated_seeds, without_spans

#: Bytes of a seed, and occurrences that one part should hold.
SEED, PART = 64, 30_000

RUN_SCHEMA = "part long, prefixes array<int>, rests binary, rights array<int>, befores binary, lefts array<int>, times array<int>, rows array<long>, firsts array<long>"


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, looking only beyond the ``known`` one."""
    end = min(len(a), len(b))
    while known + 64 <= end and a[known : known + 64] == b[known : known + 64]:
        known += 64
    x, y = a[known : min(known + 64, end)], b[known : min(known + 64, end)]
    different = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return known + len(x) - (different.bit_length() + 7) // 8


def _run_rows(found: dict, parts: int) -> pa.RecordBatch:
    """Sorted, front-coded runs: one row per part of the seeds."""
    by_part: dict[int, list] = {}
    for (part, right, before), places in found.items():
        by_part.setdefault(part, []).append((right, before, places))
    out = []
    for part, own in by_part.items():
        own.sort(key=lambda x: x[:2])
        last, prefixes, rests = b"", [], []
        for right, _, _ in own:
            n = common_prefix(last, right)
            prefixes.append(n)
            rests.append(right[n:])
            last = right
        places = [p for x in own for p in x[2]]
        out.append((part, prefixes, b"".join(rests), [len(x[0]) for x in own], b"".join(x[1] for x in own), [len(x[1]) for x in own], [len(x[2]) for x in own], [p[0] for p in places], [p[1] for p in places]))
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    types = (pa.int64(), ints, pa.binary(), ints, pa.binary(), ints, ints, longs, longs)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(types), types, strict=True)], names=[f.split()[0] for f in RUN_SCHEMA.split(", ")])


def _runs(length: int, k: int, parts: int):
    def run(docs, flags):
        found: dict[tuple, list] = {}
        for row, own, first, last, anchor, seed, _ in flagged_contexts(docs, flags, Bytes, length, k, 1, 1):
            for f, z, a, part in zip(first.tolist(), last.tolist(), anchor.tolist(), (seed % parts).tolist(), strict=True):
                found.setdefault((part, own[a : z + length], own[f:a][::-1]), []).append((row, f))
        return pa.Table.from_batches([_run_rows(found, parts)])

    return run


class Run:
    """One sorted run, decoded as it is read."""

    def __init__(self, row: dict):
        self.row, self.at, self.head, self.prefix = row, -1, b"", 0
        self.rest = self.before = self.place = 0

    def step(self) -> bool:
        """To the next suffix; ``prefix`` is what it shares with the last one."""
        row = self.row
        if self.at >= 0:
            self.before += row["lefts"][self.at]
            self.place += row["times"][self.at]
        self.at += 1
        if self.at == len(row["rights"]):
            return False
        self.prefix = row["prefixes"][self.at]
        n = row["rights"][self.at] - self.prefix
        self.head = self.head[: self.prefix] + row["rests"][self.rest : self.rest + n]
        self.rest += n
        return True


def merge(runs: list[Run]):
    """(run, common prefix with the suffix before) in sorted order, by a loser tree.

    Of two heads, both compared with the last winner, the one that shares more with it is
    smaller; only if they share equally much are bytes compared, from there on.
    """
    if not runs:
        return
    n = 1 << (len(runs) - 1).bit_length()
    heads: list[Run | None] = [r if r.step() else None for r in runs] + [None] * (n - len(runs))
    for head in heads:
        if head:
            head.prefix = 0

    def duel(a, b):
        """The winner and the loser, whose prefix then holds against the winner."""
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        if a.prefix != b.prefix:
            return (a, b) if a.prefix > b.prefix else (b, a)
        shared = common_prefix(a.head, b.head, a.prefix)
        if a.head[shared : shared + 1] <= b.head[shared : shared + 1]:
            b.prefix = shared
            return a, b
        a.prefix = shared
        return b, a

    losers: list[Run | None] = [None] * n
    leaf = {id(h): n + i for i, h in enumerate(heads) if h}
    winners: list[Run | None] = [None] * n + heads
    for i in range(n - 1, 0, -1):
        winners[i], losers[i] = duel(winners[2 * i], winners[2 * i + 1])
    winner = winners[1]
    while winner:
        yield winner, winner.prefix
        i = leaf[id(winner)] // 2
        if not winner.step():
            winner = None
        while i:
            winner, losers[i] = duel(winner, losers[i])
            i //= 2


def _order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each string when sorted, and the common prefix of each in that order with the one before."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, np.array([0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)])


def repeated_windows(rights: list[bytes], shared: list[int], befores: list[bytes], times: np.ndarray, length: int, k: int) -> list[np.ndarray]:
    """For each suffix, which windows occur twice; the suffixes are in sorted order, ``shared`` are their common prefixes.

    A window d bytes before the anchor is repeated if another suffix agrees in length - d bytes,
    so in a stretch of the order without a smaller common prefix, and its text before agrees in d bytes.
    """
    right, left = np.array([len(r) for r in rights]), np.array([len(b) for b in befores])
    flags = [np.full(r + b - length + 1, t > 1) for r, b, t in zip(right.tolist(), left.tolist(), times.tolist(), strict=True)]
    shared_right = np.array(shared)
    rank, shared_left = _order(befores)
    # Alone with its seed, a suffix cannot share a window.
    seed = np.cumsum(shared_right < k)
    crowd = np.bincount(seed)[seed] > 1
    for d in range(int(left[crowd].max()) + 1 if crowd.any() else 0):
        own = np.flatnonzero(crowd & (left >= d) & (right >= length - d))
        if len(own) < 2:
            continue
        names = np.cumsum(shared_right < length - d)[own] * (len(rights) + 1) + np.cumsum(shared_left < d)[rank[own]]
        _, back, n = np.unique(names, return_inverse=True, return_counts=True)
        for i in own[(n[back] > 1) & (times[own] == 1)].tolist():
            flags[i][left[i] - d] = True
    return flags


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def _merged_part(rows: list[dict], length: int, k: int) -> pa.RecordBatch | None:
    """(row, start, stop) of the repeated stretches of a part of the seeds."""
    known: dict[tuple[bytes, bytes], int] = {}
    rights, befores, shared, places = [], [], [], []
    least = 0
    for run, prefix in merge([Run(r) for r in rows]):
        least = min(least, prefix) if rights else 0
        row, at = run.row, run.at
        before = row["befores"][run.before : run.before + row["lefts"][at]]
        own = [(row["rows"][j], row["firsts"][j]) for j in range(run.place, run.place + row["times"][at])]
        i = known.setdefault((run.head, before), len(rights))
        if i < len(rights):
            places[i] += own
            continue
        rights.append(run.head)
        befores.append(before)
        shared.append(least)
        places.append(own)
        least = len(run.head)
    out = []
    times = np.array([len(p) for p in places])
    for i, flags in enumerate(repeated_windows(rights, shared, befores, times, length, k)):
        stretches = _stretches(flags)
        out += [(row, first + a, first + b + length) for row, first in places[i] for a, b in stretches]
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["row", "start", "stop"])


def _merge_parts(length: int, k: int):
    def run(batches):
        part, rows = None, []
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["part"] != part:
                    if rows and (out := _merged_part(rows, length, k)):
                        yield out
                    part, rows = row["part"], []
                rows.append(row)
        if rows and (out := _merged_part(rows, length, k)):
            yield out

    return run


def drop_repeated_bytes(docs: DataFrame, length: int = 400, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_units (bytes), spans (removed bytes, as maximal runs) and kept (the other bytes).

    A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else, in the
    same text or another; strings do not cross texts, overlaps count, and strings are judged on the
    input. Null and empty texts have no bytes; rows with null or repeated ids are texts of
    their own; an empty table gives no rows. Seeds with more than ``repeats.HOT_SEED``
    occurrences do not go to one task: they are factored in shares with an exact count of
    windows instead, to the same result.
    """
    k = min(SEED, length)
    base = Base(docs, text, key)
    seeds, flags = repeated_seeds(base, Bytes, length, k)
    usual, hot = seeds.agg(F.sum(F.when(F.col("n") <= repeats.HOT_SEED, F.col("n"))), F.max("n")).first()
    parts = max(1, -(-(usual or 0) // PART))
    runs = base.meet(flags, _runs(length, k, parts), RUN_SCHEMA)
    spans = runs.repartition("part").sortWithinPartitions("part").mapInArrow(_merge_parts(length, k), "row long, start long, stop long")
    if (hot or 0) > repeats.HOT_SEED:
        spans = spans.union(factored_spans(base, flags, Bytes, length, k, 2))
    return without_spans(base, spans, Bytes)
