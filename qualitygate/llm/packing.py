"""Best-fit packing of token pieces into sequences by linear grouping.

Lengths are at most the capacity, so the histogram of lengths has a fixed size whatever the
amount of data: the search runs on it alone. Large lengths are rounded up within groups of
equal cardinality; a linear program over configurations of the few rounded sizes says how
often to use each; actual lengths are put into the configurations, and all other pieces go
by best fit into what space is left. The result is a table of runs (so many pieces of one
length, from sequence s on, at offset o) that each piece is looked up in.
"""

from __future__ import annotations

import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.llm.common import spool, text_of
from qualitygate.llm.pretokens import byte_signs, split, text_blocks

#: Groups of large lengths; lengths over 1 / LARGE of the capacity are large.
GROUPS, LARGE = 250, 3
#: Words whose ids a Python worker remembers; those over ``LONG`` characters are encoded anew each time.
REMEMBERED, LONG = 1_000_000, 100
#: Runs that are sent to all tasks; more of them are joined by a shuffle.
SENT_RUNS = 1_000_000


class _Words:
    """The ids of pre-tokens, as little-endian bytes, in two halves: when the recent one is full the older one goes, but for what came again."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model, self.signs = Tokenizer.from_file(path).model, dict(enumerate(byte_signs()))
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encoded(self, word: str) -> bytes:
        """Special strings are ordinary text here: the model sees pre-tokens only."""
        signs = word.encode().decode("latin-1").translate(self.signs)
        return np.array([t.id for t in self.model.tokenize(signs)], "<u4").tobytes()

    def ids(self, words: list[str]) -> list[bytes]:
        if len(self.recent) > REMEMBERED // 2:
            self.recent, self.older = {}, self.recent
        known, long = self.recent, {}
        found = list(map(known.get, words))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = known.get(word) or long.get(word)
            if ids is None:
                ids = self.older.get(word) or self.encoded(word)
                (known if len(word) <= LONG else long)[word] = ids
            found[i] = ids
        return found


@lru_cache(2)
def _words(path: str) -> _Words:
    return _Words(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each document's ids and then ``end_id``, cut into pieces of ``capacity``; the first piece may be shorter.

    Written to the shared folder as doc_id, piece, start, length, ids_crc32, part, nth: ``nth``
    numbers the pieces of one length within the task ``part`` that made them. A null or empty
    text is one piece of one id. Null and repeated doc_ids are rows like any other.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32", "part", "nth")]])
    arrow = T.StructType(schema.fields)

    def cut(batches):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        shape, part, seen = to_arrow_schema(arrow), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        last, words_of = np.array([end_id], "<u4").tobytes(), _words(tokenizer)
        for batch, texts in text_blocks(batches, 1_000_000):
            words, counts = split(texts)
            found = words_of.ids(words)
            rows, a = [], 0
            for i, n in enumerate(counts.tolist()):
                ids = b"".join(found[a : a + n]) + last
                a += n
                total = len(ids) // 4
                first = total % capacity or capacity
                start = 0
                for piece, stop in enumerate(range(first, total + 1, capacity)):
                    rows.append((i, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), part, seen[stop - start]))
                    seen[stop - start] += 1
                    start = stop
            owner, *numbers = np.array(rows, np.int64).reshape(-1, 7).T
            ids_of = batch.column("doc_id").take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([ids_of, *[pa.array(np.ascontiguousarray(x)) for x in numbers]], schema=shape)

    rows = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))
    return spool(rows.mapInArrow(cut, schema), "pieces")


def _configurations(sizes: list[int], capacity: int) -> np.ndarray:
    """All multisets of sizes that fit into one sequence, one per row: their members, filled up with ``len(sizes)``."""
    found: list[list[int]] = []

    def extend(members, first, room):
        if members:
            found.append(members)
        for g in range(first, len(sizes)):
            if sizes[g] <= room:
                extend([*members, g], g, room - sizes[g])

    extend([], 0, capacity)
    most = max(map(len, found))
    return np.array([m + [len(sizes)] * (most - len(m)) for m in found], np.int64)


def _solve(sizes: list[int], need: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of configurations near the least sum that covers ``need``: simplex on columns, keeping the inverse of the base.

    Written without matrix products: the threads of a linear algebra library can stop for good in a
    process that has forked, as a driver has when it started its JVM.
    """
    configurations = _configurations(sizes, capacity)
    k = len(sizes)
    inverse = np.diag([1 / (capacity // s) for s in sizes])
    names = [np.array([g] * (capacity // sizes[g])) for g in range(k)]
    level = need / np.array([capacity // s for s in sizes])
    for _ in range(50 * k):
        price = np.append(inverse.sum(axis=0), 0.0)
        gain = price[configurations].sum(axis=1)
        enter = int(gain.argmax())
        if gain[enter] <= 1 + 1e-9:
            break
        members = configurations[enter][configurations[enter] < k]
        step = inverse[:, members].sum(axis=1)
        ratio = np.where(step > 1e-9, level / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratio.argmin())
        row, height = inverse[leave] / step[leave], level[leave] / step[leave]
        inverse -= step[:, None] * row
        level -= step * height
        inverse[leave], level[leave], names[leave] = row, height, members
    return [(np.bincount(m, minlength=k), int(x + 1e-6)) for m, x in zip(names, level, strict=True) if x >= 1 - 1e-6]


class _Bins:
    """Sequences in runs of equal free space, and the pieces put into them."""

    def __init__(self, capacity: int):
        self.capacity, self.next, self.runs = capacity, 0, []
        self.free: dict[int, list[tuple[int, int]]] = {}
        self.given: dict[int, int] = {}

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        first = self.given.get(length, 0)
        self.given[length] = first + n
        self.runs.append((length, first, n, sequence, offset))

    def open(self, n: int) -> int:
        self.next += n
        return self.next - n

    def leave(self, sequence: int, n: int, room: int) -> None:
        if n and room:
            self.free.setdefault(room, []).append((sequence, n))

    def fit(self, length: int, n: int) -> None:
        """Best fit for ``n`` pieces of one length: fullest sequences first, then new ones."""
        room = length
        while n:
            while room <= self.capacity and not self.free.get(room):
                room += 1
            if room <= self.capacity:
                sequence, m = self.free[room].pop()
            else:
                per = self.capacity // length
                m, room = -(-n // per), self.capacity
                sequence = self.open(m)
            per = min(room // length, n)
            full = min(m, n // per)
            for i in range(per):
                self.put(length, full, sequence, self.capacity - room + i * length)
            self.leave(sequence, full, room - per * length)
            n -= full * per
            rest = n if n < per and full < m else 0  # one more sequence takes what is left
            for i in range(rest):
                self.put(length, 1, sequence + full, self.capacity - room + i * length)
            n -= rest
            if rest:
                self.leave(sequence + full, 1, room - rest * length)
            self.leave(sequence + full + bool(rest), m - full - bool(rest), room)
            room = length


def _take(portions: deque, n: int) -> list[list[int]]:
    """The next ``n`` pieces of a group, as [length, number] in turn."""
    taken = []
    while n and portions:
        length, m = portions[0]
        used = min(n, m)
        taken.append([length, used])
        n -= used
        if used == m:
            portions.popleft()
        else:
            portions[0] = [length, m - used]
    return taken


def packing_runs(histogram: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int]]:
    """(length, first, n, sequence, offset): pieces first .. first + n - 1 of that length go to sequence, sequence + 1, ..."""
    bins = _Bins(capacity)
    left = {x: n for x, n in histogram.items() if n}
    if n := left.pop(capacity, 0):
        bins.put(capacity, n, bins.open(n), 0)
    large = sorted((x for x in left if x > capacity // LARGE), reverse=True)
    total = sum(left[x] for x in large)
    groups: list[deque] = []
    room = 0
    for x in large:
        n = left.pop(x)
        while n:
            if not room:
                groups.append(deque())
                room = -(-total // GROUPS)
            used = min(n, room)
            groups[-1].append([x, used])
            n, room = n - used, room - used
    if groups:
        sizes = [g[0][0] for g in groups]
        need = np.array([sum(n for _, n in g) for g in groups], float)
        for counts, times in _solve(sizes, need, capacity):
            slots = [deque(_take(groups[g], times)) for g in np.repeat(np.arange(len(sizes)), counts)]
            for i, slot in enumerate(slots):
                if i % 2:
                    slot.reverse()  # the longest of one group next to the shortest of another
            # A configuration covers at most the need, rounded down: slots may be short only by rounding.
            while slots := [s for s in slots if s]:
                m = min(s[0][1] for s in slots)
                sequence, offset = bins.open(m), 0
                for s in slots:
                    bins.put(s[0][0], m, sequence, offset)
                    offset += s[0][0]
                    s[0][1] -= m
                    if not s[0][1]:
                        s.popleft()
                bins.leave(sequence, m, capacity - offset)
    for g in groups:
        for x, n in g:
            left[x] = left.get(x, 0) + n
    for x in sorted(left, reverse=True):
        bins.fit(x, left[x])
    return bins.runs


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` of ``token_pieces`` with sequence_id and offset.

    A sequence holds at most ``capacity`` ids without gaps, from 0. An empty table gives no
    rows. Only the histogram, at most ``capacity`` rows, goes through the driver; the table
    of runs depends on it alone. Pieces of one length are told apart by their number, counted
    per task and summed over tasks, so that no length is gathered in one place.
    """
    made = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    made = spool(made.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "pieces")
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = packing_runs(histogram, capacity)
    table = pieces.sparkSession.createDataFrame(runs or [(0, 0, 0, 0, 0)], "run_length long, first long, run long, sequence long, offset long")
    numbered = pieces.join(made.select("part", "length", "base"), ["part", "length"]).withColumn("number", F.col("base") + F.col("nth"))
    inside = (F.col("length") == F.col("run_length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("run"))
    placed = numbered.join(F.broadcast(table) if len(runs) <= SENT_RUNS else table, inside)
    return placed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", (F.col("sequence") + F.col("number") - F.col("first")).alias("sequence_id"), "offset")
