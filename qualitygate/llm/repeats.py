"""Finding windows of text that occur more than once: what byte and word dedup share.

A window of ``length`` units (bytes or words) has one anchor, the least of the hashed grams
within it (the leftmost of equals), so equal windows have equal anchors at equal distance.
Consecutive windows with one anchor form a context. Only contexts whose anchor gram, the
seed, occurs at least twice can hold a repeated window; all others are dropped by an
exact count over all documents before any text moves.
"""

from __future__ import annotations

import uuid
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualitygate.llm.common import numbered, spool, text_of
from qualitygate.llm.pretokens import text_blocks
from qualitygate.plans.scratch import new_folder

#: Occurrences of a seed that one task handles; a seed with more of them is dealt out.
HOT_SEED = 20_000
#: Occurrences that are not worth dealing out.
LEAST_SHARE = 500
#: Contexts of a seed that others are factored against.
REFERENCES = 4
#: Homes per task that writes documents, and rows in turn that share one.
CHUNKS, ROWS_OF_CHUNK = 16, 200

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse (modulo 2 ** 64), at least ``n`` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_ODD, _INVERSE)):
            factors = np.full(2 * n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.multiply.accumulate(factors)
    return _powers


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Sums:
    """Hashes of any slice of ``values`` that depend on its content alone."""

    def __init__(self, values: np.ndarray):
        self.up, down = _grown(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * down[: len(values)], out=self.sums[1:])

    def slices(self, starts, stops) -> np.ndarray:
        return (self.sums[stops] - self.sums[starts]) * self.up[starts]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.up[:n]


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))


class Bytes:
    """Texts as UTF-8 bytes."""

    @staticmethod
    def values(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _BYTES[np.frombuffer(b"".join(raw), np.uint8)], np.array([len(r) for r in raw], np.int64)

    @staticmethod
    def units(raw: bytes):
        return raw

    join = staticmethod(bytes)


class Words:
    """Texts as runs of anything but ASCII white space."""

    @staticmethod
    def values(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(white[1:] != white[:-1]) + 1
        starts, stops = edge[::2], edge[1::2]
        values = _mixed(_Sums(_BYTES[data]).slices(starts, stops) + (stops - starts).astype(np.uint64))
        limits = np.cumsum([len(r) + 1 for r in raw])
        return values, np.diff(np.searchsorted(starts, limits, "right"), prepend=0)

    @staticmethod
    def units(raw: bytes):
        return raw.split()  # bytes.split() knows exactly the six ASCII white spaces

    join = staticmethod(b" ".join)


def contexts(units, raw: list[bytes], length: int, k: int):
    """(text, anchor, first, last, seed) of all contexts; positions are units within the text."""
    values, counts = units.values(raw)
    n = len(values)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty
    ends = np.cumsum(counts)
    grams = _mixed(_Sums(values).grams(k))
    where = np.arange(len(grams), dtype=np.uint64)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | where
    reach, size = length - k + 1, 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    windows = n - length + 1
    least = np.minimum(least[:windows], least[reach - size : reach - size + windows])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    room = np.repeat(ends, counts)[:windows]
    valid = np.arange(windows) + length <= room
    change = np.append(True, (anchor[1:] != anchor[:-1]) | ~valid[:-1]) & valid
    first = np.flatnonzero(change)
    stop = np.flatnonzero(valid & np.append((anchor[1:] != anchor[:-1]) | ~valid[1:], True))
    text = np.searchsorted(ends, first, "right")
    begin = (ends - counts)[text]
    at = anchor[first]
    return text, at - begin, first - begin, stop - begin, grams[at].view(np.int64)


def _homes(spark: SparkSession, buckets: int) -> DataFrame:
    """(bucket, chunk, home): for each bucket of a bucketed table some numbers that Spark's bucketing puts there."""
    tried = spark.range(buckets * CHUNKS * 8).select(F.col("id").cast("int").alias("home"))
    tried = tried.withColumn("bucket", F.pmod(F.hash("home"), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("home")) - 1
    return tried.withColumn("chunk", place).where(F.col("chunk") < CHUNKS).select("bucket", "chunk", "home")


class Base:
    """Documents written once as (row, doc_id, text, home), bucketed by ``home``, so that no text is shuffled.

    A task writes one bucket: ``home`` follows from the row number, hence from the task, and its values are
    chosen to fall into the task's own bucket. Whatever belongs to a document is sent to its home. A home
    holds about 1 / CHUNKS of the texts of one input partition; a group in memory is that large.
    """

    def __init__(self, docs: DataFrame, text: str, key: str):
        spark = docs.sparkSession
        self.buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))  # as many buckets as Spark allows
        self.homes = spool(_homes(spark, self.buckets), "homes")
        name = f"repeats_{uuid.uuid4().hex}"
        rows = self.at_home(numbered(docs, F.col(key).alias("doc_id"), text_of(text).alias("text")))
        writer = rows.write.format("parquet").option("compression", "zstd").option("path", new_folder(spark, "repeats"))
        writer.bucketBy(self.buckets, "home").saveAsTable(name)
        self.rows = spark.table(name)
        self.id_type = docs.schema[key].dataType

    def at_home(self, df: DataFrame) -> DataFrame:
        """``df``, which has ``row``, with ``home``. The table of homes has CHUNKS rows per shuffle partition."""
        bucket = F.pmod(F.shiftright("row", 33), F.lit(self.buckets)).cast("int")
        chunk = F.pmod(F.floor(F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) / ROWS_OF_CHUNK), F.lit(CHUNKS)).cast("int")
        placed = df.withColumn("bucket", bucket).withColumn("chunk", chunk)
        return placed.join(F.broadcast(self.homes), ["bucket", "chunk"]).drop("bucket", "chunk")

    def meet(self, other: DataFrame, function, schema: str) -> DataFrame:
        """``function(documents, rows of other)`` for each home; only ``other`` moves."""
        return self.rows.groupBy("home").cogroup(self.at_home(other).groupBy("home")).applyInArrow(function, schema)


def repeated_seeds(base: Base, units, length: int, k: int, even: bool = False) -> tuple[DataFrame, DataFrame]:
    """Seeds that occur at least twice as (seed, n), and (row, seeds, shares) of the documents that have any.

    ``shares`` says over how many tasks the occurrences of a seed are to be dealt out: one per
    HOT_SEED of them, and with ``even`` so many that none has much more than a task's part of all.
    """

    def run(batches):
        for batch, texts in text_blocks(batches):
            text, *_, seed = contexts(units, [t.encode() for t in texts], length, k)
            offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(seed))
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], names=["row", "seeds"])

    made = spool(base.rows.select("row", "text").mapInArrow(run, "row long, seeds array<long>"), "repeats")
    every = made.select("row", F.explode("seeds").alias("seed"))
    seeds = spool(every.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeats")
    limit = HOT_SEED
    if even:
        limit = min(limit, (seeds.agg(F.sum("n")).first()[0] or 0) // (4 * base.buckets) + LEAST_SHARE)
    own = every.join(seeds, "seed").withColumn("shares", F.ceil(F.col("n") / limit).cast("int"))
    flags = own.groupBy("row").agg(F.collect_set(F.struct("seed", "shares")).alias("own"))
    return seeds, spool(flags.select("row", F.col("own.seed").alias("seeds"), F.col("own.shares").alias("shares")), "repeats")


def flagged_contexts(docs: pa.Table, flags: pa.Table, units, length: int, k: int, shares_at_least: int, shares_at_most: float = float("inf")):
    """For each text with repeated seeds: (row, its units, and of its repeated contexts the arrays first, last, anchor, seed, shares).

    Seeds with fewer or more shares are left out.
    """
    known_of = dict(zip(flags["row"].to_pylist(), zip(flags["seeds"].to_pylist(), flags["shares"].to_pylist(), strict=True), strict=True))
    for batch, texts in text_blocks(docs.to_batches()):
        rows = batch.column("row").to_pylist()
        keep = [i for i, r in enumerate(rows) if r in known_of]
        raw = [texts[i].encode() for i in keep]
        text, anchor, first, last, seed = contexts(units, raw, length, k)
        bounds = np.searchsorted(text, np.arange(len(raw) + 1)).tolist()
        for i, a, b in zip(range(len(raw)), bounds[:-1], bounds[1:], strict=True):
            known, parts = (np.array(x) for x in known_of[rows[keep[i]]])
            wanted = (parts >= shares_at_least) & (parts <= shares_at_most)
            known, parts = known[wanted], parts[wanted]
            if not len(known):
                continue
            order = np.argsort(known)
            at = np.minimum(np.searchsorted(known[order], seed[a:b]), len(known) - 1)
            own = np.flatnonzero(known[order][at] == seed[a:b])
            if len(own):
                yield rows[keep[i]], units.units(raw[i]), first[a:b][own], last[a:b][own], anchor[a:b][own], seed[a:b][own], parts[order][at[own]]


CONTEXT = "seed long, share long, shares long, row long, first long, anchor long, context binary"


def _emit_contexts(units, length, k, least_shares):
    def run(docs, flags):
        names = [f.split()[0] for f in CONTEXT.split(", ")]
        out: list[list] = [[] for _ in names]
        for row, own, first, last, anchor, seed, shares in flagged_contexts(docs, flags, units, length, k, least_shares):
            for f, z, a, s, n in zip(first.tolist(), last.tolist(), anchor.tolist(), seed.tolist(), shares.tolist(), strict=True):
                for column, value in zip(out, (s, (row * 0x9E3779B1 >> 8) % n, n, row, f, a - f, units.join(own[f : z + length])), strict=True):
                    column.append(value)
        return pa.table([pa.array(c, pa.int64() if n != "context" else pa.binary()) for c, n in zip(out, names, strict=True)], names=names)

    return run


class _Reference:
    def __init__(self, row, first, anchor, context, own, windows):
        self.row, self.first, self.anchor, self.context, self.own = row, first, anchor, context, own
        self.windows, self.matched, self.whole = windows, [], False


def _factor(units, length):
    """Factor the contexts of a seed, in order, against the first few different ones.

    Windows inside a factor are repeated, on both sides. Windows that no factor holds
    whole, those at its boundaries, are given out by digest to be counted exactly.
    """

    def run(batches):
        spans: list[tuple] = []
        doubts: list[tuple] = []
        current, known = None, []

        def doubt(row, first, own, windows):
            for t in windows:
                doubts.append((row, first + t, blake2b(units.join(own[t : t + length]), digest_size=16).digest()))

        def close():
            for i, ref in enumerate(known):
                found = [(0, ref.windows - 1)] if ref.whole else ref.matched
                spans.extend((ref.row, ref.first + a, ref.first + b + length) for a, b in found)
                if current[2] > 1 and not i:  # the same seed has a first context elsewhere
                    doubt(ref.row, ref.first, ref.own, range(ref.windows))
            known.clear()

        def flush():
            rows = [(r, s, e, None) for r, s, e in spans] + [(r, s, s + length, d) for r, s, d in doubts]
            spans.clear()
            doubts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["row", "start", "stop", "digest"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("seed", "share", "shares", "row", "first", "anchor", "context")]
            for seed, share, shares, row, first, anchor, context in zip(*columns, strict=True):
                if (seed, share, shares) != current:
                    close()
                    current = (seed, share, shares)
                same = next((r for r in known if r.context == context and r.anchor == anchor), None)
                if same:
                    same.whole = True
                    spans.append((row, first, first + same.windows - 1 + length))
                    continue
                own = units.units(context)
                windows = len(own) - length + 1
                matched: list[tuple[int, int]] = []
                for r in known:
                    a = 0
                    while a < anchor and a < r.anchor and own[anchor - a - 1] == r.own[r.anchor - a - 1]:
                        a += 1
                    b, limit = 0, min(len(own) - anchor, len(r.own) - r.anchor)
                    while b < limit and own[anchor + b] == r.own[r.anchor + b]:
                        b += 1
                    low, high = anchor - a, anchor + b - length
                    if low <= high:
                        matched.append((low, high))
                        r.matched.append((low - anchor + r.anchor, high - anchor + r.anchor))
                spans.extend((row, first + a, first + b + length) for a, b in matched)
                covered = {t for a, b in matched for t in range(a, b + 1)}
                if known:
                    doubt(row, first, own, (t for t in range(windows) if t not in covered))
                if len(known) < REFERENCES:
                    known.append(_Reference(row, first, anchor, context, own, windows))
            if len(spans) + len(doubts) > 20_000:
                yield flush()
        close()
        if spans or doubts:
            yield flush()

    return run


def factored_spans(base: Base, flags: DataFrame, units, length: int, k: int, least_shares: int = 1) -> DataFrame:
    """(row, start, stop) of repeated stretches, from contexts of seeds with at least so many shares.

    A seed's occurrences are read in order by one task, which holds only the references; a hot
    seed is dealt out by row into shares with references of their own, whose windows take
    part in the exact count, so that nothing is lost between shares.
    """
    made = base.meet(flags, _emit_contexts(units, length, k, least_shares), CONTEXT)
    ordered = made.repartition("seed", "share").sortWithinPartitions("seed", "share", "row", "first")
    found = spool(ordered.mapInArrow(_factor(units, length), "row long, start long, stop long, digest binary"), "repeats")
    doubts = found.where("digest is not null")
    twice = spool(doubts.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "repeats")
    return found.where("digest is null").select("row", "start", "stop").union(doubts.join(twice, "digest").select("row", "start", "stop"))


def merged(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Maximal stretches of overlapping or touching ones, as rows of (start, stop)."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return np.stack([starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]], axis=1)


def without_spans(base: Base, spans: DataFrame, units) -> DataFrame:
    """doc_id, n_units, spans and the kept content of each document, as bytes."""

    def run(docs, found):
        gone_of: dict[int, tuple[list, list]] = {}
        for row, start, stop in zip(*(found[c].to_pylist() for c in ("row", "start", "stop")), strict=True):
            starts, stops = gone_of.setdefault(row, ([], []))
            starts.append(start)
            stops.append(stop)
        n_units, every, flat = [], [], []
        for row, text in zip(docs["row"].to_pylist(), docs["text"].to_pylist(), strict=True):
            own = units.units(text.encode())
            gone = merged(*map(np.array, gone_of[row])).tolist() if row in gone_of else []
            kept, at = [], 0
            for a, b in gone:
                kept.append(own[at:a])
                at = b
            kept.append(own[at:])
            n_units.append(len(own))
            every.append([{"start": a, "stop": b} for a, b in gone])
            flat.append(b"".join(kept) if isinstance(own, bytes) else b" ".join(w for part in kept for w in part))
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({"doc_id": docs["doc_id"], "n_units": pa.array(n_units, pa.int64()), "spans": pa.array(every, span), "kept": pa.array(flat, pa.binary())})

    return base.meet(spans, run, f"doc_id {base.id_type.simpleString()}, n_units long, spans array<struct<start: long, stop: long>>, kept binary")


def removed(column: str = "spans"):
    """How many units a column of spans covers."""
    return F.aggregate(F.col(column), F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])

