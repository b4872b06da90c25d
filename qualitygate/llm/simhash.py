"""SimHash near-dedup by deletion variants.

A fingerprint is cut into so few segments that, of two fingerprints to be linked, one
segment differs by at most one bit. Each segment is indexed once per bit position with that
bit left out; equal variants meet by an equality shuffle and are verified on all bits.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.llm.common import numbered, spool, text_of
from qualitygate.llm.components import components
from qualitygate.plans.broadcasting import small_side

#: A-Z to lower case, nothing else.
LOWER = bytes(range(256)).lower()
#: Buckets up to this size compare all pairs at once; larger ones grow trees of links instead.
PAIRWISE = 64
#: Rows that are named to all tasks instead of shuffling the texts, if they are not more than this.
NAMED = 1_000_000


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words; fewer words are one run, none give nothing."""
    import xxhash

    own = text.encode().translate(LOWER).split()  # bytes.split() knows exactly the six ASCII white spaces
    if not own:
        return np.zeros(0, np.uint64)
    whole = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(words, len(own))
    runs = [whole[a:b] for a, b in zip(starts[: len(own) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), runs), np.uint64, len(runs))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes. Counted in eight byte lanes, 255 hashes at a time."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    padded = np.zeros(-(-n // 255) * 255, np.uint64)
    padded[:n] = hashes
    padded = padded.reshape(-1, 255)
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = ((padded >> np.uint64(bit)) & lanes).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, words: int, text: str, key: str, row: str | None = None) -> DataFrame:
    """row, doc_id and fingerprint, written to the shared folder. ``row`` names a column that numbers the rows already."""
    columns = F.col(key).alias("doc_id"), text_of(text).alias("text")
    rows = numbered(docs, *columns) if row is None else docs.select(F.col(row).alias("row"), *columns)
    kept = T.StructType([f for f in rows.schema.fields if f.name != "text"])
    schema = T.StructType([*kept.fields, T.StructField("fingerprint", T.LongType())])

    def run(batches):
        for batch in batches:
            codes = [fingerprint(shingle_hashes(t.as_py(), words)) for t in batch.column("text")]  # one text at a time
            columns = [batch.column(f.name) for f in kept.fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.array(codes, np.uint64).view(np.int64))], names=schema.names)

    return spool(rows.mapInArrow(run, schema), "simhash")


def _segments(bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one must differ by at most one bit."""
    n = bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _variants(code: Column, bits: int) -> Column:
    """A key per segment and left-out bit: the segment's other bits, the position, the segment."""
    keys = []
    for s, (first, width) in enumerate(_segments(bits)):
        value = F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))
        keys += [value.bitwiseAND(F.lit(~(1 << i))).bitwiseOR(F.lit(((s << 6) | i) << 33)) for i in range(width)]
    return F.array(*keys)


def _trees(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Links that connect all of a bucket that can be connected, each code being visited once."""
    found, rest, stack = [], codes, []
    while len(rest) or stack:
        if not stack:
            stack, rest = [rest[0]], rest[1:]
        one = stack.pop()
        near = np.bitwise_count(rest ^ one) <= bits
        if near.any():
            new, rest = rest[near], rest[~near]
            found.append(np.stack([np.full(len(new), one, np.uint64), new]))
            stack.extend(new)
    return found


def _links(bits: int):
    """Verified links of each bucket, from rows sorted by key; a pair is given out by one bucket only."""

    def within(keys, codes):
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        found = []
        small = (size > 1) & (size <= PAIRWISE)
        of_small = np.repeat(start[small] + size[small], size[small])
        at = np.concatenate([np.arange(a, a + n) for a, n in zip(start[small], size[small], strict=True)]) if small.any() else np.zeros(0, np.int64)
        for shift in range(1, int(size[small].max()) if small.any() else 1):
            keep = at + shift < of_small
            at, of_small = at[keep], of_small[keep]
            a, b = codes[at], codes[at + shift]
            near = np.bitwise_count(a ^ b) <= bits
            if near.any():
                found.append(np.stack([a[near], b[near]]))
        for i in np.flatnonzero(size > PAIRWISE):
            found += _trees(codes[start[i] : start[i] + size[i]], bits)
        if not found:
            return None
        pairs = np.unique(np.concatenate(found, axis=1).view(np.int64), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []  # the last bucket, which may go on; joined only when it is left
        for batch in batches:
            keys, codes = batch.column("key").to_numpy(), batch.column("fingerprint").to_numpy().view(np.uint64)
            if not len(keys):
                continue
            held.append((keys, codes))
            if held[0][0][0] == keys[-1]:
                continue
            keys, codes = (np.concatenate(x) for x in zip(*held, strict=True))
            whole = np.searchsorted(keys, keys[-1])
            if (out := within(keys[:whole], codes[:whole])) is not None:
                yield out
            held = [(keys[whole:], codes[whole:])]
        if held and (out := within(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
            yield out

    return run


def _components_of(codes: DataFrame, bits: int) -> DataFrame:
    """(fingerprint, least, component) for distinct fingerprints; ``least`` is the smallest id that has it."""
    own = spool(codes.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash")
    keyed = own.select("fingerprint", F.explode(_variants(F.col("fingerprint"), bits)).alias("key")).repartition("key").sortWithinPartitions("key")
    links = keyed.mapInArrow(_links(bits), "u long, v long")
    labels = spool(components(links), "simhash")
    return spool(own.join(labels, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")), "simhash")


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of each row, in the smallest doc_id reachable.

    Fingerprints link at ``bits`` or fewer differing bits. Null, empty and blank texts have
    fingerprint zero and link like any other. Rows with equal texts share a component, also
    rows with a null or repeated id; a component whose ids are all null has a null component_id.
    Other columns are not looked at; an empty table gives no rows.
    """
    codes = fingerprints(docs, words, text, key)
    own = _components_of(codes, bits)
    ids = spool(own.groupBy("component").agg(F.min("least").alias("component_id")), "simhash")
    named = spool(own.join(ids, "component").select("fingerprint", "component_id"), "simhash")
    return codes.join(named, "fingerprint").select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words: int = 4, bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of ``near_duplicates`` stays, with all its columns: that of the smallest id, null ids last.

    An empty table gives no rows; of rows with equal texts and ids one stays.
    """
    rows = spool(numbered(docs, F.col(key).alias("doc_id"), carry=True), "near")
    codes = fingerprints(rows.select("row", "doc_id", F.col(f"kept_row.`{text}`").alias("text")), words, "text", "doc_id", "row")
    own = _components_of(codes, bits).select("fingerprint", "component")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("place")
    firsts = codes.groupBy("fingerprint").agg(place).join(own, "fingerprint").groupBy("component").agg(F.min("place").alias("place"))
    stay = spool(firsts.select("place.row"), "near")
    gone = small_side(codes.select("row").join(stay, "row", "left_anti"), NAMED)
    return rows.join(gone, "row", "left_anti").select("kept_row.*")
