"""Token counts by byte-pair merging on a heap and a linked list.

A pre-token begins as one symbol per byte. The lowest-rank adjacent pair is popped from a heap
and merged in a linked list until no pair has a rank; symbols minus merges are its tokens. No
identifiers leave the merging, and counting needs no shuffle: each worker remembers the counts
of pre-tokens that it met before, in bounded memory.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.llm.common import text_of
from qualitygate.llm.pretokens import byte_signs, split, text_blocks

#: Pre-tokens whose counts a Python worker remembers. Longer ones than ``LONG`` characters are counted anew each time.
REMEMBERED, LONG = 600_000, 100
#: Room for a symbol and for a position in a packed number.
SYMBOL, PLACE = 24, 40


class Merges(NamedTuple):
    """What a tokenizer file says: the symbol of each byte, rank and result of each pair, and strings that are one token."""

    symbols: list[int]
    pairs: dict[int, int]
    special: re.Pattern | None


@lru_cache(2)
def merges_of(path: str) -> Merges:
    """The merges of a byte-level BPE file of the tokenizers library; other kinds of files are an error."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, before = whole["model"], whole["pre_tokenizer"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    levelled = before and before["type"] == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
    added = whole["added_tokens"]
    if model["type"] != "BPE" or not plain or not levelled or whole["normalizer"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path} is not a plain byte-level BPE")
    ids, pairs = model["vocab"], {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        pairs[ids[a] << SYMBOL | ids[b]] = rank << SYMBOL | ids[a + b]
    strings = sorted((t["content"] for t in added if t["content"]), key=len, reverse=True)
    return Merges([ids[s] for s in byte_signs()], pairs, re.compile("|".join(map(re.escape, strings))) if strings else None)


def count_merged(data: bytes, merges: Merges) -> int:
    """How many symbols are left of ``data`` when no adjacent pair can be merged any more.

    Of equal pairs the leftmost is merged first. Entries of the heap whose pair is gone are
    passed over when they come up. Memory grows with the length of one pre-token, time with its
    length times the logarithm of it.
    """
    n, pairs = len(data), merges.pairs
    if n < 2:
        return n
    symbols = [merges.symbols[b] for b in data]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        if (found := pairs.get(symbols[i] << SYMBOL | symbols[i + 1])) is not None:
            heap.append(found >> SYMBOL << PLACE | i)
    heapify(heap)
    left, place, symbol = n, (1 << PLACE) - 1, (1 << SYMBOL) - 1
    while heap:
        top = heappop(heap)
        i = top & place
        j = after[i]
        if symbols[i] < 0 or j == n:
            continue
        found = pairs.get(symbols[i] << SYMBOL | symbols[j])
        if found is None or found >> SYMBOL != top >> PLACE:
            continue
        new = symbols[i] = found & symbol
        symbols[j] = -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (found := pairs.get(new << SYMBOL | symbols[k])) is not None:
                heappush(heap, found >> SYMBOL << PLACE | i)
        if (h := before[i]) >= 0 and (found := pairs.get(symbols[h] << SYMBOL | new)) is not None:
            heappush(heap, found >> SYMBOL << PLACE | h)
    return left


class _Remembered:
    """Counts by pre-token in two halves: when the recent one is full the older one goes, but for what came again."""

    def __init__(self, merges: Merges):
        self.merges, self.recent, self.older = merges, {}, {}

    def counts(self, words: list[str]) -> np.ndarray:
        if len(self.recent) > REMEMBERED // 2:
            self.recent, self.older = {}, self.recent
        known, long = self.recent, {}
        for word in {w for w, n in zip(words, map(known.get, words), strict=True) if n is None}:
            n = self.older.get(word) or count_merged(word.encode(), self.merges)
            (known if len(word) <= LONG else long)[word] = n
        get = (known | long).get if long else known.get
        return np.fromiter(map(get, words), np.int64, len(words))


@lru_cache(2)
def _remembered(path: str) -> _Remembered:
    return _Remembered(merges_of(path))


def _pieces(texts: list[str], special: re.Pattern | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at special strings, which text each piece is of, and how many special strings each text has."""
    pieces, owner, own = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        parts = special.split(text) if special else [text]
        pieces += parts
        owner += [i] * len(parts)
        own[i] = len(parts) - 1
    return pieces, np.array(owner, np.int64), own


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row: bytes and tokens of the whole text, and whether they exceed ``limit``.

    Tokens are as the tokenizers library counts them for the file, without added ones; a special
    string inside a text is one token, its default. A null or empty text has none. Null and
    repeated doc_ids are rows like any other, other columns are not looked at, and an empty
    table gives no rows.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape, remembered = to_arrow_schema(schema), _remembered(tokenizer)
        for batch, texts in text_blocks(batches, 1_000_000):
            pieces, owner, own = _pieces(texts, remembered.merges.special)
            words, per_piece = split(pieces)
            sums = np.append(0, np.cumsum(remembered.counts(words)))
            ends = np.cumsum(per_piece)
            np.add.at(own, owner, sums[ends] - sums[ends - per_piece])
            size = pc.binary_length(batch.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(own)], schema=shape)

    rows = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
