"""Byte-level BPE over a corpus, encoding each distinct word once.

Documents are read in blocks. A block's pre-tokens become a sequence of word numbers by
position; its distinct words are dealt out by their hash. Where all copies of a word meet it
is encoded once; the ids go back to the blocks, which put them together by position.
Decoding looks the ids up in the table of token bytes, in the same step if asked for.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.llm.common import text_of
from qualitygate.llm.pretokens import split, text_blocks


@lru_cache(2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(2)
def _encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


def _packed(values) -> bytes:
    """Whole numbers as byte planes, compressed; small numbers leave the upper planes empty."""
    planes = np.ascontiguousarray(np.asarray(values, "<u4")).view(np.uint8).reshape(-1, 4)
    return zlib.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _gather(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The slices values[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    return values[at]


def _blocks(docs: DataFrame, parts: int, text: str, key: str) -> DataFrame:
    """Rows of two kinds: a block's documents and word numbers (part -1), sent to the block, and its words by part, sent there."""
    kind = docs.schema[key].dataType
    payload = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("words", T.BinaryType()), T.StructField("numbers", T.BinaryType()), T.StructField("part_of", T.BinaryType()), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("ids_of_docs", T.ArrayType(kind))]
    )
    # Not null, so that the join adds no filter of its own and both readers see the same exchange.
    schema = T.StructType([T.StructField("goal", T.LongType(), False), T.StructField("payload", payload, False)])

    def cut(batches):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        shape, block = to_arrow_schema(schema), parts + (TaskContext.get().partitionId() << 32)
        for batch, texts in text_blocks(batches):
            tokens, counts = split(texts)
            words = [w for w, _ in Counter(tokens).most_common()]  # frequent words get small numbers
            number = {w: i for i, w in enumerate(words)}
            numbers = np.fromiter(map(number.__getitem__, tokens), np.uint32, len(tokens))
            raw = [w.encode() for w in words]
            part_of = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % parts
            order = np.argsort(part_of, kind="stable")
            bounds = np.searchsorted(part_of[order], np.arange(parts + 1))
            rows = [[block, -1, None, _packed(numbers), _packed(part_of), counts.tolist(), batch.column("doc_id").to_pylist()]]
            for p in range(parts):
                own = [raw[i] for i in order[bounds[p] : bounds[p + 1]].tolist()]
                if own:
                    data = _packed([len(w) for w in own])
                    rows.append([block, p, len(data).to_bytes(4, "little") + data + zlib.compress(b"".join(own), 1), None, None, None, None])
            inner = shape.field("payload").type
            whole = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), inner, strict=True)], fields=list(inner))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] if r[1] < 0 else r[1] for r in rows], pa.int64()), whole], schema=shape)
            block += 1

    return docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text")).mapInArrow(cut, schema)


def _encode_words(ranks: str):
    """Replace a block's words by their ids; a word that came before in this task is not encoded again."""

    def encode(batches):
        encoding, known = _encoding(ranks), {}
        for batch in batches:
            payload = batch.column("payload")
            part, block, words_of = (payload.field(c) for c in ("part", "block", "words"))
            for i in np.flatnonzero(part.to_numpy() >= 0).tolist():  # one block's words at a time
                packed = words_of[i].as_buffer()
                n = int.from_bytes(packed[:4], "little")
                raw, lengths = zlib.decompress(packed[4 + n :]), _unpacked(packed[4 : 4 + n])
                ends = np.cumsum(lengths).tolist()
                words = [raw[b - n : b] for b, n in zip(ends, lengths.tolist(), strict=True)]
                for w in words:
                    if w not in known:
                        known[w] = np.array(encoding.encode_ordinary(w.decode()), "<u4").tobytes()
                ids = [known[w] for w in words]
                sizes = _packed([len(i) // 4 for i in ids])
                out = len(sizes).to_bytes(4, "little") + sizes + _packed(np.frombuffer(b"".join(ids), "<u4"))
                yield pa.RecordBatch.from_arrays([block.slice(i, 1), part.slice(i, 1), pa.array([out], pa.binary())], names=["block", "part", "ids"])

    return encode


class _Pieces:
    """The table of token bytes, which is the rank file: fixed in size."""

    def __init__(self, ranks: str):
        table = _ranks(ranks)
        pieces = [b""] * (max(table.values()) + 1)
        for piece, i in table.items():
            pieces[i] = piece
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start, self.flat = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(pieces), np.uint8)

    def of(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids, together."""
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        if len(ids) and not self.size[ids].all():
            raise ValueError("an id has no entry in the table of token bytes")
        ends = np.append(0, np.cumsum(self.size[ids]))
        counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        offsets = ends[np.append(0, np.cumsum(counts))].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(_gather(self.start[ids], self.size[ids], self.flat))])


@lru_cache(2)
def _pieces(ranks: str) -> _Pieces:
    return _Pieces(ranks)


def _assemble(kind: T.DataType, ranks: str | None):
    """One row per document: its ids, from the ids of its block's words in order of part; with ``ranks`` their bytes too."""
    fields = [T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    schema = T.StructType([*fields, T.StructField("bytes", T.BinaryType())] if ranks else fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(schema)
        for batch in batches:
            payload, packs = batch.column("payload"), batch.column("packs")
            for i in np.flatnonzero(payload.field("part").to_numpy() < 0).tolist():  # one block at a time
                sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
                for packed in sorted(packs[i].as_py() or [], key=lambda p: p["part"]):
                    n = int.from_bytes(packed["ids"][:4], "little")
                    sizes.append(_unpacked(packed["ids"][4 : 4 + n]).astype(np.int64))
                    ids.append(_unpacked(packed["ids"][4 + n :]))
                numbers, part_of = (_unpacked(payload.field(c)[i].as_buffer()) for c in ("numbers", "part_of"))
                order = np.argsort(part_of, kind="stable")
                every = np.concatenate(sizes)
                size, start = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
                size[order] = every
                start[order] = np.cumsum(every) - every
                lengths = size[numbers]
                ends = np.append(0, np.cumsum(lengths))
                tokens = _gather(start[numbers], lengths, np.concatenate(ids)).astype(np.int32)
                offsets = ends[np.append(0, np.cumsum(payload.field("counts")[i].values.to_numpy()))].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))
                columns = [payload.field("ids_of_docs")[i].values, lists.cast(shape.field(1).type)]
                yield pa.RecordBatch.from_arrays([*columns, _pieces(ranks).of(lists)] if ranks else columns, schema=shape)

    return run, schema


def encode(docs: DataFrame, ranks: str, text: str = "text", key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """doc_id and ids of each row, as the rank file's library encodes the whole text without special tokens.

    With ``decoded`` also ``bytes``, as ``decode`` gives them, looked up where the ids are put together.

    A null or empty text has no ids. Null and repeated doc_ids are rows like any other, other
    columns are not looked at, and an empty table gives no rows. Memory per task is bounded by
    a block (2 million bytes or one document) and the distinct words of a part; use more
    shuffle partitions for more words.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One exchange carries both kinds of rows: words to where all copies of a word meet, the rest to where
    # the block is put together. It is read twice and written once.
    sent = _blocks(docs, parts, text, key).repartition(parts, "goal")
    ids = sent.mapInArrow(_encode_words(ranks), "block long, part int, ids binary")
    packs = ids.groupBy("block").agg(F.collect_list(F.struct("part", "ids")).alias("packs"))  # one pack per part
    whole = sent.join(packs.hint("shuffle_hash"), F.col("goal") == F.col("block"), "left")  # no filter here: it would part the exchanges
    run, schema = _assemble(docs.schema[key].dataType, ranks if decoded else None)
    return whole.select("payload", "packs").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``bytes``, the bytes of its ``ids`` (null: empty); ids without an entry in the rank file are an error."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())])

    def look_up(batches):
        for batch in batches:
            data = _pieces(ranks).of(batch.column("ids").fill_null([]))
            yield pa.RecordBatch.from_arrays([*batch.columns, data], names=[*batch.schema.names, "bytes"])

    return encoded.mapInArrow(look_up, schema)
