"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded (pairs of character classes, how far
its words repeat), a small network turns the encoding into a representation, gated attention
learned from document labels weighs the passages, and the weighted representation is scored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.llm.common import spool, text_of
from qualitygate.llm.pretokens import text_blocks

#: Bytes of a passage.
PASSAGE = 512
#: Bound of the labelled sample for fitting: documents, and bytes of all their texts together. Every passage of a sampled text is used.
TRAIN_DOCS, TRAIN_BYTES = 3000, 200_000_000
#: Widths of representation and attention; rounds over the sample.
WIDTH, GATE, ROUNDS = 24, 12, 30
#: Characters by class; what is not listed is upper case, digit, other sign, or part of a longer character.
CLASSES = ["aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\t\r\x0b\x0c", ".", ",", "!", "?", "'\"-", "#$%&*@", "()[]{}<>/\\|=_~^+:;`"]
N_CLASSES = 16


@lru_cache(1)
def _class_table() -> np.ndarray:
    table = np.full(256, 15, np.uint8)
    for i, signs in enumerate(CLASSES):
        table[list(signs.encode())] = i
    table[0x80:0xC0], table[0xC0:] = 13, 14
    return table


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of all passages of all texts in turn, and how many each text has (an empty text has one)."""
    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    data = np.frombuffer(b"".join(raw), np.uint8)
    n = int(counts.sum())
    first = np.cumsum(counts) - counts
    begin = np.cumsum(sizes) - sizes
    kind = _class_table()[data].astype(np.int64)
    passage = np.repeat(first, sizes) + (np.arange(len(data)) - np.repeat(begin, sizes)) // PASSAGE
    following = np.append(kind[1:], 5)
    following[(begin + sizes - 1)[sizes > 0]] = 5
    pairs = np.bincount(passage * N_CLASSES**2 + kind * N_CLASSES + following, minlength=n * N_CLASSES**2).reshape(n, -1)
    length = pairs.sum(axis=1)
    parted = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n" * 7, np.uint8)  # no word goes on into the next text
    white = np.isin(_class_table()[parted], (4, 5))
    starts = np.flatnonzero(~white[1:] & white[:-1]) + 1
    text = np.searchsorted(begin + np.arange(1, len(raw) + 1), starts, "right") - 1
    own = first[text] + (starts - 1 - text - begin[text]) // PASSAGE
    code, inside = np.zeros(len(starts), np.uint64), np.ones(len(starts), bool)
    for i in range(6):
        inside &= ~white[starts + i]
        code = code * np.uint64(31) + parted[starts + i] * inside.astype(np.uint64)
    words = np.bincount(own, minlength=n)
    distinct = np.unique((own.astype(np.uint64) << np.uint64(36)) ^ (code & np.uint64((1 << 36) - 1)))
    different = np.bincount((distinct >> np.uint64(36)).astype(np.int64), minlength=n)
    rest = np.stack([different / np.maximum(words, 1), words / np.maximum(length, 1), length / PASSAGE, length == 0], axis=1)
    return np.concatenate([np.sqrt(pairs / np.maximum(length, 1)[:, None]), rest], axis=1).astype(np.float32), counts


def packed(encodings: np.ndarray) -> np.ndarray:
    """Encodings, which lie between 0 and 1, in steps of 1/255."""
    return np.rint(encodings * 255).astype(np.uint8)


class Attention:
    """Gated attention over passages; fitted with Adam on whole bags, whose encodings are ``packed``."""

    def __init__(self, width: int, seed: int = 7):
        rnd = np.random.default_rng(seed)
        shapes = {"W": (width, WIDTH), "b": (WIDTH,), "V": (WIDTH, GATE), "U": (WIDTH, GATE), "w": (GATE,), "c": (WIDTH,), "d": (1,)}
        self.p = {k: (rnd.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s)) for k, s in shapes.items()}

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        p, start = self.p, np.cumsum(counts) - counts
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), counts))
        a = e / np.repeat(np.add.reduceat(e, start), counts)
        z = np.add.reduceat(a[:, None] * h, start, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def gradients(self, x, counts, y, f) -> dict:
        p, n = self.p, len(y)
        start = np.cumsum(counts) - counts
        do = (f["score"] - y) / n
        dz = np.repeat(do[:, None] * p["c"], counts, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, start), counts))
        du = de[:, None] * p["w"]
        dt, dg = du * f["g"] * (1 - f["t"] ** 2), du * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        own = {"W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ do, "d": do.sum(keepdims=True)}
        return {k: g + 1e-4 * p[k] for k, g in own.items()}

    def fit(self, bags: list[np.ndarray], y: np.ndarray) -> Attention:
        if not len(y):
            return self
        rnd, m, v, step = np.random.default_rng(3), {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        self.p["d"][:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        for _ in range(max(ROUNDS, min(200, ROUNDS * 1000 // len(y)))):
            order = rnd.permutation(len(y))
            for i in range(0, len(y), 64):
                own = order[i : i + 64]
                x, counts = np.concatenate([bags[j] for j in own]).astype(np.float32) / 255, np.array([len(bags[j]) for j in own])
                grads, step = self.gradients(x, counts, y[own], self.forward(x, counts)), step + 1
                for k, g in grads.items():
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def held_out(key: str):
    """Whether a row's label is kept for testing; a null id never is."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id") -> Attention:
    """Fit on all passages of labelled documents that are not held out, chosen by a hash of the id.

    These are at most ``TRAIN_DOCS``, and as many of them, in that order, as have ``TRAIN_BYTES`` of text together.
    The driver holds a byte for each number of an encoding, about half as many as the texts have.

    Null labels and null ids are left out; of repeated ids the label with the largest value
    and the smallest text count. Without any label the score is one half everywhere.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("doc_id")).agg(F.max(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    texts = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    texts = spool(texts, "train")
    sizes = Window.orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # of at most TRAIN_DOCS rows
    within = texts.select("doc_id", F.xxhash64("doc_id").alias("order"), F.octet_length("text").cast("long").alias("size")).withColumn("reached", F.sum("size").over(sizes))
    texts = texts.join(F.broadcast(within.where(F.col("reached") <= TRAIN_BYTES).select("doc_id")), "doc_id")

    def encode(batches):
        for batch in batches:
            for i, t in enumerate(batch.column("text")):  # one text at a time
                bag = pa.array([packed(passages([t.as_py()])[0]).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, 1), batch.column("label").slice(i, 1), bag], names=["key", "label", "bag"])

    sample = texts.select(F.xxhash64("doc_id").alias("key"), F.col("label").cast("double").alias("label"), "text").mapInArrow(encode, "key long, label double, bag binary")
    rows = sorted(sample.collect(), key=lambda r: r.key)  # at most TRAIN_DOCS rows of TRAIN_BYTES of text
    width = N_CLASSES**2 + 4
    return Attention(width).fit([np.frombuffer(r.bag, np.uint8).reshape(-1, width) for r in rows], np.array([r.label for r in rows]))


def score(docs: DataFrame, model: Attention, text: str = "text") -> DataFrame:
    """The struct ``kept`` of each row's columns and ``score`` (0 to 1), over every passage of the whole text.

    A null or empty text is one empty passage and gets a score too.
    """
    weights = model.p
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), text_of(text).alias("text"))
    schema = T.StructType([T.StructField("kept", rows.schema["kept"].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        network = Attention(N_CLASSES**2 + 4)
        network.p = weights
        for batch, texts in text_blocks(batches, 500_000):
            x, counts = passages(texts)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(network.forward(packed(x).astype(np.float32) / 255, counts)["score"])], names=["kept", "score"])

    return rows.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted of each row; repeated rows get equal scores, an empty table gives none."""
    model = train(docs, labels, text=text, key=key)
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    scored = score(narrow, model)
    return scored.select("kept.doc_id", held_out("kept.doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = train(docs, labels, text=text, key=key)
    return score(docs, model, text).where(F.col("score") >= threshold).select("kept.*")
