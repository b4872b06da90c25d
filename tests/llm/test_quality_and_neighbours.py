import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from qualitygate.llm import neighbours, quality
from qualitygate.llm.neighbours import nearest, nearest_exact

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert got.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.quality_scores(docs, labels).collect(), quality.quality_scores(docs, flipped).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (None, "Plain words.", "s"), (2, "x" * 200_000, "s"), (3, "É" * 3, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (2, 1)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 5 and all(math.isfinite(r.score) for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} != set()
    kept = quality.drop_rejected(docs, labels)
    assert kept.columns == docs.columns


def test_the_sample_is_bounded_by_bytes_too(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    seen = []
    monkeypatch.setattr(quality.Attention, "fit", lambda self, bags, y: seen.append([len(b) for b in bags]) or self)
    for bound in (10**9, 100_000, 1):
        monkeypatch.setattr(quality, "TRAIN_BYTES", bound)
        quality.train(docs, labels)
    sizes = {r.doc_id: len((r.text or "").encode()) for r in docs.collect()}
    kept = [r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    assert sorted(seen[0]) == sorted(max(1, -(-sizes[d] // quality.PASSAGE)) for d in kept)  # every passage
    assert 0 < len(seen[1]) < len(seen[0]) and sum(seen[1]) * quality.PASSAGE < 2 * 100_000 and not seen[2]


def test_gradients_against_differences():
    rnd = np.random.default_rng(0)
    model = quality.Attention(5)
    x, counts, y = rnd.normal(size=(9, 5)), np.array([2, 3, 4]), np.array([0.0, 1.0, 1.0])

    def loss():
        s = model.forward(x, counts)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean() + 0.5e-4 * sum((v**2).sum() for v in model.p.values())

    grads = model.gradients(x, counts, y, model.forward(x, counts))
    for name, values in model.p.items():
        at = (0,) * values.ndim
        old = values[at]
        values[at] = old + 1e-6
        up = loss()
        values[at] = old - 1e-6
        down = loss()
        values[at] = old
        assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-6, name


def test_passages_cover_the_whole_text_alike_alone_and_together():
    texts = ["a" * 511, "", "b c " * 400, "É" * 300]
    together, counts = quality.passages(texts)
    assert counts.tolist() == [1, 1, 4, 2]
    assert np.array_equal(together, np.concatenate([quality.passages([t])[0] for t in texts]))
    assert 0 <= together.min() and together.max() <= 1


def test_small_table_is_exact_with_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(neighbours, "QUERIES_AT_ONCE", 3)
    rnd = np.random.default_rng(1)
    rows = [(i, [float(round(x, 1)) for x in rnd.normal(size=3)] if i % 3 else [1.0, 0.5, 0.0], 1) for i in range(120)]
    rows += [(20, [1.0, 0.5, 0.0], 1), (40, None, 1), (60, [0.0, 0.0, 0.0], 1), (80, [1.0, None, 0.0], 1), (100, [math.inf, 1.0, 0.0], 1), (200, [math.nan, 1.0, 0.0], 1), (220, [1.0], 1), (None, [9.0, 9.0, 9.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest(vectors, k=5).collect())
    want = sorted(t for t in nearest_exact(vectors, k=5) if t[0] != 220)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want, strict=True))
    few = nearest(vectors.where("vec_id < 4"), k=20).collect()
    assert [(r.query_id, r.rank) for r in sorted(few, key=lambda r: r.rank)] == [(0, 1), (0, 2), (0, 3)]
    assert nearest(vectors.limit(0)).count() == 0


def test_recall_with_many_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 50)
    monkeypatch.setattr(neighbours, "SAMPLE_PER_PART", 50)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in nearest(vectors).collect()}
    want = {(q, v) for q, _, v, _ in nearest_exact(vectors)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


@pytest.mark.parametrize("spread", [0.0, 0.7])
def test_recall_of_clustered_vectors_of_any_length(spark, monkeypatch, spread):
    monkeypatch.setattr(neighbours, "PART_ROWS", 50)
    monkeypatch.setattr(neighbours, "SAMPLE_PER_PART", 50)
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(40, 24))
    x = centres[rnd.integers(0, 40, 2000)] + 0.5 * rnd.normal(size=(2000, 24))
    x *= np.exp(spread * rnd.normal(size=2000))[:, None]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in nearest(vectors).collect()}
    s = x[::20] @ x.T
    s[np.arange(100), np.arange(0, 2000, 20)] = -np.inf
    want = {(20 * q, int(v)) for q, row in enumerate(s) for v in np.argsort(-row)[:20]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_equal_scores_in_different_parts_go_by_id(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 20)
    monkeypatch.setattr(neighbours, "SAMPLE_PER_PART", 20)
    rnd = np.random.default_rng(5)
    rows = [[1.0, float(s), float(z)] for s in (-3, 3) for z in rnd.integers(-2, 3, 60)]
    vectors = spark.createDataFrame([(i, [2.0, 0.0, 0.0] if i % 20 == 0 else v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in nearest(vectors, k=30).collect())
    assert got == sorted(t[:3] for t in nearest_exact(vectors, k=30))


def test_lifted_rows_keep_the_order_of_inner_products():
    rnd = np.random.default_rng(6)
    x, q = rnd.normal(size=(300, 7)) * np.exp(rnd.normal(size=(300, 1))), rnd.normal(size=7)
    up = neighbours.lifted(x, neighbours._lengths(x).max())
    assert np.allclose((up**2).sum(axis=1), 1) and np.array_equal(np.argsort(up[:, :-1] @ q), np.argsort(x @ q))


@pytest.mark.parametrize("parts", [1, 7])
def test_parts_are_balanced(parts):
    x = neighbours._directions(np.random.default_rng(2).normal(size=(500, 8)) + [3, 0, 0, 0, 0, 0, 0, 0])
    part = neighbours.balanced_parts(x, neighbours.neighbour_graph(x), parts)
    assert np.bincount(part, minlength=parts).max() <= math.ceil(1.15 * 500 / parts)
