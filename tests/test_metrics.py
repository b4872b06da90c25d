import random

import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.spec import EVALUATION
from tests.conftest import rows
from tests.test_ranking import at_percent

LABELS = "row_id string, deployment_version string, is_good boolean"


@pytest.fixture
def evals(spark):
    def make(data):
        full = [(i, v, None, q, "b", float(lat), float(cost)) for i, v, q, lat, cost in data]
        return spark.createDataFrame(full, EVALUATION)

    return make


DATA = [
    ("1", "v1", 0.9, 10, 0.1),
    ("2", "v1", 0.5, 30, 0.1),
    ("1", "v10", 0.3, 20, 0.2),
    ("2", "v2", 0.4, 40, 0.2),
    ("2", "v2", 0.8, 50, 0.2),
]


def test_by_version(evals):
    got = qg.drift_by_version(evals(DATA)).collect()
    assert [tuple(r)[:2] for r in got] == [("v1", 2), ("v10", 1), ("v2", 2)]
    assert [r.mean_quality for r in got] == pytest.approx([0.7, 0.3, 0.6])
    assert [r.total_cost for r in got] == pytest.approx([0.2, 0.2, 0.4])
    report = qg.drift_report(evals(DATA)).collect()
    assert [r.p95_latency_ms for r in report] == [30.0, 20.0, 50.0]
    assert report[0].asDict().keys() == {"deployment_version", "n_rows", "mean_quality", "total_cost_usd", "p95_latency_ms"}


def test_trend_orders_names_as_text(evals):
    got = {r.deployment_version: r.drift_vs_previous for r in qg.drift_trend(evals(DATA)).collect()}
    assert got["v1"] is None
    assert (got["v10"], got["v2"]) == pytest.approx((-0.4, 0.3))
    numbered = evals(DATA).withColumn("number", F.substring("deployment_version", 2, 9).cast("int"))
    got = {r.deployment_version: r.drift_vs_previous for r in qg.drift_trend(numbered, "number").collect()}
    assert (got["v2"], got["v10"]) == pytest.approx((-0.1, -0.3))


def test_semantic_drift(evals):
    assert qg.semantic_drift(evals(DATA)).first()[0] == pytest.approx(0.1)
    assert qg.semantic_drift(evals(DATA[:2])).first()[0] == 0.0
    assert qg.semantic_drift(evals([])).first()[0] == 0.0


def test_latency_percentiles(evals):
    rng = random.Random(3)
    data = [(str(i), f"v{i % 3}", 0.5, rng.randrange(100), 0) for i in range(301)]
    got = rows(qg.latency_percentiles(evals(data), (50, 95)))
    by = {v: [r[3] for r in data if r[1] == v] for v in ("v0", "v1", "v2")}
    assert got == [(v, at_percent(x, 50), at_percent(x, 95)) for v, x in by.items()]
    overall = rows(qg.latency_percentiles(evals(data), (50,), by=()))
    assert overall == [(at_percent([r[3] for r in data], 50),)]


def test_disagreement(spark, evals):
    labels = spark.createDataFrame(
        [("1", "v1", True), ("2", "v1", False), ("2", "v2", True), ("7", "v7", True), ("1", "v10", None)], LABELS
    )
    got = qg.confusion_counts(evals(DATA), labels).first()
    assert tuple(got)[:5] == (4, 0, 1, 2, 1)
    assert got.false_positive_rate == pytest.approx(1 / 3) and got.disagreement_rate == 0.5
    # a quality right at the threshold says good
    assert qg.disagreement_rate(evals(DATA[1:2]), labels).first()[1] == 1.0
    nothing = qg.disagreement_rate(evals(DATA), labels.filter("row_id = '7'")).first()
    assert tuple(nothing) == (0, None)


def test_last_label_wins(spark, evals):
    labels = spark.createDataFrame(
        [("1", "v1", True, 1), ("1", "v1", False, 2), ("1", "v1", True, 0)], LABELS + ", at int"
    )
    assert qg.disagreement_rate(evals(DATA[:1]), labels, label_order=F.col("at")).first()[1] == 1.0
    assert qg.disagreement_rate(evals(DATA[:1]), labels).first()[1] == 0.0


def test_loop_metrics(spark, evals):
    labels = evals(DATA).select("row_id", "deployment_version", (F.col("deployment_version") == "v1").alias("is_good"))
    got = qg.loop_metrics(evals(DATA), labels).first()
    latencies = [r[3] for r in DATA]
    assert got.backend == "b" and got.rows_evaluated == 5
    assert got.mean_quality_by_version == pytest.approx({"v1": 0.7, "v10": 0.3, "v2": 0.6})
    assert got.semantic_drift == pytest.approx(0.1)
    assert got.disagreement_rate == pytest.approx(1 / 5)
    assert got.p50_latency_ms == at_percent(latencies, 50)
    assert got.p95_latency_ms == at_percent(latencies, 95)
    assert got.total_cost_usd == pytest.approx(0.8) and got.cost_per_row_usd == pytest.approx(0.16)


def test_loop_metrics_of_nothing(evals):
    got = qg.loop_metrics(evals([])).first().asDict()
    assert got == {
        "backend": "n/a", "rows_evaluated": 0, "mean_quality_by_version": {}, "semantic_drift": 0.0,
        "disagreement_rate": None, "p50_latency_ms": 0.0, "p95_latency_ms": 0.0, "total_cost_usd": 0.0,
        "cost_per_row_usd": 0.0,
    }


def test_published_figures_keep_their_shape(evals):
    """13 rows per version, 8 of 26 verdicts against the labels: 31 percent."""
    data = [(str(i), "v1", 0.933, 1, 0) for i in range(13)]
    data += [(str(i), "v2", 0.9 if i < 8 else 0.1, 1, 0) for i in range(13)]
    labels = evals(data).select("row_id", "deployment_version", (F.col("deployment_version") == "v1").alias("is_good"))
    rate = qg.disagreement_rate(evals(data), labels).first()
    assert rate.compared == 26 and f"{rate.disagreement_rate:.0%}" == "31%"


def test_labels_by_composite_key(spark, evals):
    from qualitygate.functions import row_key

    keyed = evals(DATA[:2] + [("a@b", "v1", 0.9, 1, 0)]).select(
        row_key(F.col("row_id"), F.col("deployment_version")).alias("key"), F.lit(True).alias("is_good")
    )
    assert rows(keyed, "key") == [("1@v1",), ("2@v1",), ("a@b@v1",)]
    assert rows(qg.labels_from_keys(keyed)) == [("1", "v1", True), ("2", "v1", True), ("a@b", "v1", True)]
