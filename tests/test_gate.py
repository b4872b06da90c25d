import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.operators import gate
from qualitygate.plans import ranking
from qualitygate.spec import EVALUATION, Options
from tests.conftest import rows


@pytest.fixture
def evals(spark):
    def make(by_version):
        data = [
            (f"r{i}", v, None, q, "b", 1.0, 0.0) for v, qs in by_version.items() for i, q in enumerate(qs)
        ]
        return spark.createDataFrame(data, EVALUATION)

    return make


# qualities of the version, baseline, then what has to come out
CASES = [
    ([0.5, 0.5], None, "open", 0.5, 0.0, "mean quality 0.50 < floor 0.70", 2),
    ([0.75, 0.75], 0.90625, "open", 0.75, 0.15625, "semantic drift 0.16 > 0.15", 2),
    ([0.75, 0.75], 0.875, "closed", 0.75, 0.125, "mean quality 0.75 within tolerance (drift 0.12 <= 0.15)", 0),
    ([0.7], None, "closed", 0.7, 0.0, "mean quality 0.70 within tolerance (drift 0.00 <= 0.15)", 0),
    ([0.625], 0.875, "open", 0.625, 0.25, "semantic drift 0.25 > 0.15; mean quality 0.62 < floor 0.70", 1),
    ([1.0, 0.75], 0.5, "closed", 0.875, -0.375, "mean quality 0.88 within tolerance (drift -0.38 <= 0.15)", 0),
    ([], 0.9, "closed", 1.0, 0.0, "no rows evaluated", 0),
    ([0.0, 0.25, 0.5, 0.25], 0.75, "open", 0.25, 0.5, "semantic drift 0.50 > 0.15; mean quality 0.25 < floor 0.70", 3),
    ([None, None], 0.75, "open", None, 0.0, "no quality among the rows evaluated", 2),
]


@pytest.mark.parametrize("case", CASES, ids=str)
def test_decision(evals, case):
    qs, baseline, *want = case
    got = qg.decide(evals({"v2": qs, "v8": [0.2]}), ["v2"], baseline).first()
    assert [got.state, got.mean_quality, got.drift_vs_baseline, got.reason, got.routed_to_review] == want
    assert got.threshold == 0.15


def outcome_of(spark, *rows):
    return spark.createDataFrame(rows, "deployment_version string, n_routed long, n_rejected long")


@pytest.mark.parametrize("allowed,state", [(0.0, "open"), (0.24, "open"), (0.25, "closed")])
def test_rejected_rows_open_the_gate(spark, evals, allowed, state):
    outcome = outcome_of(spark, ("v2", 4, 1), ("v3", 5, 5), (None, 2, 2), ("v4", 0, 0))
    got = {r.deployment_version: r for r in qg.decide(evals({"v2": [0.9] * 3}), options=Options(max_rejected=allowed), outcome=outcome).collect()}
    assert got["v2"].state == state and got["v3"].state == got[None].state == "open" and got["v4"].state == "closed"
    assert got["v3"].reason == "none of 5 routed rows could be scored"
    assert got["v4"].reason == "no rows evaluated"
    if state == "open":
        assert got["v2"].reason == "1 of 4 routed rows could not be scored" and got["v2"].routed_to_review == 3


def test_scoring_outcome_counts_keys(spark, evals):
    routed = spark.createDataFrame([("r0", "v1"), ("r0", "v1"), ("r1", "v1"), (None, "v1"), ("r0", None)], "row_id string, deployment_version string")
    got = {tuple(r) for r in qg.scoring_outcome(routed, evals({"v1": [0.5], "v9": [0.5]})).collect()}
    assert got == {("v1", 3, 2), (None, 1, 1)}


def test_drift_exactly_at_threshold_is_closed(evals):
    options = Options(drift_threshold=0.25, quality_floor=0.5)
    got = qg.decide(evals({"v2": [0.5]}), baseline=0.75, options=options).first()
    assert (got.state, got.tripped_by_drift, got.tripped_by_floor) == ("closed", False, False)


def test_baseline_by_name(evals):
    df = evals({"v1": [1.0, 0.8], "v2": [0.5, 0.6]})
    one = qg.decide(df, ["v2"], "v1").collect()
    assert [r.deployment_version for r in one] == ["v2"]
    assert one[0].drift_vs_baseline == pytest.approx(0.35)
    everything = {r.deployment_version: r for r in qg.decide(df, baseline="v1").collect()}
    assert everything["v1"].drift_vs_baseline == 0.0 and everything["v2"].state == "open"
    absent = qg.decide(df, ["v2", "v9"], "v7").collect()
    assert {(r.deployment_version, r.drift_vs_baseline, r.mean_quality) for r in absent} == {
        ("v2", 0.0, 0.55), ("v9", 0.0, 1.0),
    }


def test_gate_reads_evaluations_once(spark, evals, tmp_path):
    evals({"v1": [1.0], "v2": [0.1]}).write.parquet(str(tmp_path / "e"))
    df = spark.read.schema(EVALUATION).parquet(str(tmp_path / "e"))
    plan = qg.decide(df, ["v2"], "v1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CartesianProduct" not in plan


@pytest.mark.parametrize("k_limit,small", [(1000, 100_000), (0, 100_000), (0, 0)])
def test_worst_rows(evals, monkeypatch, many_partitions, k_limit, small):
    monkeypatch.setattr(gate, "WINDOW_K", k_limit)
    monkeypatch.setattr(ranking, "SMALL_TABLE_ROWS", small)
    df = evals({"v1": [0.3, 0.1, 0.3, 0.3, 0.2], "v2": [0.9], "v3": [0.5] * 40})
    got = rows(qg.worst_rows(df.repartition(6), 3), "deployment_version", "row_id", "quality")
    assert got == [
        ("v1", "r0", 0.3), ("v1", "r1", 0.1), ("v1", "r4", 0.2), ("v2", "r0", 0.9),
        ("v3", "r0", 0.5), ("v3", "r1", 0.5), ("v3", "r10", 0.5),
    ]


def test_small_k_is_cut_before_the_shuffle(evals):
    plan = qg.worst_rows(evals({"v1": [0.1]}), 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("k_limit,small", [(1000, 100_000), (0, 100_000), (0, 0)])
def test_rows_without_quality_come_last(evals, monkeypatch, many_partitions, k_limit, small):
    monkeypatch.setattr(gate, "WINDOW_K", k_limit)
    monkeypatch.setattr(ranking, "SMALL_TABLE_ROWS", small)
    df = evals({"v1": [None, 0.5, None, 0.5, 0.9], "v2": [None] * 3})
    got = rows(qg.worst_rows(df.repartition(4), 4), "deployment_version", "row_id", "quality")
    assert got == sorted([("v1", "r1", 0.5), ("v1", "r3", 0.5), ("v1", "r4", 0.9), ("v1", "r0", None), *[("v2", f"r{i}", None) for i in range(3)]], key=repr)


@pytest.mark.parametrize("limit", [1000, 0])
def test_release_keeps_rows_without_a_version(spark, monkeypatch, limit):
    monkeypatch.setattr(gate, "INLINE_VERSIONS", limit)
    df = spark.createDataFrame([("a", None), ("b", "v1"), ("c", "v2")], "row_id string, deployment_version string")
    decisions = spark.createDataFrame([(None, "closed"), ("v1", "closed"), ("v2", "open")], "deployment_version string, state string")
    assert rows(qg.release(df, decisions), "row_id") == [("a",), ("b",)]


@pytest.mark.parametrize("limit", [1000, 0])
def test_review_and_release(evals, monkeypatch, limit):
    monkeypatch.setattr(gate, "INLINE_VERSIONS", limit)
    df = evals({"v1": [0.9, 0.9], "v2": [0.1, 0.9, 0.2, 0.3, 0.4], "v3": [0.8]})
    decisions = qg.decide(df, baseline="v1")
    queue = rows(qg.review_queue(df, decisions, 3, "why"))
    assert queue == [("v2", "r0", 0.1, "why"), ("v2", "r2", 0.2, "why"), ("v2", "r3", 0.3, "why")]
    assert rows(qg.release(df, decisions).select("deployment_version").distinct()) == [("v1",), ("v3",)]
    none = decisions.withColumn("state", F.lit("open"))
    assert qg.release(df, none).count() == 0
