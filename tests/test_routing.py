import hashlib

import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.plans import ranking
from tests.conftest import rows


@pytest.fixture
def hundred(tickets):
    return tickets([(f"T{i:03d}", "v1", f"text {i}", "other", "s", "2024-01-01") for i in range(100)])


@pytest.mark.parametrize(
    "rate,n,small",
    [(1.0, 100, 0), (1.5, 100, 0), (0.29, 28, 0), (0.29, 28, 100_000), (0.0, 1, 100_000), (-1, 1, 0), (0.999, 99, 0)],
)
def test_prefix_size_and_order(hundred, many_partitions, monkeypatch, rate, n, small):
    monkeypatch.setattr(ranking, "SMALL_TABLE_ROWS", small)
    got = qg.route_prefix(hundred, qg.TICKETS, rate, "v1")
    assert got.columns == ["row_id", "deployment_version", "ticket_text", "category", "resolution_summary"]
    assert [r[0] for r in rows(got)] == [f"T{i:03d}" for i in range(n)]


def test_absent_version_routes_nothing(hundred):
    assert rows(qg.route_prefix(hundred, qg.TICKETS, 0.5, "v7")) == []


def test_hash_sample_is_md5_and_agrees_between_versions(hundred):
    both = qg.stack_versions(hundred, qg.fork_version(hundred, "v2"))
    got = rows(qg.route_hash_sample(both, qg.TICKETS, 0.3), "deployment_version", "row_id")
    want = [f"T{i:03d}" for i in range(100)]
    want = [w for w in want if int(hashlib.md5(w.encode()).hexdigest()[:8], 16) < 0.3 * 2**32]
    assert got == sorted([(v, w) for v in ("v1", "v2") for w in want])


def test_passing_only(tickets):
    df = tickets([("1", "v1", "t", "other", "", "2024-01-01"), ("2", "v1", "t", "other", "s", "2024-01-01")])
    assert [r[0] for r in rows(qg.route_passing(df, qg.TICKETS))] == ["2"]


def test_in_order_puts_nulls_last(tickets):
    df = tickets([(i, "v1", "t", "other", "s", "2024-01-01") for i in ("b", None, "a")])
    assert [r.row_id for r in qg.in_order(df, "row_id").collect()] == ["a", "b", None]


def test_wide_rows_are_not_shuffled_for_a_prefix(spark, hundred, monkeypatch, tmp_path):
    monkeypatch.setattr(ranking, "SMALL_TABLE_ROWS", 0)
    qg.write_table(hundred, qg.TICKETS, str(tmp_path / "t"))
    df = qg.read_table(spark, qg.TICKETS, str(tmp_path / "t"))
    plan = qg.route_prefix(df, qg.TICKETS, 0.3, "v1")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
