import duckdb
import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.functions import is_blank, is_not_allowed, is_older_than
from tests.conftest import rows

EDGES = [None, "", " ", " ", "  　", "\t", "\n", " \n", "x", " x ", "　x", " \t", "0", "​", " "]


def test_blank_equals_trim_rule(spark):
    con = duckdb.connect()
    want = [con.execute("SELECT ? IS NULL OR length(trim(?)) = 0", [e, e]).fetchall()[0][0] for e in EDGES]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(EDGES)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(is_blank(F.col("s"))).collect()]
    assert got == want


def test_enum_null_passes_unless_asked(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    assert [r[0] for r in df.select(is_not_allowed(F.col("s"), ["a"])).collect()] == [False, True, False]
    assert [r[0] for r in df.select(is_not_allowed(F.col("s"), ["a"], True)).collect()] == [False, True, True]
    with pytest.raises(ValueError):
        is_not_allowed(F.col("s"), [])


def test_freshness_is_strict(spark):
    df = spark.createDataFrame([("2024-01-11",), ("2024-01-10",), (None,)], "d string").select(F.to_date("d").alias("d"))
    stale = is_older_than(F.col("d"), F.lit("2024-02-10").cast("date"), 30)
    assert [r[0] for r in df.select(stale).collect()] == [False, True, False]


DATA = [
    ("1", "v1", "t", "billing", "ok", "2024-02-01"),
    ("1", "v1", "t", "billing", " ", "2024-02-01"),
    ("1", "v1", "t", "weird", "ok", "2024-02-01"),
    (None, "v1", "t", None, None, "2020-01-01"),
    (None, "v1", "t", "other", " ", None),
    ("2", "v1", "t", "other", "\t", "2024-01-11"),
    ("1", "v2", "t", "other", "ok", "2024-02-01"),
]


def report(tickets, **more):
    df = qg.sources.conform(tickets(DATA), qg.TICKETS)
    return qg.check_report(df, qg.TICKETS, F.lit("2024-02-10").cast("date"), **more)


def test_report(tickets):
    columns = ("deployment_version", "total_rows", "completeness", "schema", "uniqueness", "freshness", "all_passed")
    got = rows(report(tickets), *columns)
    assert got == [("v1", 6, 3, 1, 2, 1, False), ("v2", 1, 0, 0, 0, 0, True)]


def test_absent_version_passes_with_no_rows(tickets):
    got = rows(report(tickets, versions=["v2", "v9"]))
    assert got == [("v2", 1, 0, 0, 0, 0, True), ("v9", 0, 0, 0, 0, 0, True)]


def test_long_forms(tickets):
    r = report(tickets)
    assert rows(qg.failing_versions(r)) == [
        ("v1", "completeness", 3), ("v1", "freshness", 1), ("v1", "schema", 1), ("v1", "uniqueness", 2),
    ]
    assert rows(qg.failing_versions(r, "schema")) == [("v1", "schema", 1)]
    assert ("v1", "uniqueness", "2 FAIL") in rows(qg.check_statuses(r))
    assert ("v2", "uniqueness", "PASS") in rows(qg.check_statuses(r))


def test_duplicated_ids_and_passing_rows(tickets):
    df = qg.sources.conform(tickets(DATA), qg.TICKETS)
    assert rows(qg.duplicated_ids(df)) == [("v1", "1", 3), ("v1", None, 2)]
    kept = qg.passing_rows(df, qg.TICKETS, F.lit("2024-02-10").cast("date"))
    assert rows(kept, "row_id", "deployment_version", "resolution_summary") == [
        ("1", "v1", "ok"), ("1", "v2", "ok"), ("2", "v1", "\t"),
    ]


def test_report_reads_once_and_moves_partial_rows(spark, tickets, tmp_path):
    qg.write_table(tickets(DATA), qg.TICKETS, str(tmp_path / "t"))
    df = qg.read_table(spark, qg.TICKETS, str(tmp_path / "t"))
    plan = qg.check_report(df, qg.TICKETS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "ticket_text" not in plan.split("ReadSchema")[1]
    one = qg.check_report(df, qg.TICKETS, versions=["v1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(deployment_version" in one


def test_a_ledger_of_parts_equals_one_scan(spark, tickets, tmp_path):
    df = qg.sources.conform(tickets(DATA), qg.TICKETS)
    ledger = qg.CheckLedger(spark, str(tmp_path / "ledger"), qg.TICKETS)
    as_of = F.lit("2024-02-10").cast("date")
    assert rows(ledger.report(as_of)) == []
    first = df.filter("resolution_summary = 'ok'")
    ledger.add(first, "a")
    assert rows(ledger.report(as_of)) == rows(qg.check_report(first, qg.TICKETS, as_of))
    for part in ("b", "b"):  # the same part again replaces it
        ledger.add(df.filter("resolution_summary is null or resolution_summary != 'ok'"), part)
    for more in ({}, {"versions": ["v2", "v9"]}, {"max_age_days": 10_000}):
        assert rows(ledger.report(as_of, **more)) == rows(qg.check_report(df, qg.TICKETS, as_of, **more))
    assert rows(ledger.report()) == rows(qg.check_report(df, qg.TICKETS))
    assert rows(ledger.repeated_ids()) == rows(qg.duplicated_ids(df))
    compact = ledger.compact(str(tmp_path / "compact"))
    compact.add(df, "c")
    assert rows(compact.report(as_of)) == rows(qg.check_report(df.unionByName(df), qg.TICKETS, as_of))
    plan = ledger.report(as_of)._jdf.queryExecution().executedPlan().toString()
    assert "resolution_summary" not in plan and "ticket_text" not in plan


def test_a_ledger_where_null_is_invalid(spark, tickets, tmp_path):
    df = qg.sources.conform(tickets(DATA), qg.TICKETS)
    ledger = qg.CheckLedger(spark, str(tmp_path / "ledger"), qg.TICKETS, null_is_invalid=True)
    ledger.add(df, "all")
    assert rows(ledger.report()) == rows(qg.check_report(df, qg.TICKETS, null_is_invalid=True))
