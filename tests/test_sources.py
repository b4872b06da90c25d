import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.operators.versions import _ids_that_differ
from qualitygate.sources import as_metrics, conform, read_csv, read_json, write_csv, write_json, write_json_array
from qualitygate.spec import EVALUATION, MANIFEST
from tests.conftest import rows

AWKWARD = [
    ("1", "v1", 'says "no", twice', "billing", "line one\nline two", "2024-01-05"),
    ("2", "v1", " padded ", "other", "", "2024-01-05"),
    ("3", "v1", None, "account", "back\\slash", "2024-01-05"),
    ("4", "2024", "ünïcode 　", "technical", "tab\there, comma", None),
    ("5", "v1", '"', "other", "\r\n", "2024-01-05"),
]


def test_table_round_trip_and_full_refresh(spark, tickets, tmp_path):
    path = str(tmp_path / "t")
    qg.write_table(tickets(AWKWARD), qg.TICKETS, path)
    qg.write_table(tickets(AWKWARD), qg.TICKETS, path)
    back = qg.read_table(spark, qg.TICKETS, path)
    assert back.schema == qg.TICKETS.schema
    assert rows(back) == rows(conform(tickets(AWKWARD), qg.TICKETS))
    assert back.filter("row_id = '1'").first().created_at == dt.date(2024, 1, 5)
    qg.replace_version(tickets([("9", "2024", "t", "other", "s", "2024-01-05")]), qg.TICKETS, path)
    ids = rows(qg.read_table(spark, qg.TICKETS, path), "deployment_version", "row_id")
    assert ids == [("2024", "9"), ("v1", "1"), ("v1", "2"), ("v1", "3"), ("v1", "5")]


def test_bad_dates(tickets):
    df = tickets([("1", "v1", "t", "other", "s", "yesterday")])
    with pytest.raises(Exception, match="yesterday"):
        conform(df, qg.TICKETS).collect()
    assert conform(df, qg.TICKETS, on_bad_date="null").first().created_at is None


def test_csv_and_json_round_trips(spark, tickets, tmp_path):
    df = conform(tickets(AWKWARD), qg.TICKETS)
    write_csv(df, str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c"), df.schema, line_breaks=True)) == rows(df)
    write_json(df, str(tmp_path / "j"))
    assert rows(read_json(spark, str(tmp_path / "j"), df.schema)) == rows(df)


def test_json_array_files_and_plain_csv(spark, tmp_path):
    record = dict(zip(qg.TICKETS.columns, AWKWARD[0]))
    (tmp_path / "a.json").write_text(json.dumps([record, {**record, "row_id": "2"}], indent=2))
    got = read_json(spark, str(tmp_path / "a.json"), qg.TICKETS.schema, array=True)
    assert [r.row_id for r in got.orderBy("row_id").collect()] == ["1", "2"]
    import csv

    with (tmp_path / "a.csv").open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(qg.TICKETS.columns)
        writer.writerows(AWKWARD[:1])
    got = read_csv(spark, str(tmp_path / "a.csv"), qg.TICKETS.schema, line_breaks=True).first()
    assert (got.ticket_text, got.resolution_summary) == (AWKWARD[0][2], AWKWARD[0][4])


@pytest.fixture
def evals(spark):
    def make(*data):
        answer = {"k": ("k", "choice", None, "it's", None, 0.5)}
        return spark.createDataFrame([(i, v, answer, q, "b", 1.0, 0.0) for i, v, q in data], EVALUATION)

    return make


def at(text):
    return F.lit(text).cast("timestamp")


def test_log_appends_and_reads_back(spark, evals, tmp_path):
    log = qg.MetricsLog(spark, str(tmp_path / "log")).create()
    assert log.read().count() == 0
    first = evals(("1", "v1", 0.5), ("2", "v1", 0.6))
    log.append(first, "a", at("2024-01-01 10:00:00"))
    log.append(first, "a", at("2024-01-01 10:00:00"))
    log.create()
    assert log.read().count() == 4
    assert log.evaluations().schema == EVALUATION
    assert rows(log.evaluations()) == rows(first.union(first))
    stored = json.loads(log.read().first().answers_json)
    assert stored["k"] == {"key": "k", "type": "choice", "noul": None, "choice": "it's", "score": None, "confidence": 0.5}
    log.append(evals(("1", "v1", 0.9)), "b", at("2024-01-02 09:00:00"))
    assert log.read(since="2024-01-02").count() == 1
    assert "PartitionFilters: [isnotnull(scored_date" in log.read("2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert rows(log.latest(), "row_id", "quality") == [("1", 0.9), ("2", 0.6)]


def test_scored_at_defaults_to_now(evals):
    got = as_metrics(evals(("1", "v1", 0.5))).first()
    assert got.scored_date == got.scored_at.date() and abs((dt.datetime.now() - got.scored_at).total_seconds()) < 86_400


def test_manifest(spark, tickets, tmp_path):
    df = tickets(
        [
            ("1", "v1", "same", "billing", "good", None),
            ("1", "v2", "same", "other", "bad", None),
            ("2", "v1", "only old", "other", "s", None),
            ("3", "v2", "only new", "other", "s", None),
            ("4", "v1", "t", None, None, None),
            ("4", "v2", "t", "other", None, None),
            ("5", "v1", "t", "other", "early", None),
            ("5", "v1", "t", "other", "late", None),
            ("5", "v2", "t", "other", "late", None),
            ("6", "v1", "new item", "other", "s", None),
            ("6", "v2", None, "other", "s", None),
            (None, "v1", "n", "other", "s", None),
            (None, "v2", "n", "other", "z", None),
        ]
    )
    want = [
        ("1", "same", "category", "billing", "other"),
        ("1", "same", "resolution_summary", "good", "bad"),
        ("4", "t", "category", None, "other"),
        ("6", "new item", "ticket_text", "new item", None),
        (None, "n", "resolution_summary", "s", "z"),
    ]
    ordered = qg.manifest_in_order(qg.drift_manifest(df, qg.TICKETS))
    assert [tuple(r) for r in ordered.collect()] == want
    qg.export_drift(df, qg.TICKETS, str(tmp_path))
    assert rows(read_csv(spark, str(tmp_path / "tickets_drift.csv"), MANIFEST)) == sorted(want, key=repr)
    assert rows(read_json(spark, str(tmp_path / "tickets_drift.json"), MANIFEST)) == sorted(want, key=repr)


def test_export_all_counts(spark, tickets, tmp_path):
    v1 = conform(tickets([r for r in AWKWARD if r[1] == "v1"]), qg.TICKETS)
    v2 = qg.fork_version(v1, "v2", {"category": F.lit("other")})
    both = qg.stack_versions(v1, v2)
    assert qg.export_all({"tickets": (qg.TICKETS, both)}, str(tmp_path)) == {"tickets": (8, 2)}
    assert rows(read_csv(spark, str(tmp_path / "tickets.csv"), qg.TICKETS.schema, line_breaks=True)) == rows(both)


def test_manifest_moves_no_text_of_unchanged_rows(spark, tickets, tmp_path):
    """Digests are compared by a hash aggregation; texts are fetched for the ids named by it."""
    qg.write_table(tickets(AWKWARD), qg.TICKETS, str(tmp_path / "t"))
    df = qg.read_table(spark, qg.TICKETS, str(tmp_path / "t"))
    first = _ids_that_differ(df, qg.TICKETS.text_columns, "v1", "v2")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in first.split("\n") if "Exchange" in line or "Aggregate" in line]
    assert "HashAggregate" in first and "SortAggregate" not in first
    assert not any(c in line.split("functions")[-1] for line in moved for c in qg.TICKETS.text_columns)
    plan = qg.drift_manifest(df, qg.TICKETS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_digests_tell_nulls_and_shifted_texts_apart(spark):
    pairs = [(("a", None), (None, "a")), ((None, None), ("", "")), (("ab", "c"), ("a", "bc")), (("x", None), ("x", None))]
    data = [(str(i), v, *texts) for i, pair in enumerate(pairs) for v, texts in zip(("v1", "v2"), pair, strict=True)]
    df = spark.createDataFrame(data, "row_id string, deployment_version string, x string, y string")
    assert rows(_ids_that_differ(df, ["x", "y"], "v1", "v2")) == [("0",), ("1",), ("2",)]


def test_a_log_with_key_buckets_reads_those_asked_for(spark, tmp_path):
    fixed = qg.ExpressionEvaluator({q.key: "1.0D" for q in qg.TICKETS.questions})
    columns = "row_id string, deployment_version string, ticket_text string, category string, resolution_summary string"
    many = spark.createDataFrame([(str(i) if i else None, "v1", "t", "other", "s") for i in range(300)], columns)
    evals = qg.score(many, qg.TICKETS, fixed)
    plain = qg.MetricsLog(spark, str(tmp_path / "plain"))
    log = qg.MetricsLog(spark, str(tmp_path / "log"), buckets=8).create()
    for day in ("2024-01-01", "2024-01-02"):
        for one in (plain, log):
            one.append(evals.filter("row_id is null or row_id % 2 = 0"), "a", F.lit(day).cast("timestamp"))
    assert rows(log.read(), "row_id", "scored_date") == rows(plain.read(), "row_id", "scored_date")
    few = spark.createDataFrame([(i, "v1", "t", "other", "s") for i in (None, "4", "5")], columns)
    for asked in (few, few.filter("row_id is not null"), many):
        want = rows(qg.unscored(asked, plain.read()), "row_id")
        assert rows(qg.unscored(asked, log.seen()), "row_id") == rows(qg.unscored(asked, plain.seen("expression")), "row_id") == want
    assert rows(qg.unscored(few, log.seen("another")), "row_id") == rows(few, "row_id")
    keys = few.filter("row_id = '4'").select("row_id", "deployment_version")
    read = log.seen()(keys)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 2 and "EqualTo(row_id,4)" in plan and "key_of_8" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert read.select(F.input_file_name()).distinct().count() == 2 < log.read().select(F.input_file_name()).distinct().count() / 4
    before = rows(log.read(), "row_id", "scored_at")
    log.append(evals.filter("row_id = 7"), "b", F.lit("2024-01-01").cast("timestamp"))
    log.compact("2024-01-01")
    assert len(rows(log.read())) == len(before) + 1
    assert log.read().filter("scored_date = '2024-01-01'").select(F.input_file_name()).distinct().count() == 8
    with pytest.raises(ValueError, match="8 key buckets"):
        qg.MetricsLog(spark, str(tmp_path / "log"), buckets=4).append(evals)
    with pytest.raises(ValueError, match="no key buckets"):
        qg.MetricsLog(spark, str(tmp_path / "plain"), buckets=4).append(evals)
    with pytest.raises(ValueError):
        plain.compact("2024-01-01")


def test_json_arrays(spark, tickets, tmp_path):
    df = conform(tickets(AWKWARD), qg.TICKETS)
    for i, some in enumerate((df.coalesce(1), df.repartition(3), df.limit(0))):
        path = str(tmp_path / str(i))
        write_json_array(some, path)
        files = [json.loads(f.read_text()) for f in (tmp_path / str(i)).glob("part-*")]
        assert sum(map(len, files)) == some.count() and all(list(r) == df.columns for f in files for r in f)
        assert rows(read_json(spark, path, df.schema, array=True)) == rows(some)


def test_torn_csv_records_end_the_job(spark, tickets, tmp_path):
    df = conform(tickets(AWKWARD), qg.TICKETS)
    write_csv(df, str(tmp_path / "csv"))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "csv"), df.schema).collect()
    assert rows(read_csv(spark, str(tmp_path / "csv"), df.schema, line_breaks=True)) == rows(df)


def test_rows_in_and_evaluations_out(spark):
    body = json.dumps({"rows": [
        {"row_id": "T1", "deployment_version": "v2", "ticket_text": "charged twice", "category": "billing",
         "resolution_summary": "see settings"},
        {"row_id": "T2", "deployment_version": "v2", "ticket_text": "x"},
    ]})
    df = spark.createDataFrame([(body,), ('{"rows": []}',)], "body string")
    parsed = qg.rows_from_json(df, qg.TICKETS)
    assert rows(parsed) == [
        ("T1", "v2", "charged twice", "billing", "see settings"), ("T2", "v2", "x", None, None),
    ]
    fixed = qg.ExpressionEvaluator({q.key: "1.0D" for q in qg.TICKETS.questions})
    out = [json.loads(r[0]) for r in qg.evaluations_to_json(qg.score(parsed, qg.TICKETS, fixed)).collect()]
    assert sorted(o["row_id"] for o in out) == ["T1", "T2"]
    assert out[0]["answers"]["category_correct"]["noul"] == 1.0 and out[0]["answers"]["category_correct"]["score"] is None
