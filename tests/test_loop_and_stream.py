import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.spec import Options
from tests.conftest import rows

GOOD = qg.ExpressionEvaluator(
    {
        "summary_addresses_ticket": "CASE WHEN resolution_summary LIKE '%fixed%' THEN 0.95D ELSE 0.2D END",
        "category_correct": "0.9D",
        "resolution_quality": "CASE WHEN resolution_summary LIKE '%fixed%' THEN 5.0D ELSE 2.0D END",
    },
    tokens="length(ticket_text)",
)


@pytest.fixture
def two_versions(tickets):
    v1 = [(f"T{i:02d}", "v1", f"problem {i}", "billing", f"fixed {i}", "2024-02-01") for i in range(13)]
    v2 = [(f"T{i:02d}", "v2", f"problem {i}", "billing", f"see page {i}", "2024-02-01") for i in range(13)]
    return qg.sources.conform(tickets(v1 + v2), qg.TICKETS)


@pytest.mark.parametrize("slices", [1, 3])
def test_every_check_passes_and_the_gate_opens(spark, two_versions, tmp_path, slices):
    log = qg.MetricsLog(spark, str(tmp_path / "log"))
    day = F.lit("2024-02-10").cast("date")
    result = qg.run_loop(two_versions, qg.TICKETS, GOOD, log, "v1", ["v2"], as_of=day, slices=slices)
    assert [r.all_passed for r in result.report.collect()] == [True, True]
    assert [r.total_rows for r in result.report.collect()] == [13, 13]
    decision = result.decisions.first()
    assert decision.state == "open" and decision.tripped_by_drift and decision.tripped_by_floor
    assert decision.routed_to_review == 3
    assert rows(result.review(), "row_id", "why_flagged") == [
        (f"T0{i}", qg.TICKETS.review_reason) for i in range(3)
    ]
    metrics = result.metrics().first()
    assert metrics.rows_evaluated == 26 and metrics.semantic_drift > 0.15
    assert log.read().count() == 26
    assert [r.n_rows for r in result.history().collect()] == [13, 13]
    assert result.trend().count() == 2


def test_going_on_after_a_break_scores_only_what_is_missing(spark, two_versions, tmp_path):
    log = qg.MetricsLog(spark, str(tmp_path / "log"))
    part = two_versions.filter("row_id < 'T05'")
    qg.run_loop(part, qg.TICKETS, GOOD, log, "v1", ["v2"])
    result = qg.run_loop(two_versions, qg.TICKETS, GOOD, log, "v1", ["v2"], skip_scored=True)
    assert log.read().count() == 26 and rows(qg.distinct_keys(log.read())) == [(26,)]
    assert result.evaluations.count() == 26
    qg.run_loop(part, qg.TICKETS, GOOD, log, "v1", ["v2"])
    assert log.read().count() == 36


def test_a_sampled_loop(spark, two_versions, tmp_path):
    log = qg.MetricsLog(spark, str(tmp_path / "log"))
    result = qg.run_loop(two_versions, qg.TICKETS, GOOD, log, "v1", ["v2"], options=Options(sample_rate=0.5))
    assert rows(result.evaluations.groupBy("deployment_version").count()) == [("v1", 6), ("v2", 6)]


def stream_of(spark, path):
    return spark.readStream.schema(qg.TICKETS.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_and_replays_add_nothing(spark, two_versions, tmp_path):
    source = str(tmp_path / "in")
    two_versions.repartition(3).write.parquet(source)
    two_versions.limit(5).write.mode("append").parquet(source)
    log = qg.MetricsLog(spark, str(tmp_path / "log"))

    def run(checkpoint):
        job = qg.score_stream(stream_of(spark, source), qg.TICKETS, GOOD, log, str(tmp_path / checkpoint))
        job.awaitTermination()
        return rows(log.read(), "row_id", "deployment_version", "quality")

    batch = rows(qg.score(two_versions, qg.TICKETS, GOOD), "row_id", "deployment_version", "quality")
    assert run("c1") == batch
    assert run("c1") == batch
    assert run("lost-checkpoint") == batch
    fork = qg.fork_version(two_versions.filter("deployment_version = 'v1'"), "v3")
    fork.write.mode("append").parquet(source)
    assert len(run("c1")) == 39


def test_a_batch_that_comes_in_one_file_is_worked_off_in_many(spark, two_versions, tmp_path, monkeypatch):
    monkeypatch.setattr("qualitygate.streaming.scoring.ROWS_PER_FILE", 4)
    source, log, held = str(tmp_path / "in"), qg.MetricsLog(spark, str(tmp_path / "log")), []
    two_versions.coalesce(1).write.parquet(source)

    def look(batch, batch_id):
        held.extend(r["count"] for r in batch.groupBy(F.input_file_name()).count().collect())

    job = qg.score_stream(stream_of(spark, source), qg.TICKETS, GOOD, log, str(tmp_path / "checkpoint"), on_batch=look)
    job.awaitTermination()
    assert sum(held) == 26 and max(held) <= 4
    assert log.read().count() == 26 and rows(qg.distinct_keys(log.read())) == [(26,)]


def test_a_version_that_could_not_be_scored_is_blocked(spark, two_versions, tmp_path):
    values = {**GOOD.values, "category_correct": "CASE WHEN deployment_version = 'v2' THEN 2.0D ELSE 0.9D END"}
    log, rejects = qg.MetricsLog(spark, str(tmp_path / "log")), str(tmp_path / "rejects")
    result = qg.run_loop(two_versions, qg.TICKETS, qg.ExpressionEvaluator(values), log, "v1", ["v1", "v2"], rejects=rejects)
    got = {r.deployment_version: r for r in result.decisions.collect()}
    assert (got["v2"].state, got["v2"].reason) == ("open", "none of 13 routed rows could be scored")
    assert (got["v1"].state, got["v1"].n_rejected) == ("closed", 0)
    assert rows(qg.release(two_versions, result.decisions).select("deployment_version").distinct()) == [("v1",)]


def test_skip_scored_judges_the_newest_rows_of_this_evaluator(spark, two_versions, tmp_path):
    log = qg.MetricsLog(spark, str(tmp_path / "log"))
    fixed = two_versions.withColumn("resolution_summary", F.lit("fixed"))
    evals = qg.score(fixed, qg.TICKETS, GOOD)
    log.append(evals.withColumn("quality", F.lit(0.1)), "old", F.lit("2020-01-01").cast("timestamp"))
    log.append(evals, "new", F.lit("2021-01-01").cast("timestamp"))
    log.append(evals.withColumns({"quality": F.lit(0.0), "backend": F.lit("another")}), "else")
    fresh = qg.run_loop(fixed, qg.TICKETS, GOOD, qg.MetricsLog(spark, str(tmp_path / "log2")), "v1", ["v2"]).decisions.first()
    resumed = qg.run_loop(fixed, qg.TICKETS, GOOD, log, "v1", ["v2"], skip_scored=True).decisions.first()
    assert (resumed.n_rows, resumed.mean_quality, resumed.state) == (fresh.n_rows, fresh.mean_quality, fresh.state)


def test_a_report_that_fails_fails_the_loop(spark, two_versions, tmp_path):
    broken = F.raise_error(F.lit("no day")).cast("date")
    with pytest.raises(Exception, match="no day"):
        qg.run_loop(two_versions, qg.TICKETS, GOOD, qg.MetricsLog(spark, str(tmp_path / "log")), "v1", ["v2"], as_of=broken)


def test_rows_that_cannot_be_scored_are_kept_aside(spark, two_versions, tmp_path):
    source, rejects = str(tmp_path / "in"), str(tmp_path / "rejects")
    two_versions.coalesce(1).write.parquet(source)
    values = {**GOOD.values, "category_correct": "CASE WHEN row_id = 'T03' THEN 2.0D ELSE 0.9D END"}
    partly = qg.ExpressionEvaluator(values)
    log = qg.MetricsLog(spark, str(tmp_path / "log"))
    qg.score_stream(stream_of(spark, source), qg.TICKETS, partly, log, str(tmp_path / "c"), rejects=rejects).awaitTermination()
    want = [("T03", v, "category_correct: noul is not in [0, 1]") for v in ("v1", "v2")]
    assert rows(spark.read.parquet(rejects), "row_id", "deployment_version", "error") == want
    assert log.read().count() == 24
    qg.run_loop(two_versions, qg.TICKETS, partly, log, "v1", ["v2"], rejects=rejects, skip_scored=True)
    assert log.read().count() == 24 and spark.read.parquet(rejects).count() == 4
    with pytest.raises(Exception, match="category_correct: noul is not in"):
        qg.run_loop(two_versions, qg.TICKETS, partly, log, "v1", ["v2"])


def test_stream_options(spark, two_versions, tmp_path):
    source = str(tmp_path / "in")
    bad = two_versions.filter("row_id = 'T01'").withColumn("resolution_summary", F.lit(" ")).withColumn("row_id", F.lit("B"))
    two_versions.unionByName(bad).write.parquet(source)
    log = qg.MetricsLog(spark, str(tmp_path / "log"))
    reports = []
    job = qg.score_stream(
        stream_of(spark, source), qg.TICKETS, GOOD, log, str(tmp_path / "c"), only_passing=True, seen_since="2020-01-01",
        on_batch=lambda df, i: reports.append(qg.check_report(df, qg.TICKETS).agg(F.sum("completeness")).first()[0]),
    )
    job.awaitTermination()
    assert sum(reports) == 2 and log.read().count() == 26


def test_repeats_within_the_delay_are_dropped(spark, two_versions, tmp_path):
    source = str(tmp_path / "in")
    two_versions.union(two_versions).write.parquet(source)
    stream = stream_of(spark, source).withColumn("at", F.col("created_at").cast("timestamp"))
    out = str(tmp_path / "out")
    job = (
        qg.drop_repeats(stream, "at", "1 hour").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    job.awaitTermination()
    assert spark.read.parquet(out).count() == 26


def test_jobs_from_the_command_line(spark, two_versions, tmp_path, capsys):
    import json

    from qualitygate.__main__ import load_evaluator, main

    qg.write_table(two_versions, qg.TICKETS, str(tmp_path / "t"))
    (tmp_path / "answers.json").write_text(json.dumps({"values": dict(GOOD.values), "tokens": "10"}))
    common = ["--table", str(tmp_path / "t")]
    loop = ["loop", *common, "--log", str(tmp_path / "log"), "--evaluator", str(tmp_path / "answers.json")]
    loop += ["--out", str(tmp_path / "tables")]
    assert main([*loop, "--as-of", "2024-02-10"]) == 1
    assert spark.read.parquet(str(tmp_path / "tables" / "review")).count() == 3
    labels = spark.createDataFrame([("T00", "v2", True), ("T01", "v2", False)], "row_id string, deployment_version string, is_good boolean")
    labels.write.parquet(str(tmp_path / "labels"))
    assert main([*loop, "--labels", str(tmp_path / "labels")]) == 1
    assert spark.read.parquet(str(tmp_path / "tables" / "metrics")).first().disagreement_rate == 0.5
    assert "semantic drift" in spark.read.parquet(str(tmp_path / "tables" / "decisions")).first().reason
    assert main([*loop, "--drift-threshold", "2", "--quality-floor", "0"]) == 0
    assert main(["export", *common, "--out", str(tmp_path / "out")]) == 0
    assert "tickets: 26 rows, 13 changed columns" in capsys.readouterr().out
    assert load_evaluator("tests.test_loop_and_stream:GOOD") == GOOD


def test_folders_made_meanwhile_are_removed(spark):
    from pathlib import Path

    from qualitygate.plans.scratch import new_folder, spool, temporary

    with temporary(spark):
        kept = spool(spark.range(3))
        (folder,) = {Path(f.removeprefix("file:")).parent for f in kept.inputFiles()} or {Path(new_folder(spark, "x"))}
        assert folder.exists()
    assert not folder.exists()
