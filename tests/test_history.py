from pyspark.sql import functions as F

import qualitygate as qg
from tests.conftest import rows


def logged(spark, path, days, n=4000):
    """A log with so many rows a day, of two versions, with skewed latencies and some without quality."""
    log = qg.MetricsLog(spark, path)
    for day in days:
        part = spark.range(n).select(
            F.concat(F.lit(day), F.col("id").cast("string")).alias("row_id"), F.when(F.col("id") % 3 == 0, "v1").otherwise("v2").alias("deployment_version"),
            F.create_map().cast(qg.spec.ANSWERS).alias("answers"), F.when(F.col("id") % 7 != 0, F.rand(3)).alias("quality"), F.lit("x").alias("backend"),
            F.exp(3 * F.randn(5)).alias("latency_ms"), F.lit(0.5).alias("cost_usd"),
        )
        log.append(part, day, F.lit(day).cast("timestamp"))
    return log


def rounded(report):
    return rows(report.select("deployment_version", "n_rows", F.round("mean_quality", 9), F.round("total_cost_usd", 6)))


def ranks(log, report):
    """How many of a version's latencies are not above its percentile, as a share."""
    got = log.read().join(F.broadcast(report), "deployment_version").groupBy("deployment_version")
    return [r[1] for r in got.agg(F.avg((F.col("latency_ms") <= F.col("p95_latency_ms")).cast("int"))).collect()]


def test_closed_days_are_not_read_again(spark, tmp_path):
    log = logged(spark, str(tmp_path / "log"), ["2024-01-01", "2024-01-02", "2024-01-03"])
    history = qg.DailyHistory(log, str(tmp_path / "history"))
    exact = rounded(qg.drift_report(log.read()))
    assert rounded(history.report()) == exact
    assert history.close("2024-01-03") == ["2024-01-01", "2024-01-02"] and history.close("2024-01-03") == []
    assert rounded(history.report()) == exact
    assert all(abs(share - 0.95) < 0.002 for share in ranks(log, history.report()))
    plan = history.by_day()._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "PartitionFilters" in line and "/log" in line)
    assert "2024-01-03" in scan and "2024-01-01" not in scan and "2024-01-02" not in scan
    assert rows(history.trend().select("deployment_version")) == [("v1",), ("v2",)]


def test_late_rows_open_their_day_again(spark, tmp_path):
    path = str(tmp_path / "log")
    log = logged(spark, path, ["2024-01-01", "2024-01-02"], 300)
    history = qg.DailyHistory(log, str(tmp_path / "history"))
    history.close("2024-02-01")
    logged(spark, path, ["2024-01-02", "2024-01-05"], 30)
    assert rounded(history.report()) == rounded(qg.drift_report(log.read()))
    assert history.close("2024-01-05") == ["2024-01-02"]
    assert rounded(history.report()) == rounded(qg.drift_report(log.read()))


def test_a_log_without_rows_or_latency(spark, tmp_path):
    log = qg.MetricsLog(spark, str(tmp_path / "log")).create()
    history = qg.DailyHistory(log, str(tmp_path / "history"))
    assert history.close("2024-01-01") == [] and history.report().count() == 0
    bare = spark.createDataFrame([("1", "v1", None, None, "x", None, None)], qg.spec.EVALUATION)
    log.append(bare, "r", F.lit("2023-01-01").cast("timestamp"))
    log.append(bare, "r", F.lit(None).cast("timestamp"))
    history.close("2024-01-01")
    assert [tuple(r) for r in history.report().collect()] == [("v1", 2, None, None, None)]
