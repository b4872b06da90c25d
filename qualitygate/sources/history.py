"""Summaries of the log by day, so that its history is known without reading its rows again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitygate.operators.metrics import trend_of_means
from qualitygate.plans.scratch import children, exists, size_of
from qualitygate.sources.metrics_log import MetricsLog
from qualitygate.spec import VERSION

DAY = "scored_date"
#: Fixed value: Spark's name of the folder of rows without a day; it is never closed.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Size of a day's quantile sketch: ranks are off by less than a fifth of a percent.
SKETCH = 2000
SUMMARY = f"{VERSION} string, n_rows long, n_quality long, quality double, cost_usd double, latency binary, files long, bytes long, {DAY} date"


@dataclass(frozen=True)
class DailyHistory:
    """Per day and version: rows, sums and a quantile sketch of latency, kept in ``path`` and merged when read.

    A summary holds as long as the day's folder in the log has the files and bytes that it was made from, so
    late rows are never missed: their day is read again until it is closed again.
    """

    log: MetricsLog
    path: str

    def _days(self) -> dict[str, tuple[int, int]]:
        """Files and bytes of each day's folder, from the listing alone."""
        spark, start = self.log.spark, f"{DAY}="
        days = [name.removeprefix(start) for name in children(spark, self.log.path) if name.startswith(start)]
        return {day: size_of(spark, f"{self.log.path}/{start}{day}") for day in days}

    def _summaries(self) -> DataFrame:
        return self.log.spark.read.schema(SUMMARY).parquet(self.path)

    def _closed(self, days: dict[str, tuple[int, int]]) -> list[str]:
        """Days whose summary still holds. One row per day comes to the driver."""
        if not exists(self.log.spark, self.path):
            return []
        made = self._summaries().select(F.col(DAY).cast("string").alias("day"), "files", "bytes").distinct().collect()
        return sorted(r.day for r in made if days.get(r.day) == (r.files, r.bytes))

    def _summed(self, days: list[str]) -> DataFrame:
        of_days = F.col(DAY).isin(*[F.lit(d).cast("date") for d in days if d != NO_DAY])
        rows = self.log.read().filter(of_days | F.col(DAY).isNull() if NO_DAY in days else of_days)
        return rows.groupBy(DAY, VERSION).agg(
            F.count("*").alias("n_rows"),
            F.count("quality").alias("n_quality"),
            F.sum("quality").alias("quality"),
            F.sum("cost_usd").alias("cost_usd"),
            F.kll_sketch_agg_double("latency_ms", F.lit(SKETCH)).alias("latency"),
        )

    def close(self, before: str) -> list[str]:
        """Summarise the days before ``before`` (a date) that are not, or not any more; these days."""
        days = self._days()
        open_ = sorted(d for d in set(days) - set(self._closed(days)) if d != NO_DAY and d < before)
        if open_:
            sizes = F.create_map(*[F.lit(x) for d in open_ for x in (d, f"{days[d][0]} {days[d][1]}")])
            size = F.split(sizes[F.col(DAY).cast("string")], " ")
            made = self._summed(open_).withColumns({"files": size[0].cast("long"), "bytes": size[1].cast("long")})
            writer = made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(DAY).parquet(self.path)
        return open_

    def by_day(self) -> DataFrame:
        """All days' summaries; only days that are not closed are read from the log."""
        days = self._days()
        closed = self._closed(days)
        rest = self._summed(sorted(set(days) - set(closed)))
        if not closed:
            return rest
        kept = self._summaries().filter(F.col(DAY).isin(*[F.lit(d).cast("date") for d in closed]))
        return kept.select(*rest.columns).unionByName(rest)

    def report(self) -> DataFrame:
        """``drift_report`` of the whole log; its percentile of latency is approximate here too."""
        merged = self.by_day().groupBy(VERSION).agg(
            F.sum("n_rows").alias("n_rows"),
            (F.sum("quality") / F.sum("n_quality")).alias("mean_quality"),
            F.sum("cost_usd").alias("total_cost_usd"),
            F.kll_merge_agg_double("latency").alias("_latency"),
        )
        p95 = F.when(F.kll_sketch_get_n_double("_latency") > 0, F.kll_sketch_get_quantile_double("_latency", F.lit(0.95)))
        return merged.withColumn("p95_latency_ms", p95).drop("_latency").orderBy(VERSION)

    def trend(self) -> DataFrame:
        """``drift_trend`` of the whole log."""
        means = self.by_day().groupBy(VERSION).agg((F.sum("quality") / F.sum("n_quality")).alias("mean_quality"))
        return trend_of_means(means)
