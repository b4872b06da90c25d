"""Operational metrics over evaluations or the metrics log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.functions import answer_text, item_of, quality_band
from qualitygate.plans import pin, value_at_rank
from qualitygate.spec import KEYS, ROW_ID, VERSION, DatasetSpec, Options


def mean_quality_by_version(evals: DataFrame) -> DataFrame:
    return evals.groupBy(VERSION).agg(F.avg("quality").alias("mean_quality"))


def drift_by_version(log: DataFrame) -> DataFrame:
    """Rows, mean quality and cost per version, over everything ever appended."""
    return (
        log.groupBy(VERSION)
        .agg(F.count("*").alias("n"), F.avg("quality").alias("mean_quality"), F.sum("cost_usd").alias("total_cost"))
        .orderBy(VERSION)
    )


def drift_report(log: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """``drift_by_version`` with an approximate 95th percentile of latency, in one aggregation."""
    p95 = F.percentile_approx("latency_ms", 0.95, accuracy)
    return (
        log.groupBy(VERSION)
        .agg(
            F.count("*").alias("n_rows"),
            F.avg("quality").alias("mean_quality"),
            F.sum("cost_usd").alias("total_cost_usd"),
            p95.alias("p95_latency_ms"),
        )
        .orderBy(VERSION)
    )


def drift_trend(log: DataFrame, order: str | None = None) -> DataFrame:
    """Change of mean quality against the version before it; negative is a drop.

    Versions compare as strings unless ``order`` names a column to order them by. The window sees
    one row per version, after aggregation.
    """
    keys = [VERSION] if order is None else [VERSION, order]
    return trend_of_means(log.groupBy(*keys).agg(F.avg("quality").alias("mean_quality")), order)


def trend_of_means(means: DataFrame, order: str | None = None) -> DataFrame:
    """``drift_trend`` from one row per version."""
    before = F.lag("mean_quality").over(Window.orderBy(order or VERSION))
    return means.select(VERSION, "mean_quality", (F.col("mean_quality") - before).alias("drift_vs_previous"))


def nearest_rank(percent: float):
    """0-based nearest rank, halves to the even one."""
    return lambda n: F.rint(F.lit(percent / 100.0) * (n - 1))


def latency_percentiles(
    log: DataFrame, percents: Sequence[float] = (50, 95), by: Sequence[str] = (VERSION,), value: str = "latency_ms"
) -> DataFrame:
    """Exact percentiles by nearest rank, as ``p50_<value>`` and so on, per group or overall."""
    ranks = {f"p{p:g}_{value}": nearest_rank(p) for p in percents}
    return value_at_rank(log, list(by), value, ranks)


def semantic_drift(evals: DataFrame, of_means: bool = False) -> DataFrame:
    """Mean of the first version minus mean of the last, by name; positive is a drop, 0 for one version."""
    means = evals if of_means else mean_quality_by_version(evals)
    change = F.min_by("mean_quality", VERSION) - F.max_by("mean_quality", VERSION)
    return means.agg(F.coalesce(change, F.lit(0.0)).alias("semantic_drift"))


def one_label_per_key(labels: DataFrame, order: Column | None = None) -> DataFrame:
    """One label per key: the last by ``order``, or by the label itself."""
    place = F.col("is_good") if order is None else F.struct(order.alias("o"), F.col("is_good").alias("g"))
    return labels.groupBy(*KEYS).agg(F.max_by("is_good", place).alias("is_good"))


def labels_from_keys(labels: DataFrame, key: str = "key", is_good: str = "is_good") -> DataFrame:
    """Labels given as ``row_id@version`` texts; the version follows the last ``@``."""
    version = F.substring_index(key, "@", -1)
    row_id = F.expr(f"left(`{key}`, length(`{key}`) - length(substring_index(`{key}`, '@', -1)) - 1)")
    return labels.select(row_id.alias(ROW_ID), version.alias(VERSION), F.col(is_good).alias("is_good"))


def _verdicts_and_labels(
    evals: DataFrame, labels: DataFrame, threshold: float, label_order: Column | None = None
) -> DataFrame:
    """Per labeled key: the label, the number of evaluations and how many say good.

    Both sides are reduced to one row per key before they meet, so a key with many evaluations
    weighs nothing in the join, and the join needs no further shuffle.
    """
    verdicts = evals.groupBy(*KEYS).agg(
        F.count("*").alias("_n"), F.count_if(F.col("quality") >= threshold).alias("_n_good")
    )
    return verdicts.join(one_label_per_key(labels, label_order), list(KEYS), "inner").filter(
        F.col("is_good").isNotNull()
    )


def confusion_counts(
    evals: DataFrame,
    labels: DataFrame,
    threshold: float = Options.disagreement_threshold,
    label_order: Column | None = None,
) -> DataFrame:
    """Verdicts against human labels, in one row.

    A row that the evaluator flags (quality below ``threshold``) counts as positive, so the
    false-positive rate is the share of good rows that were flagged.
    """
    n, n_good, good = F.col("_n"), F.col("_n_good"), F.col("is_good")
    zero = F.lit(0)

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), zero).alias(name)

    counts = _verdicts_and_labels(evals, labels, threshold, label_order).agg(
        total(n, "compared"),
        total(F.when(good, zero).otherwise(n - n_good), "true_positives"),
        total(F.when(good, n - n_good).otherwise(zero), "false_positives"),
        total(F.when(good, n_good).otherwise(zero), "true_negatives"),
        total(F.when(good, zero).otherwise(n_good), "false_negatives"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole)

    fp, fn, tn = F.col("false_positives"), F.col("false_negatives"), F.col("true_negatives")
    return counts.withColumn("false_positive_rate", share(fp, fp + tn)).withColumn(
        "disagreement_rate", share(fp + fn, F.col("compared"))
    )


def disagreement_rate(
    evals: DataFrame,
    labels: DataFrame,
    threshold: float = Options.disagreement_threshold,
    label_order: Column | None = None,
) -> DataFrame:
    """Share of labeled evaluations whose verdict differs from the label; NULL if none is labeled."""
    return confusion_counts(evals, labels, threshold, label_order).select("compared", "disagreement_rate")


def loop_metrics(
    evals: DataFrame,
    labels: DataFrame | None = None,
    threshold: float = Options.disagreement_threshold,
    label_order: Column | None = None,
) -> DataFrame:
    """The metrics of one scoring loop, in one row.

    Reads ``evals`` once for sums, once or more for exact percentiles and once for labels: hand in
    stored evaluations.
    """
    per_version = pin(
        evals.groupBy(VERSION).agg(
            F.count("*").alias("_n"),
            F.avg("quality").alias("mean_quality"),
            F.sum("cost_usd").alias("_cost"),
            F.min("backend").alias("_backend"),
        )
    )
    entries = F.sort_array(F.collect_list(F.struct(VERSION, "mean_quality")))
    change = F.min_by("mean_quality", VERSION) - F.max_by("mean_quality", VERSION)
    n, cost = F.col("rows_evaluated"), F.col("total_cost_usd")
    totals = per_version.agg(
        F.coalesce(F.min("_backend"), F.lit("n/a")).alias("backend"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_evaluated"),
        F.map_from_entries(entries).alias("mean_quality_by_version"),
        F.coalesce(change, F.lit(0.0)).alias("semantic_drift"),
        F.coalesce(F.sum("_cost"), F.lit(0.0)).alias("total_cost_usd"),
    )
    latency = pin(latency_percentiles(evals, (50, 95), by=()))
    rate = F.lit(None).cast("double") if labels is None else _scalar(
        disagreement_rate(evals, labels, threshold, label_order), "disagreement_rate"
    )
    return totals.select(
        "backend",
        "rows_evaluated",
        "mean_quality_by_version",
        "semantic_drift",
        rate.alias("disagreement_rate"),
        F.coalesce(_scalar(latency, "p50_latency_ms"), F.lit(0.0)).alias("p50_latency_ms"),
        F.coalesce(_scalar(latency, "p95_latency_ms"), F.lit(0.0)).alias("p95_latency_ms"),
        "total_cost_usd",
        F.when(n > 0, cost / n).otherwise(F.lit(0.0)).alias("cost_per_row_usd"),
    )


def _scalar(one_row: DataFrame, column: str) -> Column:
    return one_row.select(column).scalar()


def distinct_keys(evals: DataFrame) -> DataFrame:
    """Number of different (row id, version) pairs, NULLs counting as values."""
    return evals.groupBy(*KEYS).agg(F.lit(1).alias("_one")).agg(F.count("*").alias("distinct_keys"))


def answers_wide(evals: DataFrame, spec: DatasetSpec, as_text: bool = False) -> DataFrame:
    """One row per evaluation, one column per question, named by its header.

    The question keys are known, so this is a projection, not a pivot.
    """
    def cell(question) -> Column:
        item = item_of(question.key)
        return answer_text(item) if as_text else F.expr(f"{item}.{question.type}")

    cells = [cell(q).alias(q.header) for q in spec.questions]
    return evals.select(VERSION, ROW_ID, *cells, "quality", quality_band(F.col("quality")).alias("band"))
