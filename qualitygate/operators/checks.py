"""Deterministic checks: completeness, allowed values, uniqueness and freshness, per version.

All four come out of one scan. Rows are first aggregated by (version, row id) with map-side
partial aggregation, so copies of a hot id collapse before the shuffle; the second
aggregation sees one row per id and moves one partial row per version and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitygate.functions import check_status, is_blank, is_not_allowed, is_older_than
from qualitygate.plans import names_table
from qualitygate.spec import CREATED_AT, ROW_ID, VERSION, DatasetSpec

CHECKS = ("completeness", "schema", "uniqueness", "freshness")


def row_failures(
    spec: DatasetSpec, as_of: Column | None, max_age_days: int = 30, null_is_invalid: bool = False
) -> dict[str, Column]:
    """The row-level checks as boolean Columns. Without ``as_of`` nothing counts as stale."""
    stale = F.lit(False) if as_of is None else is_older_than(F.col(CREATED_AT), as_of, max_age_days)
    return {
        "completeness": is_blank(F.col(spec.completeness_column)),
        "schema": is_not_allowed(F.col(spec.enum_column), spec.valid_values, null_is_invalid),
        "freshness": stale,
    }


def check_report(
    df: DataFrame,
    spec: DatasetSpec,
    as_of: Column | None = None,
    max_age_days: int = 30,
    versions: Sequence[str] | None = None,
    null_is_invalid: bool = False,
) -> DataFrame:
    """One row per version: ``total_rows``, a failure count per check, ``all_passed``.

    ``uniqueness`` counts duplicated ids, not surplus rows; NULL ids form one group.
    With ``versions`` the report has exactly those rows; an absent version has 0 rows and passes.
    """
    if versions is not None:
        df = df.filter(F.col(VERSION).isin(*versions))
    failures = row_failures(spec, as_of, max_age_days, null_is_invalid)
    per_id = df.groupBy(VERSION, ROW_ID).agg(
        F.count("*").alias("_rows"), *[F.count_if(c).alias(name) for name, c in failures.items()]
    )
    report = per_id.groupBy(VERSION).agg(
        F.sum("_rows").alias("total_rows"),
        *[
            (F.count_if(F.col("_rows") > 1) if name == "uniqueness" else F.sum(name)).alias(name)
            for name in CHECKS
        ],
    )
    return report_of_sums(report, versions)


def report_of_sums(sums: DataFrame, versions: Sequence[str] | None = None) -> DataFrame:
    """The report from ``total_rows`` and the failures of each version, in the report's order of columns."""
    report = sums.select(VERSION, "total_rows", *CHECKS)
    if versions is not None:
        asked = names_table(sums.sparkSession, versions, VERSION)
        report = asked.join(report, VERSION, "left").na.fill(0, ["total_rows", *CHECKS])
    return report.withColumn("all_passed", sum((F.col(c) for c in CHECKS), F.lit(0)) == 0)


def check_counts(report: DataFrame) -> DataFrame:
    """The report in long form: one row per version and check."""
    return report.unpivot([VERSION], list(CHECKS), "check_name", "failures")


def failing_versions(report: DataFrame, check: str | None = None) -> DataFrame:
    """Versions with at least one failure, as (version, check, failures)."""
    counts = check_counts(report).filter(F.col("failures") > 0)
    return counts if check is None else counts.filter(F.col("check_name") == check)


def check_statuses(report: DataFrame) -> DataFrame:
    """``PASS`` or ``<n> FAIL`` per version and check."""
    return check_counts(report).select(VERSION, "check_name", check_status(F.col("failures")).alias("status"))


def duplicated_ids(df: DataFrame) -> DataFrame:
    """The ids behind the uniqueness count, with their number of rows."""
    return df.groupBy(VERSION, ROW_ID).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def passing_rows(
    df: DataFrame, spec: DatasetSpec, as_of: Column | None = None, max_age_days: int = 30, null_is_invalid: bool = False
) -> DataFrame:
    """Rows that fail none of the row-level checks."""
    for failed in row_failures(spec, as_of, max_age_days, null_is_invalid).values():
        df = df.filter(~failed)
    return df
