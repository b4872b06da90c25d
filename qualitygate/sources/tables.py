"""The versioned data table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitygate.spec import CREATED_AT, VERSION, DatasetSpec


def conform(df: DataFrame, spec: DatasetSpec, on_bad_date: str = "fail") -> DataFrame:
    """Bring rows to the spec's columns, order and types; dates may come as ISO strings.

    A date that does not parse ends the job, or becomes NULL with ``on_bad_date="null"``.
    """
    parse = F.try_to_date if on_bad_date == "null" else F.to_date
    created: Column = F.col(CREATED_AT)
    if dict(df.dtypes)[CREATED_AT] == "string":
        created = parse(created)
    text = [F.col(c).cast("string").alias(c) for c in spec.routed_columns]
    return df.select(*text, created.cast("date").alias(CREATED_AT))


def write_table(df: DataFrame, spec: DatasetSpec, path: str) -> None:
    """Full refresh: replace the table by ``df``, one folder per version.

    Rebalancing on the version packs small versions into few files and splits a large one over
    many tasks, so no version is written by one task.
    """
    rows = conform(df, spec).hint("rebalance", VERSION)
    rows.write.mode("overwrite").partitionBy(VERSION).parquet(path)


def replace_version(df: DataFrame, spec: DatasetSpec, path: str) -> None:
    """Replace only the versions that occur in ``df``; others stay as they are."""
    rows = conform(df, spec).hint("rebalance", VERSION)
    writer = rows.write.mode("overwrite").partitionBy(VERSION)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_table(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    """The table with its declared types; a filter on the version prunes folders."""
    return spark.read.schema(spec.schema).parquet(path).select(*spec.columns)
