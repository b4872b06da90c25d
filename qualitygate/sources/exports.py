"""Files for people and other tools: CSV and JSON, tables and manifests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.operators.versions import drift_manifest, manifest_in_order
from qualitygate.plans import pin
from qualitygate.spec import MANIFEST, DatasetSpec


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers, quotes doubled; empty strings quoted, NULLs bare."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """Such files back. A bare empty field is NULL, a quoted one an empty string.

    ``line_breaks`` says that texts may hold line breaks; each file is then read by one task. Without it a
    record that a line break tears apart ends the job instead of giving broken rows.
    """
    reader = spark.read.option("mode", "FAILFAST").schema(schema).option("header", True).option("escape", '"').option("multiLine", line_breaks)
    # the mark that stands for a bare empty field while parsing; by default it equals the empty string
    return reader.option("nullValue", "\u0000").option("enforceSchema", False).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A folder of JSON lines, NULLs written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """A folder of files that hold one JSON array each, NULLs written out; written in parallel.

    Rows are rebalanced first, so that no file is larger than a task reads at once; ``read_json`` with ``array``
    and other tools take each file as a whole.
    """
    rows = df.hint("rebalance").select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))

    def lines(batches):
        import pyarrow as pa

        begun = False
        for batch in batches:
            if batch.num_rows:
                texts = ["," + text for text in batch.column("value").to_pylist()]
                if not begun:
                    texts[0], begun = "[" + texts[0][1:], True
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"], pa.string())], names=["value"])

    arrays = rows.mapInArrow(lines, "value string")
    if df.isEmpty():  # then the plan may have no partition that could write the empty array
        arrays = df.sparkSession.range(1, numPartitions=1).select(F.lit("[]").alias("value"))
    arrays.write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, array: bool = False) -> DataFrame:
    """JSON lines, or with ``array`` files that hold one JSON array each."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def export_dataset(df: DataFrame, spec: DatasetSpec, folder: str) -> DataFrame:
    """``<folder>/<name>.json`` and ``.csv`` with the table's columns in order; the table as read back.

    The JSON is written from ``df`` and the CSV from the JSON, so ``df`` is computed once.
    """
    spark = df.sparkSession
    write_json(df.select(*spec.columns), f"{folder}/{spec.name}.json")
    rows = read_json(spark, f"{folder}/{spec.name}.json", T.StructType([df.schema[c] for c in spec.columns]))
    write_csv(rows, f"{folder}/{spec.name}.csv")
    return rows


def export_drift(df: DataFrame, spec: DatasetSpec, folder: str, before: str = "v1", after: str = "v2") -> DataFrame:
    """``<folder>/<name>_drift.json`` and ``.csv``: what changed between two versions, in order; as read back."""
    records = manifest_in_order(drift_manifest(df, spec, before, after)).select(*MANIFEST.fieldNames())
    kept = pin(records)
    write_json(kept, f"{folder}/{spec.name}_drift.json")
    write_csv(kept, f"{folder}/{spec.name}_drift.csv")
    return kept


def export_all(tables: Mapping[str, tuple[DatasetSpec, DataFrame]], folder: str) -> dict[str, tuple[int, int]]:
    """Export every table and its manifest; row counts and drift counts by name."""
    return {
        name: (export_dataset(df, spec, folder).count(), export_drift(df, spec, folder).count())
        for name, (spec, df) in tables.items()
    }


def rows_from_json(df: DataFrame, spec: DatasetSpec, column: str = "body") -> DataFrame:
    """Rows to score out of request bodies ``{"rows": [{...}, ...]}``, one body per input row."""
    row = T.StructType([T.StructField(c, T.StringType()) for c in spec.routed_columns])
    body = T.StructType([T.StructField("rows", T.ArrayType(row))])
    return df.select(F.inline(F.from_json(column, body).getField("rows")))


def evaluations_to_json(evals: DataFrame, column: str = "evaluation") -> DataFrame:
    """One JSON object per evaluation, NULLs written out."""
    return evals.select(F.to_json(F.struct(*evals.columns), {"ignoreNullFields": "false"}).alias(column))
