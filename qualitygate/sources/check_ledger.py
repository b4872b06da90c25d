"""Checks of a table that grows, from what was counted of each part when it came."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.functions import is_older_than
from qualitygate.operators.checks import report_of_sums, row_failures
from qualitygate.plans import empty_table, exists
from qualitygate.spec import CREATED_AT, ROW_ID, VERSION, DatasetSpec

PART = "part"
IDS = f"{VERSION} string, {ROW_ID} string, n long, {PART} string"
ROWS = f"{VERSION} string, {CREATED_AT} date, total_rows long, completeness long, `schema` long, {PART} string"


@dataclass(frozen=True)
class CheckLedger:
    """Two narrow tables in ``path``: rows per version and id, and counts per version and creation date, of each part.

    ``add`` reads the part alone, and adding a part of the same name again replaces it, so that a
    replayed batch counts once. ``report`` equals ``check_report`` over all parts together without reading their
    rows: repeated ids show across parts, and freshness can be asked for any day. ``compact`` makes one part of all.
    """

    spark: SparkSession
    path: str
    spec: DatasetSpec
    null_is_invalid: bool = False

    def _read(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        if not exists(self.spark, folder):
            return empty_table(self.spark, T.StructType.fromDDL(schema))
        return self.spark.read.schema(schema).parquet(folder)

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{self.path}/{name}")

    def add(self, df: DataFrame, part: str) -> None:
        """Count a part; add it again under the same name if that failed in between."""
        failures = row_failures(self.spec, None, null_is_invalid=self.null_is_invalid)
        counts = [F.count_if(failures[name]).alias(name) for name in ("completeness", "schema")]
        named = F.lit(str(part)).alias(PART)
        by_day = df.groupBy(VERSION, F.col(CREATED_AT).cast("date").alias(CREATED_AT)).agg(F.count("*").alias("total_rows"), *counts)
        self._write(by_day.select("*", named), "rows")
        self._write(df.groupBy(VERSION, F.col(ROW_ID).cast("string").alias(ROW_ID)).agg(F.count("*").alias("n")).select("*", named), "ids")

    def report(self, as_of: Column | None = None, max_age_days: int = 30, versions: Sequence[str] | None = None) -> DataFrame:
        """The report of ``check_report``."""
        ids, rows = self._read("ids", IDS), self._read("rows", ROWS)
        if versions is not None:
            ids, rows = (x.filter(F.col(VERSION).isin(*versions)) for x in (ids, rows))
        stale = F.lit(False) if as_of is None else is_older_than(F.col(CREATED_AT), as_of, max_age_days)
        per_id = ids.groupBy(VERSION, ROW_ID).agg(F.sum("n").alias("n"))
        repeated = per_id.groupBy(VERSION).agg(F.count_if(F.col("n") > 1).alias("uniqueness"))
        sums = rows.groupBy(VERSION).agg(
            *[F.sum(c).alias(c) for c in ("total_rows", "completeness", "schema")],
            F.sum(F.when(stale, F.col("total_rows")).otherwise(0)).alias("freshness"),
        )
        other = repeated.select(F.col(VERSION).alias("_v"), "uniqueness")
        together = sums.join(other, F.col(VERSION).eqNullSafe(F.col("_v"))).drop("_v")  # one row per version
        return report_of_sums(together, versions)

    def repeated_ids(self) -> DataFrame:
        """Ids with more than one row in all parts together, with the number of rows."""
        return self._read("ids", IDS).groupBy(VERSION, ROW_ID).agg(F.sum("n").alias("n_rows")).filter(F.col("n_rows") > 1)

    def compact(self, folder: str) -> CheckLedger:
        """A ledger in a new ``folder`` that has all parts as one named ``compacted``."""
        new = CheckLedger(self.spark, folder, self.spec, self.null_is_invalid)
        one = F.lit("compacted").alias(PART)
        rows = self._read("rows", ROWS).groupBy(VERSION, CREATED_AT).agg(*[F.sum(c).alias(c) for c in ("total_rows", "completeness", "schema")])
        new._write(rows.select("*", one), "rows")
        new._write(self._read("ids", IDS).groupBy(VERSION, ROW_ID).agg(F.sum("n").alias("n")).select("*", one), "ids")
        return new
