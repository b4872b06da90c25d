"""The append-only log of evaluations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.plans import empty_table, exists, spool
from qualitygate.spec import ANSWERS, EVALUATION, KEYS, METRICS, ROW_ID, VERSION

#: Up to so many row ids are handed to the scan of the log itself, which then looks into Bloom filters (Spark hands on ten at most).
NAMED_KEYS = 10


@dataclass(frozen=True)
class MetricsLog:
    """Parquet files by scoring date, rows within a file sorted by version.

    Appending never looks at what is there: scoring the same rows again appends them again. Use
    ``unscored`` before scoring, or read with ``latest``.

    With ``buckets`` each day's folder is divided by a hash of the key, rows within a file are sorted by row id, and
    files carry Bloom filters of it: ``seen`` then reads the buckets of the keys asked for only. The number
    belongs to the log, is noted beside it when it is made and cannot change. An append writes up to that many
    files; ``compact`` a day when it is over.
    """

    spark: SparkSession
    path: str
    buckets: int = 0

    @property
    def _bucket(self) -> str:
        return f"key_of_{self.buckets}"

    def _declare(self) -> None:
        noted = f"{self.path}/_buckets"
        if exists(self.spark, self.path):
            held = self.spark.read.schema("n int").json(noted).first().n if exists(self.spark, noted) else 0
            if held != self.buckets:
                raise ValueError(f"the log {self.path} has {held or 'no'} key buckets, not {self.buckets}")
        elif self.buckets:
            self.spark.range(1).select(F.lit(self.buckets).alias("n")).write.json(noted)

    def append(self, evals: DataFrame, run_id: str = "", scored_at: Column | None = None) -> None:
        self._declare()
        self._write(as_metrics(evals, run_id, scored_at), "append")

    def _write(self, rows: DataFrame, mode: str) -> None:
        if not self.buckets:
            rows.sortWithinPartitions(VERSION).write.mode(mode).partitionBy("scored_date").parquet(self.path)
            return
        keyed = rows.withColumn(self._bucket, self._bucket_of(*KEYS))
        # a bucket with very many rows is split over several tasks
        dealt = keyed.hint("rebalance", "scored_date", self._bucket).sortWithinPartitions("scored_date", self._bucket, ROW_ID, VERSION)
        writer = dealt.write.mode(mode).partitionBy("scored_date", self._bucket)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.option(f"parquet.bloom.filter.enabled#{ROW_ID}", "true").parquet(self.path)

    def _bucket_of(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def compact(self, day: str) -> None:
        """Rewrite the buckets of a day that is over, a file each; nobody may append to that day meanwhile."""
        if not self.buckets:
            raise ValueError("only a log with key buckets is compacted")
        self._write(spool(self.read(day).filter(F.col("scored_date") == F.lit(day).cast("date"))), "overwrite")

    def create(self) -> "MetricsLog":
        """Write an empty log unless there is one; then reading works before the first append."""
        self._declare()
        if not exists(self.spark, f"{self.path}/_SUCCESS"):
            empty_table(self.spark, METRICS).write.mode("append").parquet(self.path)
        return self

    def read(self, since: str | None = None) -> DataFrame:
        """Log rows; ``since`` (a date) prunes older folders."""
        return self._rows(since).select(*METRICS.fieldNames())

    def _rows(self, since: str | None) -> DataFrame:
        schema = T.StructType([*METRICS.fields, T.StructField(self._bucket, T.IntegerType())]) if self.buckets else METRICS
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if since is None else rows.filter(F.col("scored_date") >= F.lit(since).cast("date"))

    def seen(self, backend: str | None = None, since: str | None = None) -> Callable[[DataFrame], DataFrame]:
        """For ``unscored``: given the keys asked for, the keys of the log (of one evaluator) that may be among them.

        Without buckets these are all. With buckets only the folders of the asked keys' buckets are read, and
        for a few keys only the row groups whose statistics and Bloom filters allow one.
        """

        def keys_of(asked: DataFrame) -> DataFrame:
            rows = self._rows(since)
            rows = rows if backend is None else rows.filter(F.col("backend") == backend)
            if self.buckets:
                wanted = [r.b for r in asked.select(self._bucket_of(*KEYS).alias("b")).distinct().collect()]  # at most ``buckets``
                rows = rows.filter(F.col(self._bucket).isin(*wanted))
                named = asked.select(ROW_ID).distinct().limit(NAMED_KEYS + 1).collect()
                if len(named) <= NAMED_KEYS and all(r[0] is not None for r in named):
                    rows = rows.filter(F.col(ROW_ID).isin(*[r[0] for r in named]))
            return rows.select(*KEYS)

        return keys_of

    def evaluations(self, since: str | None = None) -> DataFrame:
        """Log rows with the answers as a map again."""
        return as_evaluations(self.read(since))

    def latest(self, since: str | None = None) -> DataFrame:
        return latest_per_key(self.read(since))


def as_metrics(evals: DataFrame, run_id: str = "", scored_at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if scored_at is None else scored_at
    return (
        evals.withColumn("answers_json", F.to_json("answers", {"ignoreNullFields": "false"}))
        .withColumn("scored_at", at.cast("timestamp"))
        .withColumn("run_id", F.lit(run_id))
        .withColumn("scored_date", F.to_date("scored_at"))
        .select(*METRICS.fieldNames())
    )


def as_evaluations(log: DataFrame) -> DataFrame:
    return log.withColumn("answers", F.from_json("answers_json", ANSWERS)).select(*EVALUATION.fieldNames())


def latest_per_key(log: DataFrame, tie_break: Sequence[str] = ("run_id", "quality")) -> DataFrame:
    """The newest row of every key; equal times are decided by the greatest ``tie_break``, then by the other columns.

    Each task keeps the newest row of a key before the shuffle, so repeated runs over a hot key weigh nothing.
    """
    rest = [c for c in log.columns if c not in (*KEYS, "scored_at", *tie_break)]
    newest = Window.partitionBy(*KEYS).orderBy(*[F.col(c).desc_nulls_last() for c in ("scored_at", *tie_break, *rest)])
    return log.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") == 1).select(*log.columns)
