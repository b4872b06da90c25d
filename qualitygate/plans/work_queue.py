"""Rows waiting for an expensive step, as files that one stream works off."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from qualitygate.plans.scratch import empty_table, exists

#: Files that one slot takes in a turn. A turn costs some fixed time; a killed run repeats the turn it was in.
FILES_PER_SLOT = 4
#: About so many turns work off a queue of any length; files hold more rows where that takes it.
TURNS = 64


@dataclass(frozen=True)
class WorkQueue:
    """A folder with the rows that wait (``tasks``), what is done with them (``results``) and how far that is (``progress``).

    Results are written turn by turn and each turn counts whole or not at all, so working again on a
    folder that was left in the middle goes on with the files that are not done yet. Plan and
    driver memory are the same for any number of rows, and so is what turns and files cost.
    """

    spark: SparkSession
    path: str

    @property
    def tasks(self) -> str:
        return f"{self.path}/tasks"

    @property
    def results(self) -> str:
        return f"{self.path}/results"

    def filled(self) -> bool:
        return exists(self.spark, f"{self.tasks}/_SUCCESS")

    def fill(self, rows: DataFrame, task_rows: int, slots: int) -> WorkQueue:
        """Write ``rows`` in files of at most ``task_rows``, or of a turn's share where that is more; a queue that was filled before keeps its rows.

        A turn is what ``slots`` tasks take at a time. The rows are counted first, which reads no more columns than choosing them does.
        """
        if not self.filled():
            share = -(-rows.count() // (TURNS * slots * FILES_PER_SLOT))
            rows.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", max(task_rows, share)).parquet(self.tasks)
        return self

    def work(self, run: Callable, schema: T.StructType, keys: Sequence[str], slots: int) -> DataFrame:
        """Give all rows that are not done yet to ``run`` (for ``mapInPandas``), in at most ``slots`` tasks at a time; all results."""
        rows = self.spark.readStream.schema(self.spark.read.parquet(self.tasks).schema)
        rows = rows.option("maxFilesPerTrigger", slots * FILES_PER_SLOT).parquet(self.tasks)
        done = rows.repartition(slots, *keys).mapInPandas(run, schema).writeStream.format("parquet").option("path", self.results)
        done.option("checkpointLocation", f"{self.path}/progress").trigger(availableNow=True).start().awaitTermination()
        if not exists(self.spark, self.results):
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.results)
