"""Scoring rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from qualitygate.operators.checks import passing_rows
from qualitygate.operators.evaluators import Evaluator
from qualitygate.operators.routing import route_hash_sample
from qualitygate.plans.loop import score_into
from qualitygate.plans.scratch import spool, temporary
from qualitygate.sources.metrics_log import MetricsLog
from qualitygate.spec import KEYS, DatasetSpec

#: Rows of a file that a batch is written to. Spark counts a file as 4 MB at least and gives a task 128 MB, so no task gets more
#: than 32 such files, however well they compress, and what it sorts and counts has a limit.
ROWS_PER_FILE = 50_000


def drop_repeats(stream: DataFrame, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other, with state bounded by it.

    Spark drops rows that are later than the watermark; a batch run over the whole table, with the
    log as ``scored``, picks those up. ``event_time`` must be a timestamp with time zone.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(KEYS))


def score_stream(
    stream: DataFrame,
    spec: DatasetSpec,
    evaluator: Evaluator,
    log: MetricsLog,
    checkpoint: str,
    rate: float = 1.0,
    only_passing: bool = False,
    as_of: Column | None = None,
    rejects: str | None = None,
    seen_since: str | None = None,
    remember: str | None = None,
    clock: Column | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    tie_break: Sequence[str] = (),
) -> StreamingQuery:
    """Route, score and append what has arrived, then stop.

    Every micro-batch leaves out keys the log already has, so a batch that is replayed after a lost
    driver, or a row that comes twice, is neither scored nor appended again. Size the batches with
    the source's own options (``maxFilesPerTrigger``); each one is written before the next begins,
    which bounds the work a failure can lose. ``seen_since`` (a date) limits how far back the log is
    searched when repeats are known to come within some days. Rows that cannot be scored stop the
    stream unless ``rejects`` names a folder for them. ``on_batch`` gets every micro-batch before scoring,
    e.g. for deterministic checks. Intermediate tables of a batch
    are removed when it is done. Only keys scored by this evaluator count as known; of rows with equal
    keys the first by ``tie_break`` is scored.

    ``remember`` (an interval such as ``"7 days"``) keeps the keys that came through as state of the stream
    for at least that long instead, so that a batch costs the same however long the log is: the log is
    read for the first batch after a start only, which may be a replayed one. It counts from ``clock``, by default the time at
    which a row's batch began; rows more than ``remember`` older than the newest clock are left out, which
    the default never has. State is bounded by the keys of that time. Of equal keys in a batch any row may be the first
    then, and keys scored before the stream's checkpoint was made are known to its first batch only.
    """
    log.create()
    if remember is not None:
        came = F.current_timestamp() if clock is None else clock.cast("timestamp")
        stream = drop_repeats(stream.withColumn("_clock", came), "_clock", remember).drop("_clock")
    begun: list[int] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        with temporary(batch.sparkSession):
            arrived = spool(batch, ROWS_PER_FILE)  # read and routed once, for checks and for scoring
            if on_batch is not None:
                on_batch(arrived, batch_id)
            rows = passing_rows(arrived, spec, as_of) if only_passing else arrived
            routed = route_hash_sample(rows, spec, rate)
            seen = log.seen(evaluator.name, seen_since) if remember is None or not begun else None
            begun.append(batch_id)
            score_into(
                log, routed, spec, evaluator, f"batch-{batch_id}", seen, repeat_copies=False, rejects=rejects,
                tie_break=tie_break, unique=remember is not None,
            )

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
