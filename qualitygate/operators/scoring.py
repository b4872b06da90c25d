"""Scoring: one evaluation per routed row, each (row id, version) evaluated once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.functions import answers_or_raise, answers_problem, row_quality, token_cost
from qualitygate.operators.evaluators import BatchEvaluator, Evaluator, state_columns
from qualitygate.plans import fits, spool
from qualitygate.plans.broadcasting import BROADCAST_ROWS
from qualitygate.plans.work_queue import WorkQueue
from qualitygate.spec import EVALUATION, KEYS, DatasetSpec

COPIES_PER_CHUNK = 10_000


def same_key(left: DataFrame, right: DataFrame, prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in KEYS])


def _renamed_keys(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in KEYS])


@dataclass(frozen=True)
class Repeats:
    """Keys that occur more than once (``_n`` times), how many they are, and the most rows of one."""

    keys: DataFrame
    n_keys: int
    most: int


def count_keys(df: DataFrame) -> DataFrame:
    """Rows per key. Reads and moves the two key columns only, copies collapsing before the shuffle."""
    return df.groupBy(*KEYS).agg(F.count("*").alias("_n"))


def repeated_keys(df: DataFrame, counted: DataFrame | None = None) -> Repeats:
    """``counted`` is the written result of ``count_keys``, if there is one already."""
    keys = spool(count_keys(df).filter(F.col("_n") > 1)) if counted is None else counted.filter(F.col("_n") > 1)
    n_keys, most = keys.agg(F.count("*"), F.max("_n")).first()
    return Repeats(keys, n_keys, most or 1)


def first_per_key(df: DataFrame, tie_break: Sequence[str] = (), repeats: Repeats | None = None) -> DataFrame:
    """One row per key with ``_copies``; the first by ``tie_break``, then by the content columns.

    Only rows whose key repeats are moved: as long as those keys are few, all other rows, with all
    their text, stay where they were read. Bookkeeping columns come along with the row chosen.
    """
    content = state_columns(df)
    columns = [*df.columns, "_copies"]
    order = list(dict.fromkeys([*tie_break, *content]))
    repeats = repeated_keys(df) if repeats is None else repeats
    if not repeats.n_keys:
        return df.withColumn("_copies", F.lit(1).cast("long"))
    if repeats.n_keys > BROADCAST_ROWS:
        return _collapse(df, order, repeats.keys).select(*columns)
    marks = F.broadcast(_renamed_keys(repeats.keys, "_r_"))
    known = same_key(df, marks, "_r_")
    single = df.join(marks, known, "left_anti").withColumn("_copies", F.lit(1).cast("long"))
    return single.unionByName(_collapse(df.join(marks, known, "left_semi"), order, F.broadcast(repeats.keys)).select(*columns))


def _collapse(df: DataFrame, order: Sequence[str], repeats: DataFrame) -> DataFrame:
    """The first row per key. Each task keeps one of a key before the shuffle; numbers of copies are counted on keys alone."""
    rest = [c for c in df.columns if c not in (*KEYS, *order)]
    first = Window.partitionBy(*KEYS).orderBy(*[F.col(c).asc_nulls_last() for c in (*order, *rest)])
    picked = df.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") == 1).drop("_place")
    numbers = repeats.select(*[F.col(k).alias(f"_n_{k}") for k in KEYS], F.col("_n").alias("_number"))
    together = picked.join(numbers, same_key(picked, numbers, "_n_"), "left")
    return together.select(*df.columns, F.coalesce("_number", F.lit(1)).cast("long").alias("_copies"))


#: Keys that are scored already: a table that has them, or a function that finds those among the keys asked for.
Scored = DataFrame | Callable[[DataFrame], DataFrame]


def unscored(df: DataFrame, scored: Scored, counted: DataFrame | None = None) -> DataFrame:
    """Rows whose key is not in ``scored``: any table with the keys, or ``MetricsLog.seen``, which reads what is needed of the log.

    Old and new keys are told apart on the key columns alone, and few keys are sent to the log
    rather than the log to them. The rows themselves move only if neither the known nor the
    new keys are few. ``counted`` is the written result of ``count_keys``, if there is one already.
    """
    # one shuffle for the keys of the log: they are told apart by the columns that they are joined on
    asked = spool(count_keys(df)) if counted is None else counted
    log = _renamed_keys(scored(asked) if callable(scored) else scored, "_s_")
    if fits(asked):
        log = log.join(F.broadcast(asked), same_key(asked, log, "_s_"), "left_semi")
    known = spool(_renamed_keys(asked.join(log, same_key(asked, log, "_s_"), "left_semi"), "_k_"))
    n_known = known.count()
    if not n_known:
        return df
    if n_known <= BROADCAST_ROWS:
        return df.join(F.broadcast(known), same_key(df, known, "_k_"), "left_anti")
    fresh = spool(_renamed_keys(asked.join(known, same_key(asked, known, "_k_"), "left_anti"), "_f_"))
    if fits(fresh):
        return df.join(F.broadcast(fresh), same_key(df, fresh, "_f_"), "left_semi")
    return df.join(known, same_key(df, known, "_k_"), "left_anti")


def _evaluations(answered: DataFrame, spec: DatasetSpec, evaluator: Evaluator) -> DataFrame:
    return answered.select(
        *[F.col(k).cast("string").alias(k) for k in KEYS],
        "answers",
        row_quality(spec.quality_weights, spec.questions).alias("quality"),
        F.lit(evaluator.name).alias("backend"),
        "latency_ms",
        token_cost(F.col("tokens"), evaluator.price_per_mtok).alias("cost_usd"),
        "error",
        "_copies",
    )


def _answered(
    df: DataFrame, spec: DatasetSpec, evaluator: Evaluator, tie_break: Sequence[str], repeats: Repeats | None, unique: bool
) -> DataFrame:
    once = df.withColumn("_copies", F.lit(1).cast("long")) if unique else first_per_key(df, tie_break, repeats)
    return evaluator.answers(once, spec)


def score_with_errors(
    df: DataFrame,
    spec: DatasetSpec,
    evaluator: Evaluator,
    tie_break: Sequence[str] = (),
    repeats: Repeats | None = None,
    unique: bool = False,
) -> DataFrame:
    """One evaluation per key, plus ``error`` (NULL if fine) and ``_copies`` in the input.

    ``unique=True`` says that keys are known not to repeat and skips looking for copies.
    """
    return _checked(_answered(df, spec, evaluator, tie_break, repeats, unique), spec, evaluator)


def _checked(answered: DataFrame, spec: DatasetSpec, evaluator: Evaluator) -> DataFrame:
    """Evaluations with the reason why they cannot be used, and then without answers."""
    rows = _evaluations(answered.withColumn("error", answers_problem(spec.questions)), spec, evaluator)
    fine = F.col("error").isNull()
    return rows.withColumns({c: F.when(fine, F.col(c)) for c in ("answers", "quality")})


def accepted(scored: DataFrame) -> DataFrame:
    """Rows without an error."""
    return scored.filter(F.col("error").isNull())


def quarantined(scored: DataFrame) -> DataFrame:
    """Keys of rows that could not be scored, with the reason."""
    return scored.filter(F.col("error").isNotNull()).select(*KEYS, "error")


def per_input_row(scored: DataFrame, deal: bool = False, chunk: int = COPIES_PER_CHUNK) -> DataFrame:
    """Repeat each evaluation for every copy of its key in the input.

    With ``deal`` the copies are dealt out over the cluster in chunks, for keys with very many.
    """
    one, size, copies = F.lit(1).cast("long"), F.lit(chunk).cast("long"), F.col("_copies")
    rows = scored
    if deal:
        rows = (
            scored.withColumn("_start", F.explode(F.sequence(one - 1, copies - 1, size)))
            .repartition(*KEYS, "_start")
            .withColumn("_copies", F.least(copies - F.col("_start"), size))
            .drop("_start")
        )
    return rows.withColumn("_i", F.explode(F.sequence(one, copies))).drop("_i")


def _to_score(
    df: DataFrame, scored: Scored | None, unique: bool
) -> tuple[DataFrame, Repeats | None]:
    """The rows that are left to score, and which keys repeat among them (None if none can)."""
    counted = None
    if scored is not None:
        counted = spool(count_keys(df))
        df = unscored(df, scored, counted)
    return df, None if unique else repeated_keys(df, counted)


def _repeat(rows: DataFrame, repeats: Repeats | None, repeat_copies: bool) -> DataFrame:
    if repeats is not None and repeats.n_keys and repeat_copies:
        rows = per_input_row(rows, deal=repeats.most > COPIES_PER_CHUNK)
    return rows.select(*EVALUATION.fieldNames())


def score(
    df: DataFrame,
    spec: DatasetSpec,
    evaluator: Evaluator,
    tie_break: Sequence[str] = (),
    scored: Scored | None = None,
    unique: bool = False,
    repeat_copies: bool = True,
) -> DataFrame:
    """Evaluations of ``df``: one per input row, equal keys sharing the result of the first.

    ``scored`` (the metrics log) names keys to leave out. An answer outside its range ends the job;
    ``score_and_split`` sets such rows aside instead.

    The result is lazy: every action on it scores again. Append it to the metrics log or ``pin`` it
    before using it twice, at the latest when scoring costs money.
    """
    df, repeats = _to_score(df, scored, unique)
    answered = _answered(df, spec, evaluator, tie_break, repeats, unique)
    rows = _evaluations(answered.filter(answers_or_raise(spec.questions)), spec, evaluator)
    return _repeat(rows, repeats, repeat_copies)


def score_and_split(
    df: DataFrame,
    spec: DatasetSpec,
    evaluator: Evaluator,
    tie_break: Sequence[str] = (),
    scored: Scored | None = None,
    unique: bool = False,
    repeat_copies: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The evaluations, and the keys that could not be scored with the reason.

    Rows are scored once, into the shared folder, and both tables read from there.
    """
    df, repeats = _to_score(df, scored, unique)
    rows = spool(score_with_errors(df, spec, evaluator, tie_break, repeats, unique))
    return _repeat(accepted(rows), repeats, repeat_copies), quarantined(rows)


def score_queued(
    df: DataFrame,
    spec: DatasetSpec,
    evaluator: BatchEvaluator,
    folder: str,
    tie_break: Sequence[str] = (),
    scored: Scored | None = None,
    unique: bool = False,
    repeat_copies: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``score_and_split`` for a run that may be killed: call it again with the same ``folder`` and it goes on.

    The rows to score are chosen and written to ``folder`` once, by the first call; later ones look at
    nothing else, whatever ``df`` holds by then. Files that were finished are not scored again.
    """
    queue = WorkQueue(df.sparkSession, folder)
    if not queue.filled():
        rows, repeats = _to_score(df, scored, unique)
        once = rows.withColumn("_copies", F.lit(1).cast("long")) if unique else first_per_key(rows, tie_break, repeats)
        queue.fill(once, evaluator.task_rows, evaluator.options.max_concurrency)
    answered = replace(evaluator, queue=folder, throttle=True).answers(df.sparkSession.read.parquet(queue.tasks), spec)
    every = spool(_checked(answered, spec, evaluator))
    fine = accepted(every)
    if repeat_copies:
        fine = per_input_row(fine, deal=(fine.agg(F.max("_copies")).first()[0] or 1) > COPIES_PER_CHUNK)
    return fine.select(*EVALUATION.fieldNames()), quarantined(every)
