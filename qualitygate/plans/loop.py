"""The whole loop: check, route, score, append, then gate and measure from the log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitygate.functions import sample_hash
from qualitygate.operators.checks import check_report
from qualitygate.operators.evaluators import Evaluator
from qualitygate.operators.gate import decide, review_queue, scoring_outcome
from qualitygate.operators.metrics import drift_report, drift_trend, loop_metrics
from qualitygate.operators.routing import route_prefix
from qualitygate.operators.scoring import Scored, same_key, score, score_and_split, score_queued, unscored
from qualitygate.plans.scratch import new_folder, pin, spool
from qualitygate.sources.metrics_log import MetricsLog, latest_per_key
from qualitygate.spec import KEYS, VERSION, DatasetSpec, Options


def score_into(
    log: MetricsLog,
    df: DataFrame,
    spec: DatasetSpec,
    evaluator: Evaluator,
    run_id: str,
    scored: Scored | None = None,
    repeat_copies: bool = True,
    rejects: str | None = None,
    tie_break: Sequence[str] = (),
    unique: bool = False,
    queue: str | None = None,
) -> None:
    """Score ``df`` and append the evaluations to ``log``.

    Of rows with equal keys the first by ``tie_break`` is scored. Rows that cannot be scored end the job, or are appended with the reason to the Parquet folder
    ``rejects`` if there is one. With a ``queue`` (a folder, for a batch evaluator) a call that was killed is
    gone on with by the same call again: see ``score_queued``; what it had appended is not appended again.
    """
    how = {"scored": scored, "unique": unique, "repeat_copies": repeat_copies}
    if queue is not None:
        evals, bad = score_queued(df, spec, evaluator, queue, tie_break, **how)
        if rejects is None and not bad.isEmpty():
            raise ValueError(f"rows could not be scored, the first because of: {bad.first().error}")
        evals = unscored(evals, log.read().filter(F.col("run_id") == run_id))
    elif rejects is None:
        log.append(score(df, spec, evaluator, tie_break, **how), run_id)
        return
    else:
        evals, bad = score_and_split(df, spec, evaluator, tie_break, **how)
    log.append(evals, run_id)
    if rejects is None:
        return
    bad.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(rejects)


@dataclass(frozen=True)
class LoopResult:
    """What a loop left behind. Tables are computed when asked for, from the log."""

    run_id: str
    report: DataFrame
    evaluations: DataFrame
    decisions: DataFrame
    log: MetricsLog
    spec: DatasetSpec
    options: Options

    def review(self) -> DataFrame:
        """Rows for people to look at."""
        return review_queue(self.evaluations, self.decisions, self.options.review_k, self.spec.review_reason)

    def metrics(self, labels: DataFrame | None = None) -> DataFrame:
        return loop_metrics(self.evaluations, labels, self.options.disagreement_threshold)

    def trend(self) -> DataFrame:
        return drift_trend(self.log.read())

    def history(self) -> DataFrame:
        return drift_report(self.log.read())


def run_loop(
    df: DataFrame,
    spec: DatasetSpec,
    evaluator: Evaluator,
    log: MetricsLog,
    baseline: str,
    candidates: Sequence[str],
    as_of: Column | None = None,
    options: Options = Options(),
    rejects: str | None = None,
    skip_scored: bool = False,
    slices: int = 1,
    tie_break: Sequence[str] = (),
    queue: str | None = None,
) -> LoopResult:
    """Run one loop over the ``baseline`` and ``candidates`` versions of ``df``.

    The single forced step is the append to ``log``; gate and metrics read this run's rows back from
    there and never score again. Failing checks are reported and do not stop scoring. Rows that
    cannot be scored end the job unless ``rejects`` names a folder for them.

    ``slices`` splits the work by a hash of the row id into that many appends, so that a lost driver
    costs at most one slice; start again with ``skip_scored=True`` to go on where it stopped: keys this
    evaluator has scored before are left out, and the gate looks at the newest evaluation of
    each key that was routed now. Of rows with equal keys the first by ``tie_break`` is scored.

    ``queue`` names a folder for the rows that wait for a batch evaluator. A loop that was killed is gone on with
    by the same call with the same folder: it is the same run, and rows that were scored are not
    scored again.
    """
    if queue is not None and slices > 1:
        raise ValueError("a queue is worked off in turns of its own and takes no slices")
    versions = list(dict.fromkeys([baseline, *candidates]))
    rows = df.filter(F.col(VERSION).isin(*versions))
    day = F.current_date() if as_of is None else as_of
    report = pin(check_report(rows, spec, day, options.max_age_days, versions))

    run_id = uuid.uuid4().hex if queue is None else uuid.uuid5(uuid.NAMESPACE_URL, queue).hex
    log.create()
    routed = route_prefix(rows, spec, options.sample_rate, tie_break=tie_break)
    if slices > 1:
        folder = new_folder(df.sparkSession, "routed")
        place = F.pmod(F.floor(sample_hash(F.coalesce(KEYS[0], F.lit("")))), F.lit(slices)).cast("int")
        cut = routed.withColumn("_slice", place)
        cut.write.partitionBy("_slice").parquet(folder)
        routed = df.sparkSession.read.schema(cut.schema).parquet(folder)
    for part in range(slices):
        share = routed.filter(F.col("_slice") == part).drop("_slice") if slices > 1 else routed
        seen = log.seen(evaluator.name) if skip_scored else None
        score_into(log, share, spec, evaluator, run_id, scored=seen, rejects=rejects, tie_break=tie_break, queue=queue)

    mine = log.read().filter(F.col(VERSION).isin(*versions) & (F.col("backend") == evaluator.name))
    if skip_scored:
        keys = spool(routed.select(*[F.col(k).alias(f"_r_{k}") for k in KEYS]).distinct())
        newest = latest_per_key(mine)
        mine = spool(newest.join(keys, same_key(newest, keys, "_r_"), "left_semi"))
    else:
        mine = mine.filter(F.col("run_id") == run_id)
    decisions = pin(decide(mine, candidates, baseline, options, scoring_outcome(routed, mine)))
    return LoopResult(run_id, report, mine, decisions, log, spec, options)
