"""The circuit breaker: pass or block a version, and name the rows people should look at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.functions import fixed
from qualitygate.plans import first_by, names_table, small_side
from qualitygate.spec import ANSWERS, KEYS, ROW_ID, VERSION, Options

CLOSED = "closed"
OPEN = "open"
WINDOW_K = 1_000
INLINE_VERSIONS = 1_000


def scoring_outcome(routed: DataFrame, evals: DataFrame) -> DataFrame:
    """Per version: ``n_routed`` keys sent to scoring and ``n_rejected`` of them without an evaluation.

    Only the key columns move, copies collapsing before the shuffle.
    """
    asked = routed.groupBy(*KEYS).agg(F.lit(0).alias("_scored"))
    known = evals.select(*[F.col(k).cast("string").alias(k) for k in KEYS]).groupBy(*KEYS).agg(F.lit(1).alias("_scored"))
    keys = asked.select(*[F.col(k).cast("string").alias(k) for k in KEYS], "_scored", F.lit(1).alias("_asked"))
    both = keys.union(known.withColumn("_asked", F.lit(0))).groupBy(*KEYS).agg(F.max("_scored").alias("_scored"), F.max("_asked").alias("_asked"))
    return both.filter("_asked = 1").groupBy(VERSION).agg(
        F.count("*").alias("n_routed"), F.sum(1 - F.col("_scored")).alias("n_rejected")
    )


def decide(
    evals: DataFrame,
    versions: Sequence[str] | None = None,
    baseline: float | str | None = None,
    options: Options = Options(),
    outcome: DataFrame | None = None,
) -> DataFrame:
    """One decision per version.

    ``baseline`` is a mean quality or the name of the version whose mean to use; without one, or
    if that version has no rows, drift is 0 and only the floor counts. A version is open if it
    drifted by more than ``drift_threshold`` or its mean is below ``quality_floor``.
    ``versions`` asks for exactly those; one without rows is closed with mean 1.

    ``outcome`` (``scoring_outcome``) says how many rows were sent to scoring. A version that had
    rows but no evaluation, or lost a larger share than ``max_rejected``, is open, and so is one whose
    rows have no quality: what could not be judged is not passed.
    """
    named = isinstance(baseline, str)
    rows = evals
    if versions is not None:
        rows = evals.filter(F.col(VERSION).isin(*versions, *([baseline] if named else [])))
    means = rows.groupBy(VERSION).agg(F.avg("quality").alias("_mean"), F.count("*").alias("n_rows"))
    base = F.lit(None if named else baseline).cast("double")
    if named:
        # over one row per version; saves reading the evaluations a second time
        of_baseline = F.max(F.when(F.col(VERSION) == baseline, F.col("_mean"))).over(Window.partitionBy())
        means = means.withColumn("_base", of_baseline)
        base = F.col("_base")
    if outcome is None:
        means = means.withColumns({c: F.lit(None).cast("long") for c in ("n_routed", "n_rejected")})
    else:
        sent = outcome.withColumnRenamed(VERSION, "_sent")
        both = means.join(sent, F.col(VERSION).eqNullSafe(F.col("_sent")), "full")
        means = both.withColumn(VERSION, F.coalesce(VERSION, "_sent")).drop("_sent")
    if versions is not None:
        asked = names_table(evals.sparkSession, versions, VERSION)
        means = asked.join(means, VERSION, "left")

    seen = F.col("n_rows").isNotNull() & (F.col("n_rows") > 0)
    lost, sent_rows = F.coalesce("n_rejected", F.lit(0)), F.coalesce("n_routed", F.lit(0))
    unjudged = (sent_rows > 0) & (F.col("n_rows") == 0)
    rejected = lost > sent_rows * F.lit(float(options.max_rejected))
    unknown = (F.col("n_rows") > 0) & F.col("mean_quality").isNull()
    failed = unjudged | rejected | unknown
    mean, drift = F.col("mean_quality"), F.col("drift_vs_baseline")
    threshold, floor = F.lit(float(options.drift_threshold)), F.lit(float(options.quality_floor))
    by_drift, by_floor = F.col("tripped_by_drift"), F.col("tripped_by_floor")
    tripped = by_drift | by_floor | failed

    def said(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else fixed(p, 2) for p in parts])

    reason = (
        F.when(unjudged, F.concat(F.lit("none of "), sent_rows, F.lit(" routed rows could be scored")))
        .when(F.col("n_rows") == 0, "no rows evaluated")
        .when(
            tripped,
            F.concat_ws(
                "; ",
                F.when(rejected, F.concat(lost, F.lit(" of "), sent_rows, F.lit(" routed rows could not be scored"))),
                F.when(unknown, "no quality among the rows evaluated"),
                F.when(by_drift, said("semantic drift ", drift, " > ", threshold)),
                F.when(by_floor, said("mean quality ", mean, " < floor ", floor)),
            ),
        )
        .otherwise(said("mean quality ", mean, " within tolerance (drift ", drift, " <= ", threshold, ")"))
    )
    wanted = F.least(F.col("n_rows"), F.lit(options.review_k).cast("long"))
    return (
        means.select(
            VERSION,
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.when(seen, F.col("_mean")).otherwise(F.lit(1.0)).alias("mean_quality"),
            F.when(seen, F.coalesce(base - F.col("_mean"), F.lit(0.0))).otherwise(F.lit(0.0)).alias("drift_vs_baseline"),
            "n_routed",
            "n_rejected",
        )
        .withColumn("threshold", threshold)
        .withColumn("tripped_by_drift", drift > threshold)
        .withColumn("tripped_by_floor", F.coalesce(mean < floor, F.lit(False)))
        .withColumn("state", F.when(tripped, OPEN).otherwise(CLOSED))
        .withColumn("reason", reason)
        .withColumn("routed_to_review", F.when(tripped, wanted).otherwise(F.lit(0)).cast("long"))
    )


def worst_rows(evals: DataFrame, k: int = Options.review_k) -> DataFrame:
    """The ``k`` rows of lowest quality of each version; NULLs last, ties by row id and then by all columns.

    For a small ``k`` every task keeps only its own k per version before the shuffle; a large one
    goes by range partitions, so that no task has to order a whole version.
    """
    sortable = evals
    if "answers" in evals.columns:
        sortable = evals.withColumn("answers", F.to_json("answers", {"ignoreNullFields": "false"}))
    ties = [ROW_ID, *[c for c in sortable.columns if c not in (VERSION, "quality", ROW_ID)]]
    if k > WINDOW_K:
        worst = first_by(sortable, [VERSION], "quality", ties, lambda n: F.lit(k).cast("long"))
    else:
        order = Window.partitionBy(VERSION).orderBy(*[F.col(c).asc_nulls_last() for c in ("quality", *ties)])
        worst = sortable.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k).drop("_place")
    return worst.withColumn("answers", F.from_json("answers", ANSWERS)) if sortable is not evals else worst


def review_queue(evals: DataFrame, decisions: DataFrame, k: int = Options.review_k, why: str = "") -> DataFrame:
    """Rows for human review: the worst of every open version."""
    worst = worst_rows(_of_versions(evals, decisions, OPEN), k)
    return worst.select(VERSION, ROW_ID, "quality", F.lit(why).alias("why_flagged"))


def release(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of closed versions only; what downstream may read."""
    return _of_versions(df, decisions, CLOSED)


def _of_versions(df: DataFrame, decisions: DataFrame, state: str) -> DataFrame:
    """Rows of the versions in ``state``.

    A gate decides on a few versions at a time, so their names become a filter, which prunes
    partitions and reaches the scan. With more names than that it is a semi join.
    """
    chosen = decisions.filter(F.col("state") == state).select(VERSION)
    names = chosen.take(INLINE_VERSIONS + 1)
    if len(names) > INLINE_VERSIONS:
        many = small_side(chosen.withColumnRenamed(VERSION, "_chosen"))
        return df.join(many, F.col(VERSION).eqNullSafe(F.col("_chosen")), "left_semi")
    known = [r[0] for r in names if r[0] is not None]
    keep = F.col(VERSION).isin(*known) if known else F.lit(False)
    return df.filter(keep | F.col(VERSION).isNull()) if len(known) < len(names) else df.filter(keep)
