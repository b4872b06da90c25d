"""Exact order statistics without sorting a group in one task.

``first_by`` keeps the first k rows of every group by one column. It looks for the value of that
column at the cut first, on a narrow table of distinct values and their counts, and then filters
the full rows by it, so wide rows are neither shuffled nor written. Only rows that tie at the cut
are ordered by the remaining columns, by ``first_rows``.

Both find a cut in the same way: range-partition on the order, write the partition number down
with the rows, count per (group, partition), and number rows only inside the one partition that
holds the cut.

``value_at_rank`` finds the value at given ranks of a numeric column. Quantile sketches propose an
interval, exact counts decide which side of it the rank is on, and the interval shrinks until few
distinct values are left to order. No row is shuffled before that.

All are exact whatever the sketch or the range bounds look like: those only set how much work is
left, not what comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.plans.scratch import spool
from qualitygate.plans.broadcasting import small_side

WINDOW_ROWS = 1_000_000
SMALL_TABLE_ROWS = 100_000
SKETCH_STEPS = 500
SKETCH_ACCURACY = 10_000


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _buckets(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` written down with the number ``_bucket`` of its range partition."""
    ranged = df.repartitionByRange(*[F.col(g) for g in groups], *order)
    return spool(ranged.withColumn("_bucket", F.spark_partition_id()))


def _reached(tagged: DataFrame, groups: Sequence[str], weight: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Per (group, bucket) that holds rows to keep: ``_rows`` in it and ``_room`` left for it."""
    whole_group = Window.partitionBy(*groups)
    up_to_here = whole_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = tagged.groupBy(*groups, "_bucket").agg(F.sum(weight).alias("_rows"))
    room = keep(F.sum("_rows").over(whole_group)) - (F.sum("_rows").over(up_to_here) - F.col("_rows"))
    named = [F.col(g).alias(f"_cut_{g}") for g in groups]
    return (
        sizes.withColumn("_room", room)
        .filter(F.col("_room") > 0)
        .select(*named, F.col("_bucket").alias("_cut_bucket"), "_rows", "_room")
    )


def _bucket_pairs(groups: Sequence[str]) -> list[tuple[str, str]]:
    return [("_bucket", "_cut_bucket"), *[(g, f"_cut_{g}") for g in groups]]


def first_rows(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    keep: Callable[[Column], Column],
) -> DataFrame:
    """The first ``keep(group size)`` rows of each group. Moves and writes the rows.

    ``order`` must tell apart all rows that differ, so that equal rows are interchangeable;
    a random last range key then spreads copies of one hot row over many partitions.
    """
    columns = df.columns
    tagged = _buckets(df.withColumn("_salt", F.rand(11)), groups, [*order, F.col("_salt")])
    cuts = small_side(_reached(tagged, groups, F.lit(1), keep))
    reached = tagged.join(cuts, _same(tagged, cuts, _bucket_pairs(groups)), "inner")

    before_cut = reached.filter(F.col("_rows") <= F.col("_room")).select(*columns)
    numbering = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    at_cut = (
        reached.filter(F.col("_rows") > F.col("_room"))
        .withColumn("_place", F.row_number().over(numbering))
        .filter(F.col("_place") <= F.col("_room"))
        .select(*columns)
    )
    return before_cut.unionByName(at_cut)


def _cut_values(counted: DataFrame, groups: Sequence[str], by: str, keep: Callable[[Column], Column]) -> DataFrame:
    """Per group: the value ``_at`` of the last row to keep, ``_copies`` of it and ``_take`` of those.

    ``counted`` has the ``_copies`` of each value of each group.
    """
    tagged = _buckets(counted, groups, [F.col(by).asc_nulls_last()])
    reached = _reached(tagged, groups, F.col("_copies"), lambda n: F.least(keep(n), n))
    last = small_side(reached.filter(F.col("_room") <= F.col("_rows")))
    inside = tagged.join(last, _same(tagged, last, _bucket_pairs(groups)), "inner")
    running = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy(F.col(by).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    take = F.col("_room") - (F.sum("_copies").over(running) - F.col("_copies"))
    return (
        inside.withColumn("_take", take)
        .filter((F.col("_take") > 0) & (F.col("_take") <= F.col("_copies")))
        .select(*[F.col(g).alias(f"_cut_{g}") for g in groups], F.col(by).alias("_at"), "_copies", "_take")
    )


def first_by(
    df: DataFrame,
    groups: Sequence[str],
    by: str,
    ties: Sequence[str],
    keep: Callable[[Column], Column],
) -> DataFrame:
    """The first ``keep(group size)`` rows of each group by ``by``, then by ``ties``; NULLs last.

    ``ties`` must tell apart all rows that differ. A table counted to be small is simply numbered.
    """
    columns = df.columns
    counted = spool(df.groupBy(*groups, by).agg(F.count("*").alias("_copies")))
    if (counted.agg(F.sum("_copies")).first()[0] or 0) <= SMALL_TABLE_ROWS:
        sized = df.withColumn("_size", F.count("*").over(Window.partitionBy(*groups)))
        return _numbered(sized, groups, (by, *ties), keep(F.col("_size"))).select(*columns)
    cuts = small_side(_cut_values(counted, groups, by, keep))
    joined = df.join(cuts, _same(df, cuts, [(g, f"_cut_{g}") for g in groups]), "inner")
    value, at = F.col(by), F.col("_at")
    before = F.when(at.isNull(), value.isNotNull()).otherwise(F.coalesce(value < at, F.lit(False)))
    whole = F.col("_take") == F.col("_copies")
    kept = joined.filter(before | (whole & value.eqNullSafe(at))).select(*columns)
    n_tied = cuts.filter(~whole).agg(F.sum("_copies")).first()[0] or 0
    if not n_tied:
        return kept
    tied = joined.filter(~whole & value.eqNullSafe(at)).select(*columns, "_take")
    if n_tied <= SMALL_TABLE_ROWS:
        some = _numbered(tied, groups, ties, F.col("_take"))
    else:
        order = [F.col(c).asc_nulls_last() for c in ties]
        some = first_rows(tied, [*groups, "_take"], order, lambda n: F.col("_take"))
    return kept.unionByName(some.select(*columns))


def _numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], limit: Column) -> DataFrame:
    """The plain way, for few rows: number each group in one task."""
    place = Window.partitionBy(*groups).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= limit)


def value_at_rank(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    ranks: Mapping[str, Callable[[Column], Column]],
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """One row per group with, for each entry of ``ranks``, the value at that 0-based rank.

    NULL values are not ranked. Each entry maps the group's number of values to a rank.
    """
    keys = [f"_g{i}" for i in range(len(groups))] or ["_g0"]
    key_columns = [F.col(g) for g in groups] or [F.lit(0)]
    rows = df.select(*[c.alias(k) for c, k in zip(key_columns, keys)], F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull()
    )

    rows = spool(rows)  # narrow; whatever made the values is not done again in every round
    size = F.col("_size")
    targets = F.array(*[F.struct(F.lit(n).alias("_name"), r(size).cast("long").alias("_rank")) for n, r in ranks.items()])
    none = F.lit(None).cast("double")
    state = small_side(
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_size"))
        .select(*keys, "_size", F.inline(targets))
        .withColumn("_above", none)
        .withColumn("_below", none)
        .withColumn("_answer", none)
    )
    while (state.filter(F.col("_answer").isNull()).agg(F.max("_size")).first()[0] or 0) > window_rows:
        state = _narrow(rows, keys, state, not groups)

    open_rows = _inside(rows, keys, state, not groups)
    id_columns = [*keys, "_name"]
    counted = open_rows.groupBy(*id_columns, "_rank", "_v").agg(F.count("*").alias("_copies"))
    running = Window.partitionBy(*id_columns).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.sum("_copies").over(running)
    found = (
        counted.withColumn("_reached", reached)
        .filter((F.col("_reached") > F.col("_rank")) & (F.col("_reached") - F.col("_copies") <= F.col("_rank")))
        .select(*id_columns, F.col("_v").alias("_answer"))
    )
    settled = state.filter(F.col("_answer").isNotNull()).select(*id_columns, "_answer")
    picks = [F.max(F.when(F.col("_name") == n, F.col("_answer"))).alias(n) for n in ranks]
    per_group = settled.unionByName(found).groupBy(*keys).agg(*picks)
    return per_group.select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], *ranks)


def _inside(rows: DataFrame, keys: Sequence[str], state: DataFrame, single: bool) -> DataFrame:
    """Rows strictly between the bounds of each unsettled target, one copy per target.

    With a ``single`` group the bounds are literals and nothing is joined.
    """
    todo = state.filter(F.col("_answer").isNull())
    v, above, below = F.col("_v"), F.col("_above"), F.col("_below")
    if single:
        ends = [(t, t["_above"], t["_below"]) for t in todo.collect()]  # one row per wanted rank
        inside = [
            F.when(
                (F.lit(True) if a is None else v > F.lit(a)) & (F.lit(True) if b is None else v < F.lit(b)),
                F.struct(*[F.lit(t[c]).cast(todo.schema[c].dataType).alias(c) for c in ("_name", "_rank", "_size", "_above", "_below")]),
            )
            for t, a, b in ends
        ]
        none = F.array().cast("array<struct<_name:string,_rank:bigint,_size:bigint,_above:double,_below:double>>")
        hits = F.filter(F.array(*inside), lambda t: t.isNotNull()) if inside else none
        return rows.select(*keys, "_v", F.inline(hits))
    renamed = todo.select(*[F.col(k).alias(f"_s{k}") for k in keys], *[c for c in todo.columns if c not in keys])
    joined = rows.join(renamed, _same(rows, renamed, [(k, f"_s{k}") for k in keys]), "inner")
    return joined.filter((above.isNull() | (v > above)) & (below.isNull() | (v < below))).select(
        *keys, "_v", "_name", "_rank", "_size", "_above", "_below"
    )


def _narrow(rows: DataFrame, keys: Sequence[str], state: DataFrame, single: bool) -> DataFrame:
    """One round: propose an interval per target from a sketch, then count to see where the rank lies."""
    ids = [*keys, "_name", "_rank", "_size", "_above", "_below"]
    inside = _inside(rows, keys, state, single)
    steps = [i / SKETCH_STEPS for i in range(SKETCH_STEPS + 1)]
    at = F.floor(F.col("_rank") / F.col("_size") * SKETCH_STEPS).cast("int") + 1
    proposed = small_side(
        inside.groupBy(*ids)
        .agg(F.percentile_approx("_v", steps, SKETCH_ACCURACY).alias("_q"))
        .select(
            *ids,
            F.element_at("_q", F.greatest(at - 1, F.lit(1))).alias("_lo"),
            F.element_at("_q", F.least(at + 2, F.lit(SKETCH_STEPS + 1))).alias("_hi"),
        )
    )
    bounds = proposed.select(
        *[F.col(k).alias(f"_p{k}") for k in keys], F.col("_name").alias("_p_name"), "_lo", "_hi"
    )
    pairs = [*[(k, f"_p{k}") for k in keys], ("_name", "_p_name")]
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    counts = (
        inside.join(bounds, _same(inside, bounds, pairs), "inner")
        .groupBy(*ids, "_lo", "_hi")
        .agg(
            F.count_if(v < lo).alias("_n1"),
            F.count_if(v == lo).alias("_n2"),
            F.count_if((v > lo) & (v < hi)).alias("_n3"),
            F.count_if((v == hi) & (hi > lo)).alias("_n4"),
        )
    )
    rank, n1, n2, n3, n4 = (F.col(c) for c in ("_rank", "_n1", "_n2", "_n3", "_n4"))
    case = (
        F.when(rank < n1, 1).when(rank < n1 + n2, 2).when(rank < n1 + n2 + n3, 3).when(rank < n1 + n2 + n3 + n4, 4)
        .otherwise(5)
    )
    part = F.col("_part")
    decided = small_side(
        counts.withColumn("_part", case).select(
            *keys,
            "_name",
            F.when(part == 1, n1).when(part == 3, n3).otherwise(F.col("_size") - n1 - n2 - n3 - n4).alias("_size"),
            F.when(part == 1, rank).when(part == 3, rank - n1 - n2).otherwise(rank - n1 - n2 - n3 - n4).alias("_rank"),
            F.when(part == 1, F.col("_above")).when(part == 3, lo).otherwise(hi).alias("_above"),
            F.when(part == 1, lo).when(part == 3, hi).otherwise(F.col("_below")).alias("_below"),
            F.when(part == 2, lo).when(part == 4, hi).alias("_answer"),
        )
    )
    settled = state.filter(F.col("_answer").isNotNull())
    return small_side(settled.unionByName(decided))
