"""Versions of a table: making one from another, stacking them, and telling them apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.plans import small_side
from qualitygate.spec import ROW_ID, VERSION, DatasetSpec


def fork_version(df: DataFrame, version: str, mutations: Mapping[str, Column] | None = None) -> DataFrame:
    """The same rows under another version name, with some columns replaced."""
    changed = df.withColumns(dict(mutations)) if mutations else df
    return changed.withColumn(VERSION, F.lit(version))


def stack_versions(*versions: DataFrame) -> DataFrame:
    """All rows of all versions, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), versions)


def _digest(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits that tell the texts of a row's columns, NULLs included, in two whole numbers."""
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c).cast("string"))]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def _ids_that_differ(df: DataFrame, columns: Sequence[str], before: str, after: str) -> DataFrame:
    """Row ids of both versions whose rows are not all equal. Digests are hashed and moved, texts are not."""
    one, other = _digest(columns)
    sides = {"a": F.col(VERSION) == before, "b": F.col(VERSION) == after}
    digests = df.select(ROW_ID, VERSION, one.alias("_one"), other.alias("_other"))
    most = [end(F.when(side, F.col(c))).alias(f"{name}{c}{i}") for name, side in sides.items() for c in ("_one", "_other") for i, end in enumerate((F.min, F.max))]
    found = digests.groupBy(ROW_ID).agg(*most).filter(F.col("a_one0").isNotNull() & F.col("b_one0").isNotNull())
    same = [F.col(x) == F.col(f"a{c}0") for c in ("_one", "_other") for x in (f"a{c}1", f"b{c}0", f"b{c}1")]
    return found.filter(~reduce(lambda x, y: x & y, same)).select(F.col(ROW_ID).alias("_r"))


def drift_manifest(
    df: DataFrame, spec: DatasetSpec, before: str = "v1", after: str = "v2", tie_break: Sequence[str] = ()
) -> DataFrame:
    """One record per content column that differs between two versions of a row.

    ``item`` is the row's first content column in the older version. Rows missing from either
    version are skipped, NULL equals NULL, and of rows with the same id the last by ``tie_break``,
    then by the content columns, stands for all.

    The first scan compares digests of 128 bits in a hash aggregation by row id; the second fetches the texts of
    those ids only that changed or have different copies. One row per id and version is picked
    before the shuffle too, so a hot id weighs nothing.
    """
    order = list(dict.fromkeys([*tie_break, *spec.text_columns]))
    rows = df.filter(F.col(VERSION).isin(before, after))
    differ = small_side(_ids_that_differ(rows, spec.text_columns, before, after))
    rows = rows.join(differ, F.col(ROW_ID).eqNullSafe(F.col("_r")), "left_semi").select(ROW_ID, VERSION, *order)
    # the last in an order with NULLs last is the first in the order turned round
    last = Window.partitionBy(ROW_ID, VERSION).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    picked = rows.withColumn("_place", F.row_number().over(last)).filter(F.col("_place") == 1)
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in spec.text_columns])
    older = F.lag(texts).over(Window.partitionBy(ROW_ID).orderBy(F.col(VERSION) == after))
    both = picked.select(ROW_ID, VERSION, texts.alias("_b"), older.alias("_a")).filter((F.col(VERSION) == after) & F.col("_a").isNotNull())
    records = F.array(
        *[
            F.struct(
                F.col("_a").getField(spec.text_columns[0]).alias("item"),
                F.lit(c).alias("column"),
                F.col("_a").getField(c).alias("v1"),
                F.col("_b").getField(c).alias("v2"),
                F.lit(i).alias("_position"),
            )
            for i, c in enumerate(spec.text_columns)
        ]
    )
    return both.select(ROW_ID, F.inline(records)).filter(~F.col("v1").eqNullSafe(F.col("v2")))


def manifest_in_order(manifest: DataFrame) -> DataFrame:
    """By row id, then by position of the column in the table; for export."""
    return manifest.orderBy(F.col(ROW_ID).asc_nulls_last(), "_position").drop("_position")
