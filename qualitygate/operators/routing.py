"""Which rows go to semantic evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitygate.functions import sample_hash
from qualitygate.operators.checks import passing_rows
from qualitygate.plans import first_by
from qualitygate.spec import ROW_ID, VERSION, DatasetSpec


def clamp_rate(rate: float) -> float:
    return max(0.0, min(1.0, rate))


def routed_columns(df: DataFrame, spec: DatasetSpec, version: str | None = None) -> DataFrame:
    """Keys and content columns, of one version or of all."""
    if version is not None:
        df = df.filter(F.col(VERSION) == version)
    return df.select(*spec.routed_columns)


def route_prefix(
    df: DataFrame,
    spec: DatasetSpec,
    rate: float = 1.0,
    version: str | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The first ``max(1, int(n * rate))`` rows of every version by row id; all rows at rate 1.

    Rows with equal ids are told apart by ``tie_break``, then by the content columns in order.
    """
    rate = clamp_rate(rate)
    rows = routed_columns(df, spec, version)
    if rate >= 1.0:
        return rows
    ties = [c for c in dict.fromkeys((*tie_break, *spec.text_columns)) if c != ROW_ID]

    def keep(n: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(n * F.lit(rate)))

    return first_by(rows, [VERSION], ROW_ID, ties, keep)


def route_hash_sample(
    df: DataFrame, spec: DatasetSpec, rate: float, version: str | None = None, key: str = ROW_ID
) -> DataFrame:
    """About ``rate`` of the rows, chosen by a hash of the key: no sort, no shuffle, fit for streams.

    An id is chosen or not in all versions alike, so samples of two versions can be compared.
    Rows without an id are hashed as the empty one.
    """
    rows = routed_columns(df, spec, version)
    rate = clamp_rate(rate)
    return rows if rate >= 1.0 else rows.filter(sample_hash(F.coalesce(F.col(key).cast("string"), F.lit(""))) < F.lit(rate * 4294967296.0))


def route_passing(
    df: DataFrame, spec: DatasetSpec, as_of: Column | None = None, max_age_days: int = 30, version: str | None = None
) -> DataFrame:
    """Only rows that fail no row-level check."""
    return routed_columns(passing_rows(df, spec, as_of, max_age_days), spec, version)


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Total order for display or export, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
