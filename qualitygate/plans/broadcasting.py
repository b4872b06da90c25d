"""Broadcasting behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitygate.plans.scratch import pin

BROADCAST_ROWS = 100_000


def fits(written: DataFrame, max_rows: int | None = None) -> bool:
    """Whether an already written table has at most ``max_rows`` (``BROADCAST_ROWS``) rows."""
    return written.count() <= (BROADCAST_ROWS if max_rows is None else max_rows)


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The written form of ``df``, marked for broadcast only if it was counted to be small.

    Meant for narrow tables of one row per version or per range bucket. A larger one joins
    by shuffle, where adaptive execution splits skewed partitions.
    """
    written = pin(df)
    return F.broadcast(written) if fits(written, max_rows) else written
