"""Row predicates behind the deterministic checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(column: Column) -> Column:
    """NULL, empty, or nothing but Unicode space separators (tabs and newlines are content).

    The search ends at the first character that is not a space, so long texts cost no more
    than short ones.
    """
    return column.isNull() | ~column.rlike(r"[^\p{Zs}]")


def is_not_allowed(column: Column, valid: Sequence, null_is_invalid: bool = False) -> Column:
    """Value outside ``valid``. NULL passes unless ``null_is_invalid``."""
    if not valid:
        raise ValueError("the list of allowed values is empty")
    return F.coalesce(~column.isin(*valid), F.lit(null_is_invalid))


def is_older_than(column: Column, as_of: Column, days: int) -> Column:
    """Strictly before ``as_of - days``. NULL passes."""
    return F.coalesce(column < F.date_sub(as_of, days), F.lit(False))


def check_status(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("PASS")).otherwise(F.concat(failures.cast("string"), F.lit(" FAIL")))


def sample_hash(key: Column) -> Column:
    """A stable number in [0, 2^32) per key, equal on every engine that has MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")


def row_key(row_id: Column, version: Column) -> Column:
    """``row_id@version`` as one text, for output; operators keep the two columns."""
    return F.concat(row_id, F.lit("@"), version)
