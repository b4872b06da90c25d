"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitygate.plans.scratch import new_folder

#: ASCII white space, as the contracts of the operators define it (Java and RE2 syntax).
WHITE = r"[\x20\x09-\x0D]+"


def spool(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files: cut lineage, same rows for all readers."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def numbered(docs: DataFrame, *columns: Column, carry: bool = False) -> DataFrame:
    """``row``, a number of each input row, with ``columns``; once written it names the row for good.

    With ``carry`` the whole input row comes along as the struct ``kept_row``, so that
    no column of the input can clash with a column of an operator.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept_row")] if carry else []
    return docs.select(F.monotonically_increasing_id().alias("row"), *columns, *whole)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
