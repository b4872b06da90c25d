"""Exact dedup by a content sort, in DataFrame operations only.

Normalised texts are range-partitioned by sampled splitters and sorted externally, so that
equal texts lie next to each other; the sorted aggregation compares neighbours in full and
keeps the best row of each run of equals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitygate.llm.common import WHITE, numbered, spool, text_of

#: A text with more than 1 / HOT_SHARE of all rows is dealt out under several salts;
#: so at most HOT_SHARE texts are hot, whatever the size of the input.
HOT_SHARE = 2000
#: Characters of a text that splitters are made of.
FRONT = 24


def _numbered_texts(docs: DataFrame, text: str, key: str, carry: bool) -> DataFrame:
    whole = text_of(text)
    normal = F.regexp_replace(whole, WHITE, "")
    rows = numbered(docs, F.col(key).alias("doc_id"), F.length(whole).cast("long").alias("points"), normal.alias("normal"), carry=carry)
    return spool(rows.withColumns({"code": F.xxhash64("normal"), "digest": F.sha2("normal", 256)}), "exact")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per distinct normalised text: digest, the row that stays, the number of rows."""
    limit = rows.count() // HOT_SHARE + 100
    hot = rows.groupBy("code").count().where(F.col("count") > limit)
    hot = hot.select("code", F.ceil(F.col("count") / limit).cast("long").alias("salts"))  # at most HOT_SHARE rows
    salt = F.coalesce(F.pmod(F.col("row"), F.col("salts")), F.lit(0))
    dealt = rows.select("normal", "code", "digest", "points", "doc_id", "row").join(F.broadcast(hot), "code", "left").withColumn("salt", salt)
    place = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row").alias("place")
    # Splitters are sampled on the start of the text and its code, so that no whole texts go to the driver.
    ordered = dealt.select(F.substring("normal", 1, FRONT).alias("front"), "code", "salt", "normal", "digest", place).repartitionByRange("front", "code", "salt")
    # The range partitioning already keeps equal texts of a salt together: sort and compare in place, no second exchange.
    runs = ordered.groupBy("front", "code", "salt", "normal").agg(F.min("place").alias("best"), F.count(F.lit(1)).alias("n"), F.first("digest").alias("digest"))
    return spool(runs.groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("group_size")), "exact")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For each row, which row of those with an equal text stays.

    Texts are equal when identical without ASCII white space; null counts as empty. Of equal
    texts the one with most code points in the original stays, then the smallest id (a null id
    comes last), and of rows alike in both exactly one. An empty table gives no rows. Other
    columns are not looked at. Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = _numbered_texts(docs, text, key, carry=False)
    joined = rows.select("row", "doc_id", "digest").join(_groups(rows), "digest")
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    rows = _numbered_texts(docs, text, key, carry=True)
    stay = _groups(rows).select(F.col("best.row").alias("row"))
    return rows.select("row", "kept_row").join(stay, "row", "left_semi").select("kept_row.*")
