"""The test tables seen as versioned data tables, in Spark and in SQL.

Every binding yields ``row_id``, ``deployment_version``, content columns and ``created_at``.
The SQL of a binding is a common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitygate.operators.evaluators import ExpressionEvaluator
from qualitygate.spec import CHOICE, NOUL, SCORE, DatasetSpec, Question

AS_OF = "2024-02-10"
LINEITEM_AS_OF = "2001-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keys(row_id: str, version) -> list:
    version = F.col(version) if isinstance(version, str) else version
    return [F.col(row_id).cast("string").alias("row_id"), version.cast("string").alias("deployment_version")]


# --- events: two versions, split by date -------------------------------------

EVENTS = DatasetSpec(
    name="events",
    table="events",
    text_columns=("event_type", "props", "value", "user_id"),
    enum_column="event_type",
    valid_values=("click", "view", "purchase", "signup"),
    completeness_column="props",
    questions=(
        Question("value_high", NOUL, label="value"),
        Question("is_traffic", NOUL, label="traffic"),
        Question("user_rank", SCORE, label="rank(1-5)"),
    ),
    quality_weights={"value_high": 0.5, "is_traffic": 0.2, "user_rank": 0.3},
    review_reason="low value",
)


def as_events(raw: DataFrame, *more: str) -> DataFrame:
    version = F.when(F.dayofmonth("ts") <= 15, "v1").otherwise("v2")
    return raw.select(
        *keys("event_id", version), "event_type", "props", "value", "user_id", F.col("ts").cast("date").alias("created_at"), *more
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return as_events(table(spark, folder, "events"))


EVENTS_SQL = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS row_id,
         CASE WHEN day(ts) <= 15 THEN 'v1' ELSE 'v2' END AS deployment_version,
         event_type, props, value, user_id, CAST(ts AS DATE) AS created_at
  FROM events
)"""


def events_evaluator() -> ExpressionEvaluator:
    return ExpressionEvaluator(
        values={
            "value_high": F.least(F.col("value") / 100.0, F.lit(1.0)),
            "is_traffic": F.col("event_type").isin("click", "view").cast("double"),
            "user_rank": (1 + F.col("user_id") % 5).cast("double"),
        },
        tokens=F.length("props") + F.col("user_id"),
        latency_ms=F.col("value"),
    )


EVENTS_SCORED_SQL = (
    EVENTS_SQL
    + """,
ev_units AS (
  SELECT *, least(value / 100.0::DOUBLE, 1.0::DOUBLE) AS u1,
         CASE WHEN event_type IN ('click', 'view') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS u2,
         greatest(0.0::DOUBLE, least(1.0::DOUBLE, (1 + user_id % 5 - 1)::DOUBLE / 4.0::DOUBLE)) AS u3,
         (length(props) + user_id)::DOUBLE / 1000000.0::DOUBLE * 0.042::DOUBLE AS cost_usd
  FROM ev
),
ev_scored AS (
  SELECT *, (0.5::DOUBLE * u1 + 0.2::DOUBLE * u2 + 0.3::DOUBLE * u3)
            / (0.5::DOUBLE + 0.2::DOUBLE + 0.3::DOUBLE) AS quality, value AS latency_ms
  FROM ev_units
)"""
)


# --- documents: one version per source, whole texts, all answer types ---------

DOCUMENTS = DatasetSpec(
    name="documents",
    table="documents",
    text_columns=("lang", "text", "n_chars"),
    enum_column="lang",
    valid_values=("en", "de", "fr"),
    completeness_column="text",
    questions=(
        Question("long_enough", NOUL, label="length"),
        Question("language", CHOICE, label="language", criteria={"en": "English", "de": "German", "fr": "French", "es": "Spanish"}),
        Question("richness", SCORE, label="words(1-5)"),
    ),
    quality_weights={"long_enough": 0.5, "language": 0.2, "richness": 0.3},
    review_reason="short or plain text",
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        *keys("doc_id", "source"), "lang", "text", "n_chars", F.lit(None).cast("date").alias("created_at")
    )


def documents_evaluator() -> ExpressionEvaluator:
    words = F.size(F.split("text", " "))
    return ExpressionEvaluator(
        values={
            "long_enough": F.least(F.length("text") / 2000.0, F.lit(1.0)),
            "language": F.col("lang"),
            "richness": 1.0 + F.least(words / 100.0, F.lit(4.0)),
        },
        confidence={"language": F.when(F.col("lang") == "en", 0.9).otherwise(0.6)},
        tokens=F.length("text") / 4.0,
        latency_ms=F.length("text") / 10.0,
    )


DOCUMENTS_SQL = """
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS row_id, source AS deployment_version, lang, text, n_chars
  FROM documents
)"""

DOCUMENTS_SCORED_SQL = (
    DOCUMENTS_SQL
    + """,
docs_units AS (
  SELECT *, least(length(text)::DOUBLE / 2000.0::DOUBLE, 1.0::DOUBLE) AS u1,
         CASE WHEN lang = 'en' THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS u2,
         1.0::DOUBLE + least(len(string_split(text, ' '))::DOUBLE / 100.0::DOUBLE, 4.0::DOUBLE) AS s3,
         length(text)::DOUBLE / 10.0::DOUBLE AS latency_ms,
         length(text)::DOUBLE / 4.0::DOUBLE / 1000000.0::DOUBLE * 0.042::DOUBLE AS cost_usd
  FROM docs
),
docs_scored AS (
  SELECT *, (0.5::DOUBLE * u1 + 0.2::DOUBLE * u2
             + 0.3::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, (s3 - 1.0::DOUBLE) / 4.0::DOUBLE)))
            / (0.5::DOUBLE + 0.2::DOUBLE + 0.3::DOUBLE) AS quality
  FROM docs_units
)"""
)


def document_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Human labels; the version of a labeled document comes from the documents table."""
    named = table(spark, folder, "documents").select("doc_id", "source")
    labeled = table(spark, folder, "labels").join(named, "doc_id")
    return labeled.select(*keys("doc_id", "source"), (F.col("quality") == 1).alias("is_good"))


LABELS_SQL = """
human AS (SELECT CAST(doc_id AS VARCHAR) AS row_id, max(quality = 1) AS is_good FROM labels GROUP BY doc_id)"""


# --- conversations: keys repeat, one version per role --------------------------

TURNS = DatasetSpec(
    name="turns",
    table="conversations",
    text_columns=("turn", "text"),
    enum_column="deployment_version",
    valid_values=("user", "assistant"),
    completeness_column="text",
    questions=(Question("says_much", NOUL),),
    quality_weights={"says_much": 1.0},
    review_reason="says little",
)


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        *keys("conv_id", "role"), "turn", "text", F.lit(None).cast("date").alias("created_at")
    )


def turns_evaluator() -> ExpressionEvaluator:
    return ExpressionEvaluator(values={"says_much": F.least(F.length("text") / 400.0, F.lit(1.0))})


TURNS_SQL = """
turns AS (SELECT CAST(conv_id AS VARCHAR) AS row_id, role AS deployment_version, turn, text FROM conversations)"""


# --- lineitem: ids repeat, one version per return flag -------------------------

LINEITEM = DatasetSpec(
    name="lineitem",
    table="lineitem",
    text_columns=("l_linestatus", "l_quantity"),
    enum_column="l_linestatus",
    valid_values=("F",),
    completeness_column="l_linestatus",
)


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *keys("l_orderkey", "l_returnflag"), "l_linestatus", "l_quantity", F.col("l_shipdate").cast("date").alias("created_at")
    )


LINEITEM_SQL = """
li AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS row_id, l_returnflag AS deployment_version,
         l_linestatus, l_quantity, CAST(l_shipdate AS DATE) AS created_at
  FROM lineitem
)"""


# --- orders: one version per year, and a fork of the whole table ---------------

ORDERS = DatasetSpec(
    name="orders",
    table="orders",
    text_columns=("o_orderpriority", "o_orderstatus", "o_totalprice"),
    enum_column="o_orderstatus",
    valid_values=("F", "O"),
    completeness_column="o_orderpriority",
)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        *keys("o_orderkey", F.year("o_orderdate")),
        "o_orderpriority",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("created_at"),
    )


ORDERS_SQL = """
ord AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS row_id, CAST(year(o_orderdate) AS VARCHAR) AS deployment_version,
         o_orderpriority, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS created_at
  FROM orders
)"""

FORK_SQL = (
    ORDERS_SQL
    + """,
forked AS (
  SELECT row_id, 'v1' AS deployment_version, o_orderpriority, o_orderstatus, o_totalprice, created_at FROM ord
  UNION ALL
  SELECT row_id, 'v2', CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'O' ELSE o_orderstatus END, o_totalprice, created_at
  FROM ord
)"""
)
