"""All registered queries. ``@query(sql)`` files a function under its name with its SQL."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import qualitygate as qg
from catalog import tables as t
from qualitygate.functions import answer_problem, answer_unit, item_of, quality_band, row_key
from qualitygate.plans import new_folder, pin, small_side
from qualitygate.sources import conform, read_csv, read_json, write_csv, write_json, write_json_array
from qualitygate.sources.exports import export_dataset
from qualitygate.spec import MANIFEST, Options

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def file(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return file


def day(text: str):
    return F.lit(text).cast("date")


def events_scored(spark, folder) -> DataFrame:
    return qg.score(t.events(spark, folder), t.EVENTS, t.events_evaluator(), unique=True)


def documents_scored(spark, folder) -> DataFrame:
    return qg.score(t.documents(spark, folder), t.DOCUMENTS, t.documents_evaluator(), unique=True)


def fork(spark, folder) -> DataFrame:
    v1 = t.orders(spark, folder).withColumn("deployment_version", F.lit("v1"))
    v2 = qg.fork_version(
        v1,
        "v2",
        {
            "o_orderpriority": F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority")),
            "o_orderstatus": F.when(F.col("o_orderpriority") == "1-URGENT", "O").otherwise(F.col("o_orderstatus")),
        },
    )
    return qg.stack_versions(v1, v2)


# --- deterministic checks ------------------------------------------------------


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT deployment_version, count(*) AS total_rows,
       count(*) FILTER (props IS NULL OR length(trim(props)) = 0) AS completeness,
       count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS "schema",
       count(*) - count(DISTINCT row_id) AS uniqueness,
       count(*) FILTER (created_at < DATE '{t.AS_OF}' - INTERVAL 30 DAY) AS freshness,
       count(*) FILTER (props IS NULL OR length(trim(props)) = 0
                        OR event_type NOT IN ('click', 'view', 'purchase', 'signup')
                        OR created_at < DATE '{t.AS_OF}' - INTERVAL 30 DAY) = 0
         AND count(*) = count(DISTINCT row_id) AS all_passed
FROM ev GROUP BY deployment_version"""
)
def deterministic_report(spark, folder):
    return qg.check_report(t.events(spark, folder), t.EVENTS, day(t.AS_OF))


@query(
    f"""WITH {t.LINEITEM_SQL},
per_id AS (SELECT deployment_version, row_id, count(*) AS c FROM li GROUP BY ALL)
SELECT r.deployment_version, r.total_rows, r.completeness, r."schema", u.uniqueness, r.freshness,
       r.completeness + r."schema" + u.uniqueness + r.freshness = 0 AS all_passed
FROM (SELECT deployment_version, count(*) AS total_rows,
             count(*) FILTER (l_linestatus IS NULL OR length(trim(l_linestatus)) = 0) AS completeness,
             count(*) FILTER (l_linestatus NOT IN ('F')) AS "schema",
             count(*) FILTER (created_at < DATE '{t.LINEITEM_AS_OF}' - INTERVAL 30 DAY) AS freshness
      FROM li GROUP BY deployment_version) r
JOIN (SELECT deployment_version, count(*) FILTER (c > 1) AS uniqueness FROM per_id GROUP BY deployment_version) u
  USING (deployment_version)"""
)
def deterministic_report_repeated_ids(spark, folder):
    return qg.check_report(t.lineitem(spark, folder), t.LINEITEM, day(t.LINEITEM_AS_OF))


@query(
    f"""WITH {t.EVENTS_SQL}, asked(deployment_version) AS (VALUES ('v2'), ('v9'))
SELECT a.deployment_version, count(e.row_id) AS total_rows,
       count(*) FILTER (e.event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS "schema",
       count(*) FILTER (e.event_type NOT IN ('click', 'view', 'purchase', 'signup')
                        OR e.created_at < DATE '{t.AS_OF}' - INTERVAL 30 DAY) = 0 AS all_passed
FROM asked a LEFT JOIN ev e USING (deployment_version) GROUP BY a.deployment_version"""
)
def deterministic_report_absent_version(spark, folder):
    report = qg.check_report(t.events(spark, folder), t.EVENTS, day(t.AS_OF), versions=["v2", "v9"])
    return report.select("deployment_version", "total_rows", "schema", "all_passed")


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT deployment_version, count(*) AS total_rows,
       count(*) FILTER (text IS NULL OR length(trim(text)) = 0) AS completeness
FROM docs GROUP BY deployment_version"""
)
def check_completeness(spark, folder):
    report = qg.check_report(t.documents(spark, folder), t.DOCUMENTS)
    return report.select("deployment_version", "total_rows", "completeness")


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT deployment_version, count(*) FILTER (lang NOT IN ('en', 'de', 'fr')) AS "schema"
FROM docs GROUP BY deployment_version"""
)
def check_enum(spark, folder):
    return qg.check_report(t.documents(spark, folder), t.DOCUMENTS).select("deployment_version", "schema")


@query(
    f"""WITH {t.LINEITEM_SQL}
SELECT deployment_version, row_id, count(*) AS n_rows FROM li GROUP BY ALL HAVING count(*) > 1"""
)
def check_uniqueness(spark, folder):
    return qg.duplicated_ids(t.lineitem(spark, folder)).select("deployment_version", "row_id", "n_rows")


@query(
    f"""WITH {t.ORDERS_SQL}
SELECT deployment_version, count(*) FILTER (created_at < DATE '2000-01-01' - INTERVAL 400 DAY) AS freshness
FROM ord GROUP BY deployment_version"""
)
def check_freshness(spark, folder):
    report = qg.check_report(t.orders(spark, folder), t.ORDERS, day("2000-01-01"), max_age_days=400)
    return report.select("deployment_version", "freshness")


_LONG_REPORT = f"""WITH {t.ORDERS_SQL},
report AS (
  SELECT deployment_version,
         count(*) FILTER (o_orderpriority IS NULL OR length(trim(o_orderpriority)) = 0) AS completeness,
         count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS "schema",
         count(*) - count(DISTINCT row_id) AS uniqueness,
         count(*) FILTER (created_at < DATE '2000-01-01' - INTERVAL 30 DAY) AS freshness
  FROM ord GROUP BY deployment_version
),
counts AS (
  UNPIVOT report ON completeness, "schema", uniqueness, freshness INTO NAME check_name VALUE failures
)
"""


@query(_LONG_REPORT + "SELECT deployment_version, check_name, failures FROM counts WHERE failures > 0")
def check_failures_only(spark, folder):
    return qg.failing_versions(qg.check_report(t.orders(spark, folder), t.ORDERS, day("2000-01-01")))


@query(
    _LONG_REPORT
    + """SELECT deployment_version, check_name,
       CASE WHEN failures = 0 THEN 'PASS' ELSE failures || ' FAIL' END AS status FROM counts"""
)
def check_status(spark, folder):
    return qg.check_statuses(qg.check_report(t.orders(spark, folder), t.ORDERS, day("2000-01-01")))


# --- routing -------------------------------------------------------------------


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT row_id, deployment_version, event_type, props, value, user_id FROM ev WHERE deployment_version = 'v2'"""
)
def route_all(spark, folder):
    return qg.route_prefix(t.events(spark, folder), t.EVENTS, 1.0, "v2")


@query(
    f"""WITH {t.EVENTS_SQL},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY row_id) AS rn, count(*) OVER () AS n FROM ev WHERE deployment_version = 'v2'
)
SELECT row_id, deployment_version, event_type, props, value, user_id FROM ranked
WHERE rn <= greatest(1, floor(n * 0.29::DOUBLE))"""
)
def route_prefix(spark, folder):
    return qg.route_prefix(t.events(spark, folder), t.EVENTS, 0.29, "v2")


@query(
    f"""WITH {t.LINEITEM_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY deployment_version ORDER BY row_id, l_linestatus, l_quantity) AS rn,
         count(*) OVER (PARTITION BY deployment_version) AS n
  FROM li
)
SELECT row_id, deployment_version, l_linestatus, l_quantity FROM ranked
WHERE rn <= greatest(1, floor(n * 0.25::DOUBLE))"""
)
def route_prefix_all_versions(spark, folder):
    return qg.route_prefix(t.lineitem(spark, folder), t.LINEITEM, 0.25)


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT row_id, deployment_version, event_type, props, value, user_id FROM ev
WHERE ('0x' || substr(md5(row_id), 1, 8))::BIGINT < 0.25 * 4294967296"""
)
def route_hash_sample(spark, folder):
    return qg.route_hash_sample(t.events(spark, folder), t.EVENTS, 0.25)


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT row_id, deployment_version, event_type, props, value, user_id FROM ev
WHERE NOT (props IS NULL OR length(trim(props)) = 0) AND event_type IN ('click', 'view', 'purchase', 'signup')
  AND created_at >= DATE '{t.AS_OF}' - INTERVAL 30 DAY"""
)
def route_only_passing(spark, folder):
    return qg.route_passing(t.events(spark, folder), t.EVENTS, day(t.AS_OF))


# --- answers and row quality ---------------------------------------------------


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL}
SELECT row_id, round(u1, 9) AS long_enough, round(u2, 9) AS language,
       round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (s3 - 1.0::DOUBLE) / 4.0::DOUBLE)), 9) AS richness
FROM docs_scored"""
)
def answer_units(spark, folder):
    answered = t.documents_evaluator().answers(t.documents(spark, folder), t.DOCUMENTS)
    units = [F.round(answer_unit(item_of(q.key)), 9).alias(q.key) for q in t.DOCUMENTS.questions]
    return answered.select("row_id", *units)


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL}
SELECT row_id, deployment_version, round(quality, 9) AS quality, round(cost_usd, 12) AS cost_usd,
       round(latency_ms, 6) AS latency_ms, 'expression' AS backend
FROM docs_scored"""
)
def row_quality(spark, folder):
    return documents_scored(spark, folder).select(
        "row_id",
        "deployment_version",
        F.round("quality", 9).alias("quality"),
        F.round("cost_usd", 12).alias("cost_usd"),
        F.round("latency_ms", 6).alias("latency_ms"),
        "backend",
    )


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, round((0.5::DOUBLE * u1 + 0.3::DOUBLE * u3) / (0.5::DOUBLE + 0.3::DOUBLE), 9) AS quality FROM ev_scored"""
)
def row_quality_missing_keys(spark, folder):
    full = t.events_evaluator()
    partial = qg.ExpressionEvaluator({k: v for k, v in full.values.items() if k != "is_traffic"})
    evals = qg.score(t.events(spark, folder), t.EVENTS, partial, unique=True)
    return evals.select("row_id", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT row_id, CASE WHEN value / 100.0 > 1.0 THEN 'value_high: noul' END AS problem FROM ev"""
)
def answer_validation(spark, folder):
    bare = qg.ExpressionEvaluator({"value_high": F.col("value") / 100.0})
    answered = bare.answers(t.events(spark, folder), t.EVENTS)
    complaint = answer_problem(item_of("value_high"))
    named = F.concat(F.lit("value_high: "), F.substring_index(complaint, " ", 1))
    return answered.select("row_id", named.alias("problem"))


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT deployment_version, count(*) FILTER (value <= 100) AS accepted, count(*) FILTER (value > 100) AS quarantined
FROM ev GROUP BY deployment_version"""
)
def score_quarantine(spark, folder):
    bare = qg.ExpressionEvaluator({"value_high": F.col("value") / 100.0})
    rows = qg.score_with_errors(t.events(spark, folder), t.EVENTS, bare, unique=True)
    return rows.groupBy("deployment_version").agg(
        F.count_if(F.col("error").isNull()).alias("accepted"), F.count_if(F.col("error").isNotNull()).alias("quarantined")
    )


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT deployment_version, round(sum(cost_usd), 9) AS total_cost, round(sum(cost_usd) / count(*), 12) AS cost_per_row
FROM ev_scored GROUP BY deployment_version"""
)
def token_cost(spark, folder):
    cost = F.sum("cost_usd")
    return (
        events_scored(spark, folder)
        .groupBy("deployment_version")
        .agg(F.round(cost, 9).alias("total_cost"), F.round(cost / F.count("*"), 12).alias("cost_per_row"))
    )


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT deployment_version, CASE WHEN quality >= 0.7::DOUBLE THEN 'green' WHEN quality >= 0.5::DOUBLE THEN 'yellow'
       ELSE 'red' END AS band, count(*) AS n_rows
FROM ev_scored GROUP BY ALL"""
)
def quality_bands(spark, folder):
    band = quality_band(F.col("quality")).alias("band")
    return events_scored(spark, folder).groupBy("deployment_version", band).agg(F.count("*").alias("n_rows"))


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL}
SELECT deployment_version, row_id, round(u1, 9) AS length, lang AS language, round(s3, 9) AS "words(1-5)",
       round(quality, 9) AS quality,
       CASE WHEN quality >= 0.7::DOUBLE THEN 'green' WHEN quality >= 0.5::DOUBLE THEN 'yellow' ELSE 'red' END AS band
FROM docs_scored"""
)
def answers_wide(spark, folder):
    wide = qg.answers_wide(documents_scored(spark, folder), t.DOCUMENTS)
    rounded = {c: F.round(F.col(f"`{c}`"), 9) for c in ("length", "words(1-5)", "quality")}
    return wide.withColumns(rounded)


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL}
SELECT row_id, printf('%.2f', u1) AS length, lang AS language, printf('%.1f', s3) AS "words(1-5)" FROM docs_scored"""
)
def answer_display(spark, folder):
    wide = qg.answers_wide(documents_scored(spark, folder), t.DOCUMENTS, as_text=True)
    return wide.select("row_id", "length", "language", "`words(1-5)`")


# --- scoring -------------------------------------------------------------------

_FIRST_TURN = f"""WITH {t.TURNS_SQL},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY row_id, deployment_version ORDER BY turn, text) AS rn,
         count(*) OVER (PARTITION BY row_id, deployment_version) AS copies
  FROM turns
)
"""


@query(
    _FIRST_TURN
    + "SELECT row_id, deployment_version, turn, text, copies FROM firsts WHERE rn = 1"
)
def score_dedup(spark, folder):
    rows = t.turns(spark, folder).drop("created_at")
    return qg.first_per_key(rows, ["turn"]).withColumnRenamed("_copies", "copies")


@query(
    _FIRST_TURN
    + """SELECT a.row_id, a.deployment_version, round(least(length(f.text)::DOUBLE / 400.0::DOUBLE, 1.0::DOUBLE), 9) AS quality
FROM turns a JOIN firsts f ON a.row_id = f.row_id AND a.deployment_version = f.deployment_version AND f.rn = 1"""
)
def score_every_input_row(spark, folder):
    rows = t.turns(spark, folder).drop("created_at")
    evals = qg.score(rows, t.TURNS, t.turns_evaluator(), tie_break=["turn"])
    return evals.select("row_id", "deployment_version", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.TURNS_SQL}
SELECT count(*) AS n_rows, count(DISTINCT (row_id, deployment_version)) AS distinct_keys FROM turns"""
)
def distinct_keys(spark, folder):
    evals = qg.score(t.turns(spark, folder).drop("created_at"), t.TURNS, t.turns_evaluator(), tie_break=["turn"])
    keys = qg.distinct_keys(evals)
    return keys.select(evals.agg(F.count("*").alias("n")).scalar().alias("n_rows"), "distinct_keys")


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, deployment_version, round(quality, 9) AS quality FROM ev_scored
WHERE NOT (deployment_version = 'v1' AND event_type IN ('click', 'view'))"""
)
def score_unscored_only(spark, folder):
    rows = t.events(spark, folder)
    already = rows.filter((F.col("deployment_version") == "v1") & F.col("event_type").isin("click", "view"))
    evals = qg.score(rows, t.EVENTS, t.events_evaluator(), scored=already, unique=True)
    return evals.select("row_id", "deployment_version", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT row_id, deployment_version, 'pandas' AS backend,
       round((0.5::DOUBLE * least(length(text) / 2000.0::DOUBLE, 1.0::DOUBLE)
              + 0.2::DOUBLE * CASE WHEN lang = 'en' THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END
              + 0.3::DOUBLE * (least(length(text) - length(replace(text, ' ', '')), 400) / 100.0::DOUBLE) / 4.0::DOUBLE)
             / (0.5::DOUBLE + 0.2::DOUBLE + 0.3::DOUBLE), 9) AS quality,
       round(length(text) / 1000000.0::DOUBLE * 0.042::DOUBLE, 12) AS cost_usd
FROM docs"""
)
def score_batch_pandas(spark, folder):
    def scorer(state, questions):
        text = state["text"]
        return state.assign(
            long_enough=(text.str.len() / 2000.0).clip(upper=1.0),
            language=state["lang"],
            richness=(text.str.count(" ") / 100.0).clip(upper=4.0),
            tokens=text.str.len(),
            **{"language.confidence": state["lang"].eq("en").map({True: 0.9, False: 0.6})},
        )

    batches = qg.BatchEvaluator(scorer, name="pandas", options=Options(batch_size=256), throttle=False)
    rows = t.documents(spark, folder).drop("created_at")
    return qg.score(rows, t.DOCUMENTS, batches, unique=True).select(
        "row_id",
        "deployment_version",
        "backend",
        F.round("quality", 9).alias("quality"),
        F.round("cost_usd", 12).alias("cost_usd"),
    )


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT row_id, deployment_version,
       CASE WHEN lang = 'fr' THEN 'long_enough: noul is not in [0, 1]' WHEN lang = 'es' THEN 'richness: no score' END AS error
FROM docs"""
)
def score_batch_quarantine(spark, folder):
    """A scorer that gives unusable answers for some rows; their neighbours in the batch keep theirs."""
    def scorer(state, questions):
        lang = state["lang"]
        return state.assign(
            long_enough=lang.eq("fr") * 1.5,
            language=lang,
            richness=state["n_chars"].astype(object).where(lang.ne("es"), None),
        )

    options = Options(batch_size=256, max_retries=2, first_backoff_s=0.0)
    batches = qg.BatchEvaluator(scorer, options=options, on_error="quarantine", throttle=False)
    rows = t.documents(spark, folder).drop("created_at")
    return qg.score_with_errors(rows, t.DOCUMENTS, batches, unique=True).select("row_id", "deployment_version", "error")


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, deployment_version, round(quality, 9) AS quality FROM ev_scored"""
)
def score_json_rows(spark, folder):
    rows = t.events(spark, folder).select(*t.EVENTS.routed_columns)
    bodies = rows.select(F.to_json(F.struct(F.array(F.struct(*rows.columns)).alias("rows"))).alias("body"))
    parsed = qg.rows_from_json(bodies, t.EVENTS).withColumns(
        {"value": F.col("value").cast("double"), "user_id": F.col("user_id").cast("bigint")}
    )
    out = qg.evaluations_to_json(qg.score(parsed, t.EVENTS, t.events_evaluator(), unique=True))
    fields = F.from_json("evaluation", "row_id string, deployment_version string, quality double").alias("e")
    return out.select(fields).select("e.row_id", "e.deployment_version", F.round("e.quality", 9).alias("quality"))


# --- gate ----------------------------------------------------------------------

GATE = Options(drift_threshold=0.02, quality_floor=0.55)
_DECISION = """
  round(mean_quality, 6) AS mean_quality, round(drift, 6) AS drift_vs_baseline, drift > 0.02 AS tripped_by_drift,
  mean_quality < 0.55 AS tripped_by_floor, CASE WHEN drift > 0.02 OR mean_quality < 0.55 THEN 'open' ELSE 'closed' END AS state
"""
_GATE_SQL = f"""WITH {t.DOCUMENTS_SCORED_SQL},
means AS (SELECT deployment_version, count(*) AS n_rows, avg(quality) AS mean_quality FROM docs_scored GROUP BY ALL),
drifts AS (
  SELECT *, (SELECT mean_quality FROM means WHERE deployment_version = 'src0') - mean_quality AS drift FROM means
),
decisions AS (
  SELECT deployment_version, n_rows, {_DECISION},
         CASE WHEN drift > 0.02 AND mean_quality < 0.55
              THEN printf('semantic drift %.2f > 0.02; mean quality %.2f < floor 0.55', drift, mean_quality)
              WHEN drift > 0.02 THEN printf('semantic drift %.2f > 0.02', drift)
              WHEN mean_quality < 0.55 THEN printf('mean quality %.2f < floor 0.55', mean_quality)
              ELSE printf('mean quality %.2f within tolerance (drift %.2f <= 0.02)', mean_quality, drift) END AS reason
  FROM drifts
)
"""
_DECISION_COLUMNS = ("mean_quality", "drift_vs_baseline", "tripped_by_drift", "tripped_by_floor", "state")


def rounded_decisions(decisions: DataFrame, *extra: str) -> DataFrame:
    return decisions.select("deployment_version", "n_rows", *_DECISION_COLUMNS, *extra).withColumns(
        {c: F.round(c, 6) for c in _DECISION_COLUMNS[:2]}
    )


def documents_decisions(evals: DataFrame) -> DataFrame:
    return qg.decide(evals, baseline="src0", options=GATE)


@query(
    _GATE_SQL
    + """SELECT *, CASE WHEN state = 'open' THEN least(n_rows, 3) ELSE 0 END AS routed_to_review FROM decisions"""
)
def gate_decision(spark, folder):
    return rounded_decisions(documents_decisions(documents_scored(spark, folder)), "reason", "routed_to_review")


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL},
drifts AS (SELECT deployment_version, count(*) AS n_rows, avg(quality) AS mean_quality, 0.0::DOUBLE AS drift
           FROM docs_scored GROUP BY ALL)
SELECT deployment_version, n_rows, {_DECISION} FROM drifts"""
)
def gate_no_baseline(spark, folder):
    return rounded_decisions(qg.decide(documents_scored(spark, folder), options=GATE))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT 'v2' AS deployment_version, count(*) AS n_rows, round(avg(quality), 6) AS mean_quality,
       round(any_value((SELECT avg(quality) FROM ev_scored WHERE deployment_version = 'v1')) - avg(quality), 6) AS drift_vs_baseline,
       false AS tripped_by_drift, true AS tripped_by_floor, 'open' AS state
FROM ev_scored WHERE deployment_version = 'v2'
UNION ALL SELECT 'v9', 0, 1.0::DOUBLE, 0.0::DOUBLE, false, false, 'closed'"""
)
def gate_empty_version(spark, folder):
    return rounded_decisions(qg.decide(events_scored(spark, folder), ["v2", "v9"], "v1"))


_WORST = """,
worst AS (
  SELECT *, row_number() OVER (PARTITION BY deployment_version ORDER BY quality, row_id) AS rn FROM docs_scored
)
"""


@query(
    _GATE_SQL.rstrip()
    + _WORST
    + """SELECT w.deployment_version, w.row_id, round(w.quality, 9) AS quality, 'short or plain text' AS why_flagged
FROM worst w JOIN decisions d USING (deployment_version) WHERE d.state = 'open' AND w.rn <= 3"""
)
def review_queue(spark, folder):
    evals = documents_scored(spark, folder)
    queue = qg.review_queue(evals, documents_decisions(evals), why=t.DOCUMENTS.review_reason)
    return queue.withColumn("quality", F.round("quality", 9))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL},
worst AS (SELECT *, row_number() OVER (PARTITION BY deployment_version ORDER BY quality, row_id) AS rn FROM ev_scored)
SELECT deployment_version, row_id, round(quality, 9) AS quality FROM worst WHERE rn <= 1500"""
)
def review_queue_large(spark, folder):
    evals = events_scored(spark, folder).select("deployment_version", "row_id", "quality")
    return qg.worst_rows(evals, 1500).withColumn("quality", F.round("quality", 9))


@query(
    _GATE_SQL
    + """SELECT d.row_id, d.deployment_version, d.lang, d.n_chars
FROM docs d JOIN decisions USING (deployment_version) WHERE state = 'closed'"""
)
def release_closed_versions(spark, folder):
    decisions = documents_decisions(documents_scored(spark, folder))
    released = qg.release(t.documents(spark, folder), decisions)
    return released.select("row_id", "deployment_version", "lang", "n_chars")


# --- metrics -------------------------------------------------------------------


def stored(spark: SparkSession, evals: DataFrame, run_id: str = "run-1", scored_at: str = "2024-02-10 12:00:00"):
    log = qg.MetricsLog(spark, new_folder(spark, "metrics"))
    log.append(evals, run_id, F.lit(scored_at).cast("timestamp"))
    return log


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL}
SELECT row_id, deployment_version, round(quality, 9) AS quality, 'expression' AS backend,
       round(latency_ms, 6) AS latency_ms, round(cost_usd, 12) AS cost_usd, round(u1, 9) AS long_enough,
       lang AS language, round(u2, 9) AS language_confidence, round(s3, 9) AS richness
FROM docs_scored"""
)
def metrics_roundtrip(spark, folder):
    back = stored(spark, documents_scored(spark, folder)).evaluations()
    answers = F.col("answers")
    return back.select(
        "row_id",
        "deployment_version",
        F.round("quality", 9).alias("quality"),
        "backend",
        F.round("latency_ms", 6).alias("latency_ms"),
        F.round("cost_usd", 12).alias("cost_usd"),
        F.round(answers["long_enough"]["noul"], 9).alias("long_enough"),
        answers["language"]["choice"].alias("language"),
        F.round(answers["language"]["confidence"], 9).alias("language_confidence"),
        F.round(answers["richness"]["score"], 9).alias("richness"),
    )


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL}
SELECT deployment_version, count(*) AS n, round(avg(quality), 6) AS mean_quality, round(sum(cost_usd), 9) AS total_cost
FROM docs_scored GROUP BY deployment_version"""
)
def drift_by_version(spark, folder):
    rows = qg.drift_by_version(documents_scored(spark, folder))
    return rows.withColumns({"mean_quality": F.round("mean_quality", 6), "total_cost": F.round("total_cost", 9)})


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL},
means AS (SELECT deployment_version, avg(quality) AS m FROM docs_scored GROUP BY ALL)
SELECT deployment_version, round(m, 6) AS mean_quality,
       round(m - lag(m) OVER (ORDER BY deployment_version), 6) AS drift_vs_previous
FROM means"""
)
def drift_trend(spark, folder):
    rows = qg.drift_trend(documents_scored(spark, folder))
    return rows.withColumns({c: F.round(c, 6) for c in ("mean_quality", "drift_vs_previous")})


@query(
    f"""WITH {t.DOCUMENTS_SCORED_SQL},
means AS (SELECT deployment_version, avg(quality) AS m FROM docs_scored GROUP BY ALL)
SELECT round(arg_min(m, deployment_version) - arg_max(m, deployment_version), 6) AS semantic_drift FROM means"""
)
def semantic_drift(spark, folder):
    return qg.semantic_drift(documents_scored(spark, folder)).select(F.round("semantic_drift", 6).alias("semantic_drift"))


def _ranked_sql(rows: str, group: str) -> str:
    return f"""
ranked AS (
  SELECT {group} AS g, latency_ms, row_number() OVER (PARTITION BY {group} ORDER BY latency_ms) - 1 AS rn,
         count(*) OVER (PARTITION BY {group}) AS n
  FROM {rows}
),
picked AS (
  SELECT g, max(latency_ms) FILTER (rn = round_even(0.5::DOUBLE * (n - 1), 0)) AS p50_latency_ms,
         max(latency_ms) FILTER (rn = round_even(0.95::DOUBLE * (n - 1), 0)) AS p95_latency_ms
  FROM ranked GROUP BY g
)"""


@query(
    f"WITH {t.EVENTS_SCORED_SQL}, {_ranked_sql('ev_scored', 'deployment_version')} "
    "SELECT g AS deployment_version, p50_latency_ms, p95_latency_ms FROM picked"
)
def latency_p50_p95(spark, folder):
    return qg.latency_percentiles(events_scored(spark, folder))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT deployment_version, count(*) AS n_rows, round(avg(quality), 6) AS mean_quality,
       round(sum(cost_usd), 9) AS total_cost_usd, true AS p95_within_bound
FROM ev_scored GROUP BY deployment_version"""
)
def latency_p95_approx(spark, folder):
    """The approximate value itself has no fixed counterpart: check that its rank is as near as promised."""
    accuracy = 10_000
    evals = events_scored(spark, folder)
    report = small_side(qg.drift_report(evals, accuracy))
    p95, n, latency = F.col("p95_latency_ms"), F.col("n_rows"), F.col("latency_ms")
    ranks = (
        evals.select("deployment_version", "latency_ms")
        .join(report, "deployment_version")
        .groupBy("deployment_version", "n_rows", "mean_quality", "total_cost_usd")
        .agg(F.count_if(latency < p95).alias("below"), F.count_if(latency <= p95).alias("up_to"))
    )
    slack = n / accuracy + 1
    within = (F.col("below") <= n * 0.95 + slack) & (F.col("up_to") >= n * 0.95 - slack)
    return ranks.select(
        "deployment_version",
        "n_rows",
        F.round("mean_quality", 6).alias("mean_quality"),
        F.round("total_cost_usd", 9).alias("total_cost_usd"),
        within.alias("p95_within_bound"),
    )


_CONFUSION_SQL = f"""WITH {t.DOCUMENTS_SCORED_SQL}, {t.LABELS_SQL},
compared AS (SELECT s.quality >= 0.5::DOUBLE AS says_good, h.is_good FROM docs_scored s JOIN human h USING (row_id))
"""


@query(
    _CONFUSION_SQL
    + """SELECT count(*) AS compared,
       round(count(*) FILTER (says_good != is_good) / nullif(count(*), 0), 9) AS disagreement_rate FROM compared"""
)
def disagreement_rate(spark, folder):
    rate = qg.disagreement_rate(documents_scored(spark, folder), t.document_labels(spark, folder))
    return rate.withColumn("disagreement_rate", F.round("disagreement_rate", 9))


@query(
    _CONFUSION_SQL
    + """SELECT count(*) AS compared, count(*) FILTER (NOT says_good AND NOT is_good) AS true_positives,
       count(*) FILTER (NOT says_good AND is_good) AS false_positives,
       count(*) FILTER (says_good AND is_good) AS true_negatives,
       count(*) FILTER (says_good AND NOT is_good) AS false_negatives,
       round(count(*) FILTER (NOT says_good AND is_good) / nullif(count(*) FILTER (is_good), 0), 9) AS false_positive_rate,
       round(count(*) FILTER (says_good != is_good) / nullif(count(*), 0), 9) AS disagreement_rate
FROM compared"""
)
def confusion_counts(spark, folder):
    counts = qg.confusion_counts(documents_scored(spark, folder), t.document_labels(spark, folder))
    return counts.withColumns({c: F.round(c, 9) for c in ("false_positive_rate", "disagreement_rate")})


@query(
    _CONFUSION_SQL
    + """SELECT count(*) AS compared,
       round(count(*) FILTER (says_good != is_good) / nullif(count(*), 0), 9) AS disagreement_rate FROM compared"""
)
def disagreement_by_composite_key(spark, folder):
    labels = t.document_labels(spark, folder)
    keyed = labels.select(row_key(F.col("row_id"), F.col("deployment_version")).alias("key"), "is_good")
    rate = qg.disagreement_rate(documents_scored(spark, folder), qg.labels_from_keys(keyed))
    return rate.withColumn("disagreement_rate", F.round("disagreement_rate", 9))


@query(
    _CONFUSION_SQL.rstrip()
    + f""",
{_ranked_sql('docs_scored', '1')},
means AS (SELECT deployment_version, avg(quality) AS m FROM docs_scored GROUP BY ALL)
SELECT 'expression' AS backend, (SELECT count(*) FROM docs_scored) AS rows_evaluated, deployment_version,
       round(m, 6) AS mean_quality,
       (SELECT round(arg_min(m, deployment_version) - arg_max(m, deployment_version), 6) FROM means) AS semantic_drift,
       (SELECT round(count(*) FILTER (says_good != is_good) / nullif(count(*), 0), 9) FROM compared) AS disagreement_rate,
       (SELECT p50_latency_ms FROM picked) AS p50_latency_ms, (SELECT p95_latency_ms FROM picked) AS p95_latency_ms,
       (SELECT round(sum(cost_usd), 9) FROM docs_scored) AS total_cost_usd,
       (SELECT round(sum(cost_usd) / count(*), 12) FROM docs_scored) AS cost_per_row_usd
FROM means"""
)
def loop_metrics(spark, folder):
    evals = stored(spark, documents_scored(spark, folder)).evaluations()
    one = qg.loop_metrics(evals, t.document_labels(spark, folder))
    columns = [c for c in one.columns if c != "mean_quality_by_version"]
    rows = one.select(*columns, F.explode("mean_quality_by_version").alias("deployment_version", "mean_quality"))
    digits = {"mean_quality": 6, "semantic_drift": 6, "disagreement_rate": 9, "total_cost_usd": 9, "cost_per_row_usd": 12}
    return rows.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, deployment_version, CASE WHEN deployment_version = 'v2' THEN 'run-2' ELSE 'run-1' END AS run_id,
       round(CASE WHEN deployment_version = 'v2' THEN quality / 2 ELSE quality END, 9) AS quality
FROM ev_scored"""
)
def latest_metrics(spark, folder):
    evals = events_scored(spark, folder)
    log = stored(spark, evals)
    rescored = evals.filter(F.col("deployment_version") == "v2").withColumn("quality", F.col("quality") / 2)
    log.append(rescored, "run-2", F.lit("2024-02-11 12:00:00").cast("timestamp"))
    return log.latest().select("row_id", "deployment_version", "run_id", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT deployment_version, 2 * count(*) AS n, round(avg(quality), 6) AS mean_quality, round(2 * sum(cost_usd), 9) AS total_cost
FROM ev_scored GROUP BY deployment_version"""
)
def drift_over_all_runs(spark, folder):
    evals = events_scored(spark, folder)
    log = stored(spark, evals)
    log.append(evals, "run-2", F.lit("2024-02-11 12:00:00").cast("timestamp"))
    rows = qg.drift_by_version(log.read())
    return rows.withColumns({"mean_quality": F.round("mean_quality", 6), "total_cost": F.round("total_cost", 9)})


# --- versions and exports ------------------------------------------------------


@query(
    f"""WITH {t.FORK_SQL}
SELECT row_id, deployment_version, o_orderpriority, o_orderstatus, o_totalprice, created_at FROM forked"""
)
def fork_union(spark, folder):
    return fork(spark, folder)


@query(
    f"""WITH {t.FORK_SQL}
SELECT deployment_version, o_orderstatus, count(*) AS n_rows FROM forked GROUP BY ALL"""
)
def table_refresh(spark, folder):
    path = new_folder(spark, "table")
    spec = t.ORDERS
    qg.write_table(t.orders(spark, folder), spec, path)
    qg.write_table(fork(spark, folder), spec, path)
    rows = qg.read_table(spark, spec, path)
    return rows.groupBy("deployment_version", "o_orderstatus").agg(F.count("*").alias("n_rows"))


_MANIFEST_SQL = f"""WITH {t.FORK_SQL},
pairs AS (
  SELECT a.row_id, a.o_orderpriority AS p1, b.o_orderpriority AS p2, a.o_orderstatus AS s1, b.o_orderstatus AS s2
  FROM forked a JOIN forked b ON a.row_id = b.row_id AND a.deployment_version = 'v1' AND b.deployment_version = 'v2'
)
SELECT row_id, p1 AS item, 'o_orderpriority' AS "column", p1 AS v1, p2 AS v2 FROM pairs WHERE p1 IS DISTINCT FROM p2
UNION ALL
SELECT row_id, p1, 'o_orderstatus', s1, s2 FROM pairs WHERE s1 IS DISTINCT FROM s2"""


@query(_MANIFEST_SQL)
def drift_manifest(spark, folder):
    return qg.drift_manifest(fork(spark, folder), t.ORDERS).select(*MANIFEST.fieldNames())


@query(_MANIFEST_SQL)
def export_manifest_roundtrip(spark, folder):
    path = new_folder(spark, "exports")
    qg.export_drift(fork(spark, folder), t.ORDERS, path)
    return read_csv(spark, f"{path}/orders_drift.csv", MANIFEST)


_DOCUMENTS_EXPORT_SQL = f"WITH {t.DOCUMENTS_SQL} SELECT row_id, deployment_version, lang, text, n_chars FROM docs"


@query(_DOCUMENTS_EXPORT_SQL)
def export_csv_roundtrip(spark, folder):
    rows = t.documents(spark, folder).drop("created_at")
    path = new_folder(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, line_breaks=True)


@query(_DOCUMENTS_EXPORT_SQL)
def export_json_roundtrip(spark, folder):
    rows = t.documents(spark, folder).drop("created_at")
    path = new_folder(spark, "json")
    write_json(rows, path)
    return read_json(spark, path, rows.schema)


# --- streaming and the whole loop ----------------------------------------------


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, deployment_version, round(quality, 9) AS quality FROM ev_scored"""
)
def stream_scored(spark, folder):
    schema = t.table(spark, folder, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    log = qg.MetricsLog(spark, new_folder(spark, "stream-metrics"))
    job = qg.score_stream(
        t.as_events(source), t.EVENTS, t.events_evaluator(), log, new_folder(spark, "stream-checkpoint")
    )
    job.awaitTermination()
    return log.read().select("row_id", "deployment_version", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, deployment_version, round(quality, 9) AS quality FROM ev_scored"""
)
def stream_scored_in_batches(spark, folder):
    """Several micro-batches, and all rows of one version once more: each key is scored once."""
    events, arriving = t.table(spark, folder, "events"), new_folder(spark, "arriving")
    events.repartition(3, "event_id").write.parquet(arriving)
    events.filter(F.dayofmonth("ts") <= 15).coalesce(1).write.mode("append").parquet(arriving)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    log = qg.MetricsLog(spark, new_folder(spark, "stream-metrics"))
    checkpoint = new_folder(spark, "stream-checkpoint")
    qg.score_stream(t.as_events(source), t.EVENTS, t.events_evaluator(), log, checkpoint).awaitTermination()
    return log.read().select("row_id", "deployment_version", F.round("quality", 9).alias("quality"))


@query(f"WITH {t.EVENTS_SQL} SELECT row_id, deployment_version, event_type FROM ev")
def stream_drop_repeats(spark, folder):
    schema = t.table(spark, folder, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    rows = t.as_events(source).withColumn("at", F.col("created_at").cast("timestamp"))
    out = new_folder(spark, "stream-distinct")
    writer = qg.drop_repeats(rows.unionByName(rows), "at", "60 days").writeStream.format("parquet").option("path", out)
    job = writer.option("checkpointLocation", new_folder(spark, "stream-checkpoint")).trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).select("row_id", "deployment_version", "event_type")


_LOOP_SQL = f"""WITH {t.EVENTS_SCORED_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY deployment_version ORDER BY row_id) AS rn,
         count(*) OVER (PARTITION BY deployment_version) AS n
  FROM ev_scored
),
routed AS (SELECT * FROM ranked WHERE rn <= greatest(1, floor(n * 0.4::DOUBLE))),
means AS (SELECT deployment_version, count(*) AS n_rows, avg(quality) AS m FROM routed GROUP BY ALL)
"""


@query(
    _LOOP_SQL
    + f"""SELECT b.deployment_version, b.n_rows, round(b.m, 6) AS mean_quality, round(a.m - b.m, 6) AS drift_vs_baseline,
       CASE WHEN a.m - b.m > 0.15 OR b.m < 0.7 THEN 'open' ELSE 'closed' END AS state,
       CASE WHEN a.m - b.m > 0.15 OR b.m < 0.7 THEN least(b.n_rows, 3) ELSE 0 END AS review_rows,
       a.n_rows + b.n_rows AS rows_evaluated, b.n_rows AS n_routed, 0 AS n_rejected,
       (SELECT round(sum(cost_usd), 9) FROM routed) AS total_cost_usd,
       (SELECT count(*) FROM ev WHERE deployment_version = 'v2') AS total_rows,
       (SELECT count(*) FILTER (props IS NULL OR length(trim(props)) = 0) FROM ev WHERE deployment_version = 'v2') AS completeness,
       (SELECT count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase', 'signup')) FROM ev WHERE deployment_version = 'v2') AS "schema",
       (SELECT count(*) FILTER (created_at < DATE '{t.AS_OF}' - INTERVAL 30 DAY) FROM ev WHERE deployment_version = 'v2') AS freshness
FROM means a JOIN means b ON a.deployment_version = 'v1' AND b.deployment_version = 'v2'"""
)
def full_loop(spark, folder):
    """Checks, decision, review and metrics of one loop over a sample, in one row."""
    log = qg.MetricsLog(spark, new_folder(spark, "loop-metrics"))
    result = qg.run_loop(
        t.events(spark, folder), t.EVENTS, t.events_evaluator(), log, "v1", ["v2"],
        as_of=day(t.AS_OF), options=Options(sample_rate=0.4),
    )
    report = result.report.select("deployment_version", "total_rows", "completeness", "schema", "freshness")
    decision = result.decisions.select(
        "deployment_version", "n_rows", "state", "n_routed", "n_rejected",
        *[F.round(c, 6).alias(c) for c in ("mean_quality", "drift_vs_baseline")],
    )
    metrics = result.metrics().select("rows_evaluated", F.round("total_cost_usd", 9).alias("total_cost_usd"))
    review = result.review().agg(F.count("*").alias("review_rows"))
    one_row = F.lit(1) == F.lit(1)
    return decision.join(report, "deployment_version").join(F.broadcast(metrics), one_row).join(F.broadcast(review), one_row)


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT deployment_version, count(*) AS n_rows, round(avg(quality), 6) AS mean_quality FROM ev_scored GROUP BY ALL"""
)
def loop_resumed(spark, folder):
    """A loop that goes on after an older evaluator's run, a stale run and a part of its own equals a fresh one."""
    log = qg.MetricsLog(spark, new_folder(spark, "loop-resumed"))
    rows, evals = t.events(spark, folder), events_scored(spark, folder)
    log.append(evals.withColumns({"quality": F.lit(0.0), "backend": F.lit("another")}), "other")
    old = F.lit("2020-01-01").cast("timestamp")
    log.append(evals.filter(F.col("row_id") % 3 == 0).withColumn("quality", F.lit(0.0)), "stale", old)
    log.append(evals.filter(F.col("row_id") % 3 == 0), "part")
    result = qg.run_loop(
        rows, t.EVENTS, t.events_evaluator(), log, "v1", ["v1", "v2"], as_of=day(t.AS_OF), skip_scored=True, slices=3
    )
    return result.decisions.select("deployment_version", "n_rows", F.round("mean_quality", 6).alias("mean_quality"))


_THIRDS_SQL = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS row_id, value, user_id, event_type, props,
         CASE WHEN day(ts) <= 10 THEN 'v1' WHEN day(ts) <= 20 THEN 'v2' ELSE 'v3' END AS deployment_version
  FROM events
)"""


@query(
    f"""WITH {_THIRDS_SQL},
judged AS (
  SELECT *, deployment_version = 'v3' OR (deployment_version = 'v2' AND user_id % 7 = 0) AS bad,
         0.5::DOUBLE * least(value / 100.0::DOUBLE, 1.0::DOUBLE)
           + 0.2::DOUBLE * CASE WHEN event_type IN ('click', 'view') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           + 0.3::DOUBLE * ((user_id % 5)::DOUBLE / 4.0::DOUBLE) AS quality
  FROM ev
)
SELECT deployment_version, count(*) AS n_routed, count(*) FILTER (NOT bad) AS n_rows, count(*) FILTER (bad) AS n_rejected,
       CASE WHEN count(*) FILTER (bad) > 0 OR avg(quality) FILTER (NOT bad) < 0.1 THEN 'open' ELSE 'closed' END AS state
FROM judged GROUP BY deployment_version"""
)
def gate_with_rejects(spark, folder):
    """An evaluator that fails for a share of one version and for all of another."""
    version = F.when(F.dayofmonth("ts") <= 10, "v1").when(F.dayofmonth("ts") <= 20, "v2").otherwise("v3")
    raw = t.table(spark, folder, "events").withColumn("version", version)
    rows = raw.select(*t.keys("event_id", F.col("version")), "event_type", "props", "value", "user_id")
    good = t.events_evaluator()
    bad = (F.col("deployment_version") == "v3") | ((F.col("deployment_version") == "v2") & (F.col("user_id") % 7 == 0))
    values = {**good.values, "is_traffic": F.when(bad, F.lit(2.0)).otherwise(good.values["is_traffic"])}
    evals, _ = qg.score_and_split(rows, t.EVENTS, qg.ExpressionEvaluator(values=values), unique=True)
    decisions = qg.decide(evals, options=Options(quality_floor=0.1), outcome=qg.scoring_outcome(rows, evals))
    return decisions.select("deployment_version", "n_routed", "n_rows", "n_rejected", "state")


_BLANK_SQL = """CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN chr(160)
                WHEN 4 THEN chr(12288) || ' ' WHEN 5 THEN chr(9) WHEN 6 THEN chr(10) ELSE text END"""


@query(
    f"""SELECT source AS deployment_version, count(*) AS total_rows,
       count(*) FILTER (t IS NULL OR length(trim(t)) = 0) AS completeness
FROM (SELECT source, {_BLANK_SQL} AS t FROM documents) GROUP BY source"""
)
def check_completeness_of_blanks(spark, folder):
    docs = t.table(spark, folder, "documents")
    kind, text = F.col("doc_id") % 8, F.col("text")
    for i, blank in enumerate([None, "", "   ", "\u00a0", "\u3000 ", "\t", "\n"]):
        text = F.when(kind == i, F.lit(blank).cast("string")).otherwise(text)
    rows = docs.select(*t.keys("doc_id", "source"), "lang", text.alias("text"), "n_chars", F.lit(None).cast("date").alias("created_at"))
    return qg.check_report(rows, t.DOCUMENTS).select("deployment_version", "total_rows", "completeness")


@query(
    f"""WITH {t.EVENTS_SCORED_SQL},
partly AS (SELECT row_id, deployment_version, CASE WHEN user_id % 3 = 0 THEN NULL ELSE (user_id % 8)::DOUBLE / 8.0::DOUBLE END AS quality FROM ev_scored),
worst AS (SELECT *, row_number() OVER (PARTITION BY deployment_version ORDER BY quality NULLS LAST, row_id) AS rn FROM partly)
SELECT k, deployment_version, row_id, quality FROM worst, (VALUES (900), (5000)) AS ks(k) WHERE rn <= k"""
)
def review_queue_null_quality(spark, folder):
    """Both ways of finding the worst rows, with ties and rows without a quality."""
    evals = events_scored(spark, folder).join(
        t.events(spark, folder).select(F.col("row_id").alias("id"), "user_id"), F.col("row_id") == F.col("id")
    )
    some = evals.select(
        "row_id", "deployment_version", F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 8 / 8.0).alias("quality")
    )
    return qg.worst_rows(some, 900).withColumn("k", F.lit(900)).unionByName(qg.worst_rows(some, 5000).withColumn("k", F.lit(5000)))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS row_id, CASE WHEN o_custkey % 1501 = 0 THEN NULL ELSE CAST(o_custkey % 1501 AS VARCHAR) END AS deployment_version
FROM orders WHERE o_custkey % 1501 = 0 OR o_custkey % 1501 > 100"""
)
def release_many_versions(spark, folder):
    """More versions than fit a filter, one of them without a name."""
    orders = t.table(spark, folder, "orders")
    n = F.col("o_custkey") % 1501
    rows = orders.select(*t.keys("o_orderkey", F.when(n != 0, n)))
    versions = rows.select("deployment_version").distinct()
    closed = F.col("deployment_version").isNull() | (F.col("deployment_version").cast("int") > 100)
    return qg.release(rows, versions.withColumn("state", F.when(closed, "closed").otherwise("open")))


@query(
    f"""WITH {t.EVENTS_SQL},
partly AS (SELECT CASE WHEN user_id % 4 = 0 THEN NULL ELSE row_id END AS row_id, deployment_version, event_type, props, value, user_id FROM ev)
SELECT * FROM partly WHERE ('0x' || substr(md5(coalesce(row_id, '')), 1, 8))::BIGINT < 0.9 * 4294967296"""
)
def route_hash_sample_null_ids(spark, folder):
    rows = t.events(spark, folder).withColumn("row_id", F.when(F.col("user_id") % 4 != 0, F.col("row_id")))
    return qg.route_hash_sample(rows, t.EVENTS, 0.9)


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT row_id, deployment_version, 0.0::DOUBLE AS cost_usd,
       round((0.5::DOUBLE * least(length(text) / 2000.0::DOUBLE, 1.0::DOUBLE) + 0.2::DOUBLE + 0.3::DOUBLE * 0.5::DOUBLE)
             / (0.5::DOUBLE + 0.2::DOUBLE + 0.3::DOUBLE), 9) AS quality
FROM docs"""
)
def score_batch_throttled(spark, folder):
    """The default way of a batch evaluator, in several waves, with a scorer that tells neither tokens nor confidence."""

    def scorer(state, questions):
        text = state["text"]
        return state.assign(long_enough=(text.str.len() / 2000.0).clip(upper=1.0), language=state["lang"], richness=2.0)

    batches = qg.BatchEvaluator(scorer, name="throttled", options=Options(batch_size=64, max_concurrency=4), task_rows=100)
    rows = t.documents(spark, folder).drop("created_at")
    evals = qg.score(rows, t.DOCUMENTS, batches, unique=True)
    return evals.select("row_id", "deployment_version", "cost_usd", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT format, row_id, deployment_version, lang, text, n_chars FROM docs, (VALUES ('csv'), ('json')) AS f(format)"""
)
def export_dataset_roundtrip(spark, folder):
    rows, path = t.documents(spark, folder), new_folder(spark, "exports")
    export_dataset(rows, t.DOCUMENTS, path)
    csv = read_csv(spark, f"{path}/documents.csv", rows.schema, line_breaks=True).withColumn("format", F.lit("csv"))
    json = read_json(spark, f"{path}/documents.json", rows.schema).withColumn("format", F.lit("json"))
    return csv.unionByName(json).drop("created_at")


# --- work that goes on, keys that are remembered, order, dates, latency ---------


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT row_id, deployment_version,
       round((0.5::DOUBLE * least(length(text) / 2000.0::DOUBLE, 1.0::DOUBLE) + 0.2::DOUBLE + 0.3::DOUBLE * 0.5::DOUBLE)
             / (0.5::DOUBLE + 0.2::DOUBLE + 0.3::DOUBLE), 9) AS quality
FROM docs"""
)
def score_batch_queue(spark, folder):
    """A paid run that is lost on the way and gone on with by the same call: each document has one evaluation."""
    rows = t.documents(spark, folder).drop("created_at").withColumn("place", F.col("row_id").cast("long"))
    late = rows.agg(F.expr("0.6 * max(place)")).first()[0]

    def evaluator(lost):
        def scorer(state, questions):
            if lost and (state["place"] > late).any():
                raise RuntimeError("the service went away")
            text = state["text"]
            return state.assign(long_enough=(text.str.len() / 2000.0).clip(upper=1.0), language=state["lang"], richness=2.0)

        options = Options(batch_size=64, max_concurrency=4, max_retries=1)
        return qg.BatchEvaluator(scorer, name="queued", options=options, task_rows=50)

    queue = new_folder(spark, "queue")
    with contextlib.suppress(StreamingQueryException):
        qg.score_queued(rows, t.DOCUMENTS, evaluator(lost=True), queue, unique=True)
    evals, _ = qg.score_queued(rows, t.DOCUMENTS, evaluator(lost=False), queue, unique=True)
    return evals.select("row_id", "deployment_version", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL},
let_through AS (SELECT * FROM ev_scored UNION ALL SELECT * FROM ev_scored WHERE CAST(row_id AS BIGINT) % 5 = 0)
SELECT row_id, deployment_version, round(quality, 9) AS quality, count(*) AS n FROM let_through GROUP BY ALL"""
)
def stream_scored_remembering(spark, folder):
    """Six batches: three with repeats across them, two that move the clock past the time of remembering, one after it."""
    events, arriving = t.table(spark, folder, "events"), new_folder(spark, "arriving")
    number = F.col("event_id")
    days = [
        ("2024-01-01", number % 3 == 0),
        ("2024-01-04", (number % 3 == 1) | (number % 6 == 0)),
        ("2024-01-06", (number % 3 == 2) | (number % 2 == 0)),
        ("2024-03-01", number % 7 == 0),
        ("2024-03-02", number % 7 == 1),
        ("2024-03-03", number % 5 == 0),
    ]
    for came, which in days:
        events.filter(which).withColumn("came", F.lit(came).cast("timestamp")).coalesce(1).write.mode("append").parquet(arriving)
    schema = spark.read.parquet(arriving).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    log = qg.MetricsLog(spark, new_folder(spark, "stream-metrics"))
    rows = t.as_events(source.select("*", F.col("came").alias("_came")), "_came")
    job = qg.score_stream(
        rows, t.EVENTS, t.events_evaluator(), log, new_folder(spark, "stream-checkpoint"), remember="20 days", clock=F.col("_came")
    )
    job.awaitTermination()
    rounded = log.read().withColumn("quality", F.round("quality", 9))
    return rounded.groupBy("row_id", "deployment_version", "quality").agg(F.count("*").alias("n"))


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT row_number() OVER (ORDER BY deployment_version, value DESC, CAST(row_id AS BIGINT)) AS place,
       row_id, deployment_version, value FROM ev"""
)
def rows_in_order(spark, folder):
    """The place of each row in a total order, from the order of the rows in the files written."""
    rows = t.events(spark, folder).withColumns({"_less": -F.col("value"), "_id": F.col("row_id").cast("long")})
    path = new_folder(spark, "ordered")
    qg.in_order(rows, "deployment_version", "_less", "_id").select("row_id", "deployment_version", "value").write.parquet(path)
    return places(spark, path)


def places(spark, path) -> DataFrame:
    """Rows of files written in order, each with its place: rows before its file, plus those before it in the file."""
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = files.groupBy("_file").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = files.join(F.broadcast(before), "_file").withColumn("place", F.col("_before") + F.col("_row") + 1)
    return placed.drop("_file", "_row", "_n", "_before")


@query(
    f"""WITH changes AS ({_MANIFEST_SQL})
SELECT row_number() OVER (ORDER BY row_id, CASE "column" WHEN 'o_orderpriority' THEN 0 ELSE 1 END) AS place, * FROM changes"""
)
def manifest_order(spark, folder):
    """A manifest is written by row id, then by the column's position."""
    path = new_folder(spark, "manifest")
    changes = qg.drift_manifest(fork(spark, folder), t.ORDERS)
    qg.manifest_in_order(changes).select(*MANIFEST.fieldNames()).write.parquet(path)
    return places(spark, path)


@query(
    f"""WITH {t.EVENTS_SQL}
SELECT row_id, deployment_version, created_at, CAST(NULL AS DATE) AS of_wrong FROM ev"""
)
def dates_from_texts(spark, folder):
    """ISO texts become dates; texts that are none become NULL if asked for."""
    rows = t.events(spark, folder)
    texts = rows.withColumn("created_at", F.col("created_at").cast("string"))
    wrong = rows.withColumn("created_at", F.concat(F.lit("2024-13-"), F.dayofmonth("created_at").cast("string")))
    good, bad = conform(texts, t.EVENTS), conform(wrong, t.EVENTS, on_bad_date="null")
    named = bad.select("row_id", "deployment_version", F.col("created_at").alias("of_wrong"))
    return good.select("row_id", "deployment_version", "created_at").join(named, ["row_id", "deployment_version"])


@query(
    f"""WITH {t.EVENTS_SCORED_SQL}
SELECT row_id, deployment_version, 'now' AS run_id, true AS stamped FROM ev_scored"""
)
def scored_now(spark, folder):
    """Without a given time, rows are stamped with the time of the append, in the folder of its day."""
    log = qg.MetricsLog(spark, new_folder(spark, "now"))
    before = spark.sql("SELECT current_timestamp()").first()[0]
    log.append(events_scored(spark, folder), "now")
    after = spark.sql("SELECT current_timestamp()").first()[0]
    stamped = F.col("scored_at").between(F.lit(before), F.lit(after)) & (F.col("scored_date") == F.to_date("scored_at"))
    return log.read().select("row_id", "deployment_version", "run_id", stamped.alias("stamped"))


@query(
    f"""WITH {t.FORK_SQL}, manifest AS ({_MANIFEST_SQL})
SELECT (SELECT count(*) FROM forked) AS n_rows, (SELECT count(*) FROM manifest) AS n_changes,
       (SELECT count(*) FROM forked) AS json_rows, (SELECT count(*) FROM manifest) AS drift_rows"""
)
def export_everything(spark, folder):
    """Tables and manifests of all datasets, counted as they were written."""
    path = new_folder(spark, "exports")
    counts = qg.export_all({"orders": (t.ORDERS, fork(spark, folder))}, path)["orders"]
    read = [spark.read.json(f"{path}/orders{kind}.json").agg(F.count("*").alias(name)) for kind, name in (("", "json_rows"), ("_drift", "drift_rows"))]
    given = read[0].select(F.lit(counts[0]).cast("long").alias("n_rows"), F.lit(counts[1]).cast("long").alias("n_changes"), "json_rows")
    return given.select("*", read[1].select("drift_rows").scalar().alias("drift_rows"))


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT row_id, deployment_version, CASE WHEN lang = 'fr' THEN 2500.0::DOUBLE ELSE 1000.0::DOUBLE END AS latency_ms,
       CASE WHEN lang = 'fr' THEN 'long_enough: noul is not in [0, 1]' END AS error
FROM docs"""
)
def score_batch_latency(spark, folder):
    """By a scripted clock a call takes a second; French rows take two calls and the pause between them."""

    def scorer(state, questions):
        return state.assign(long_enough=state["lang"].eq("fr") * 1.5, language=state["lang"], richness=2.0)

    now = [0.0]

    def clock():
        now[0] += 1.0
        return now[0]

    options = Options(batch_size=64, max_retries=2, first_backoff_s=0.5)
    batches = qg.BatchEvaluator(scorer, options=options, on_error="quarantine", throttle=False, clock=clock, pause=lambda seconds: None)
    rows = t.documents(spark, folder).drop("created_at")
    return qg.score_with_errors(rows, t.DOCUMENTS, batches, unique=True).select("row_id", "deployment_version", "latency_ms", "error")


@query(ORACLE["score_unscored_only"])
def score_unscored_by_bucket(spark, folder):
    """What is scored already is looked up in a log with key buckets, which reads only those of the keys asked for."""
    rows = t.events(spark, folder)
    log = qg.MetricsLog(spark, new_folder(spark, "bucketed-log"), buckets=16)
    already = rows.filter((F.col("deployment_version") == "v1") & F.col("event_type").isin("click", "view"))
    log.append(qg.score(already, t.EVENTS, t.events_evaluator(), unique=True), "before")
    evals = qg.score(rows, t.EVENTS, t.events_evaluator(), scored=log.seen("expression"), unique=True)
    return evals.select("row_id", "deployment_version", F.round("quality", 9).alias("quality"))


@query(
    f"""WITH {t.EVENTS_SCORED_SQL},
logged AS (SELECT * FROM ev_scored UNION ALL SELECT * FROM ev_scored WHERE CAST(row_id AS BIGINT) % 10 = 1)
SELECT deployment_version, count(*) AS n_rows, round(avg(quality), 6) AS mean_quality, round(sum(cost_usd), 9) AS total_cost_usd,
       true AS near_p95, true AS as_trend, 3 AS closed_first, 1 AS closed_again
FROM logged GROUP BY deployment_version"""
)
def history_by_day(spark, folder):
    """A log of five days, three of them summarised; then rows come late to one of these, and it is summarised again."""
    evals = events_scored(spark, folder)
    log = qg.MetricsLog(spark, new_folder(spark, "history-log"))
    start = F.lit("2024-02-01").cast("date")
    for day in range(5):
        log.append(evals.filter(F.col("row_id") % 5 == day), f"run-{day}", F.date_add(start, day).cast("timestamp"))
    history = qg.DailyHistory(log, new_folder(spark, "history"))
    first = len(history.close("2024-02-04"))
    log.append(evals.filter(F.col("row_id") % 10 == 1), "late", F.date_add(start, 1).cast("timestamp"))
    again = len(history.close("2024-02-04"))
    report = pin(history.report())
    below = log.read().join(F.broadcast(report), "deployment_version").groupBy("deployment_version").agg(
        (F.abs(F.avg((F.col("latency_ms") <= F.col("p95_latency_ms")).cast("int")) - 0.95) < 0.01).alias("near_p95")
    )
    trend = history.trend().select("deployment_version", F.col("mean_quality").alias("_mean"))
    joined = report.join(below, "deployment_version").join(trend, "deployment_version")
    return joined.select(
        "deployment_version", "n_rows", F.round("mean_quality", 6).alias("mean_quality"), F.round("total_cost_usd", 9).alias("total_cost_usd"),
        "near_p95", (F.abs(F.col("_mean") - F.col("mean_quality")) < 1e-12).alias("as_trend"),
        F.lit(first).alias("closed_first"), F.lit(again).alias("closed_again"),
    )


@query(ORACLE["deterministic_report_repeated_ids"])
def check_report_of_parts(spark, folder):
    """The report over a table that came in four parts, ids repeating across them, one part counted twice."""
    rows = t.lineitem(spark, folder)
    ledger = qg.CheckLedger(spark, new_folder(spark, "ledger"), t.LINEITEM)
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(4))
    for part in (0, 1, 2, 3, 2):
        ledger.add(rows.filter(place == part), f"part-{part}")
    return ledger.report(day(t.LINEITEM_AS_OF))


@query(ORACLE["deterministic_report"])
def stream_checked(spark, folder):
    """The report of what a stream brought, from what was counted of each micro-batch."""
    events, arriving = t.table(spark, folder, "events"), new_folder(spark, "arriving")
    events.repartition(3, "event_id").write.parquet(arriving)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    ledger = qg.CheckLedger(spark, new_folder(spark, "ledger"), t.EVENTS)
    counted = t.as_events(source).writeStream.foreachBatch(lambda batch, number: ledger.add(batch, number))
    counted.option("checkpointLocation", new_folder(spark, "ledger-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return ledger.report(day(t.AS_OF))


@query(
    f"""WITH {t.DOCUMENTS_SQL}
SELECT row_id, deployment_version,
       CASE WHEN n_chars % 10 = 0 THEN 'the response is no JSON object' WHEN lang = 'fr' THEN 'richness: no answer'
            WHEN lang = 'es' THEN 'long_enough: string is no noul' WHEN n_chars % 10 = 1 THEN 'long_enough: noul is not in [0, 1]' END AS error,
       CASE WHEN n_chars % 10 > 1 AND lang NOT IN ('fr', 'es') THEN
         round((0.5::DOUBLE * 0.25::DOUBLE + 0.2::DOUBLE * CASE WHEN lang = 'de' THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END
                + 0.3::DOUBLE * 0.5::DOUBLE) / (0.5::DOUBLE + 0.2::DOUBLE + 0.3::DOUBLE), 9) END AS quality
FROM docs"""
)
def score_raw_responses(spark, folder):
    """Responses of changing shape: broken JSON, missing, extra and ill-typed answers, answers with and without confidence."""
    rows = t.documents(spark, folder).drop("created_at")
    lang, tenth = F.col("lang"), F.col("n_chars") % 10
    language = F.when(lang == "de", '{"value": "de", "confidence": 0.75}').otherwise(F.concat(F.lit('"'), lang, F.lit('"')))
    enough = F.when(lang == "es", '"high"').when(tenth == 1, "1.5").otherwise("0.25")
    rest = F.when(lang == "fr", ', "mood": [1, {"x": null}]').otherwise(', "richness": 3, "mood": "fine"')
    response = F.concat(F.lit('{"long_enough": '), enough, F.lit(', "language": '), language, rest, F.when(tenth == 0, "").otherwise("}"))
    scored = qg.score_with_errors(rows.withColumn("response", response), t.DOCUMENTS, qg.ResponseEvaluator(), unique=True)
    return scored.select("row_id", "deployment_version", "error", F.round("quality", 9).alias("quality"))


@query(_DOCUMENTS_EXPORT_SQL)
def export_json_array_roundtrip(spark, folder):
    rows = t.documents(spark, folder).drop("created_at")
    path = new_folder(spark, "json-arrays")
    write_json_array(rows.repartition(3), path)
    return read_json(spark, path, rows.schema, array=True)
