"""Evaluators: given rows and questions, add typed answers.

An evaluator has a ``name``, a price and one method, ``answers(df, spec)``, which returns the
keys and bookkeeping columns of the same rows (and content, if it likes) with four more columns: ``answers`` (map of question key to answer), ``tokens``,
``latency_ms`` and ``error``: NULL for a scored row, else the reason, and then its answers do not count.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.functions import answer_map
from qualitygate.plans.scratch import new_folder
from qualitygate.plans.work_queue import WorkQueue
from qualitygate.spec import CHOICE, KEYS, NOUL, SCORE, DatasetSpec, Options


class Evaluator(Protocol):
    name: str
    price_per_mtok: float

    def answers(self, df: DataFrame, spec: DatasetSpec) -> DataFrame: ...


def state_columns(df: DataFrame) -> list[str]:
    """What gets scored: everything but the keys. Names starting with an underscore are bookkeeping."""
    return [c for c in df.columns if c not in KEYS and not c.startswith("_")]


@dataclass(frozen=True)
class ExpressionEvaluator:
    """Answers written as Columns or SQL text over the row; runs inside Spark's generated code.

    ``values`` holds one expression per question key: a probability for ``noul``, an option for
    ``choice``, a level counted from 1 for ``score``. Keys left out are missing from the answers.
    """

    values: Mapping[str, Column | str]
    confidence: Mapping[str, Column | str] = field(default_factory=dict)
    tokens: Column | str = "0"
    latency_ms: Column | str = "0"
    name: str = "expression"
    price_per_mtok: float = Options.price_per_mtok

    def answers(self, df: DataFrame, spec: DatasetSpec) -> DataFrame:
        asked = [q for q in spec.questions if q.key in self.values]
        if not asked:
            raise ValueError(f"no expression answers a question of dataset {spec.name!r}")
        raw = {f"_value_{q.key}": self.values[q.key] for q in asked}
        raw |= {f"_confidence_{q.key}": self.confidence[q.key] for q in asked if q.key in self.confidence}
        raw |= {"_tokens": self.tokens, "_latency": self.latency_ms}
        raw = {name: F.expr(c) if isinstance(c, str) else c for name, c in raw.items()}
        answers = answer_map(
            asked,
            {q.key: f"_value_{q.key}" for q in asked},
            {q.key: f"_confidence_{q.key}" for q in asked if q.key in self.confidence},
        )
        return df.withColumns(raw).select(
            *df.columns,
            answers.alias("answers"),
            F.expr("coalesce(cast(_tokens as double), 0.0D)").alias("tokens"),
            F.expr("coalesce(cast(_latency as double), 0.0D)").alias("latency_ms"),
            F.expr("cast(null as string)").alias("error"),
        )


@dataclass(frozen=True)
class BatchEvaluator:
    """A Python scorer called with small pandas batches, e.g. a client of a hosted model.

    ``score(state, questions)`` gets the content columns of up to ``batch_size`` rows and the
    questions as plain dicts by key. It returns a frame with one row per input row, in order: a
    column per question key (probability, option, or 0-based place on the rubric), optionally
    ``<key>.confidence`` and ``tokens``.

    Failed calls are repeated with doubling pauses. Rows with an unusable answer are repeated too,
    without the good ones; after a failed call every row goes alone, so that one bad row does not
    take its neighbours along. Rows left after ``max_retries`` fail the job (``on_error="fail"``)
    or come out with an ``error`` text and no answers (``"quarantine"``).

    ``throttle`` limits calls in flight to ``max_concurrency``: rows wait in files of ``task_rows`` (more in
    a long queue, see ``WorkQueue.fill``) in a ``WorkQueue`` and are scored and written, by that many tasks at a time, when ``answers`` is called.
    Without it parallelism follows the data, which is right for scorers that run locally.

    ``queue`` names the queue's folder, for the rows of one call of ``answers``: if that was killed, a
    call with the same folder goes on with the rows it holds and scores no finished file again
    (``score_queued`` does this). Left out, the queue is a new folder in the shared one.

    ``clock`` and ``pause`` tell the time and wait, in seconds; latency is measured by them.
    """

    score: Callable
    name: str = "batch"
    price_per_mtok: float = Options.price_per_mtok
    options: Options = Options()
    on_error: str = "fail"
    throttle: bool = True
    task_rows: int = 10_000
    queue: str | None = None
    clock: Callable[[], float] = time.perf_counter
    pause: Callable[[float], None] = time.sleep

    def __post_init__(self) -> None:
        if self.on_error not in ("fail", "quarantine"):
            raise ValueError("on_error must be 'fail' or 'quarantine'")

    def answers(self, df: DataFrame, spec: DatasetSpec) -> DataFrame:
        raw = [
            T.StructField(f"{q.key}.{part}", T.StringType() if (part, q.type) == ("value", CHOICE) else T.DoubleType())
            for q in spec.questions
            for part in ("value", "confidence")
        ]
        tail = [
            T.StructField("tokens", T.DoubleType()),
            T.StructField("latency_ms", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
        state = state_columns(df)
        # texts go to the workers and do not come back
        kept = [f for f in df.schema.fields if f.name not in state]
        schema = T.StructType([*kept, *raw, *tail])
        run = _batch_function(self.score, spec.questions, state, schema.fieldNames(), self.options, self.on_error, self.clock, self.pause)
        if self.throttle:
            slots = self.options.max_concurrency
            waiting = WorkQueue(df.sparkSession, self.queue or new_folder(df.sparkSession, "queue")).fill(df, self.task_rows, slots)
            answered = waiting.work(run, schema, KEYS, slots)
        else:
            answered = df.mapInPandas(run, schema)

        mapped = answer_map(
            spec.questions,
            {q.key: f"{q.key}.value" for q in spec.questions},
            {q.key: f"{q.key}.confidence" for q in spec.questions},
            first_level=0,
        )
        return answered.select(*[f.name for f in kept], mapped.alias("answers"), "tokens", "latency_ms", "error")


def _batch_function(score, questions, state, out_columns, options, on_error, clock, wait):
    """The function sent to the Python workers. Nested, so that it travels with its helpers."""
    kinds = [(q.key, q.type) for q in questions]
    payloads = {q.key: q.payload() for q in questions}
    size, attempts, first_pause = options.batch_size, options.max_retries, options.first_backoff_s
    noul, numeric = NOUL, (NOUL, SCORE)

    def run(batches):
        import numpy as np
        import pandas as pd

        def response(part):
            """One call, brought to the raw columns, with a reason per unusable row."""
            got = score(part[state].reset_index(drop=True), payloads)
            if len(got) != len(part):
                raise ValueError(f"scorer returned {len(got)} rows for {len(part)}")
            out = pd.DataFrame(index=part.index)
            reason = pd.Series([None] * len(part), index=part.index, dtype=object)

            def blame(bad, text):
                bad = reason.isna() & bad
                if bad.any():  # assigning by a mask is dear in pandas, even by an empty one
                    reason.loc[bad] = text

            for key, kind in kinds:
                if key not in got:
                    raise KeyError(f"scorer gave no answer for {key!r}")
                value = pd.Series(got[key].to_numpy(), index=part.index)
                sure = got.get(f"{key}.confidence")
                sure = pd.Series(1.0 if sure is None else sure.to_numpy(), index=part.index)
                sure = sure.astype(object).where(sure.notna(), 1.0).astype(float)
                if kind in numeric:
                    # among floats NaN is an answer, if a wrong one; only other columns can hold none at all
                    missing = value.isna() & (value.dtype.kind not in "fiub")
                    if value.dtype == object:
                        missing &= np.frompyfunc(lambda v: v is None or v is pd.NA, 1, 1)(value[missing]).reindex(value.index, fill_value=False).astype(bool)
                    value = value.astype(object).where(~missing, np.nan).astype(float)
                    blame(missing, f"{key}: no {kind}")
                if kind == noul:
                    blame(~value.between(0.0, 1.0), f"{key}: noul is not in [0, 1]")
                blame(~sure.between(0.0, 1.0), f"{key}: confidence is not in [0, 1]")
                out[f"{key}.value"] = value
                out[f"{key}.confidence"] = sure
            tokens = got.get("tokens")
            out["tokens"] = 0.0 if tokens is None else pd.Series(tokens.to_numpy(), index=part.index).fillna(0.0).astype(float)
            return out, reason

        def score_batch(part):
            spent = pd.Series(0.0, index=part.index)  # each row's own calls and pauses, not those of its neighbours
            pending, alone, done, pause = part.index, False, [], first_pause
            last = pd.Series(dtype=object)
            for attempt in range(attempts):
                if attempt:
                    wait(pause)
                    spent[pending] += pause * 1000.0
                    pause *= 2
                step = 1 if alone else max(1, len(pending))
                failed = []
                for at in range(0, len(pending), step):
                    chunk, began = pending[at : at + step], clock()
                    try:
                        out, reason = response(part.loc[chunk])
                    except Exception as problem:
                        spent[chunk] += (clock() - began) * 1000.0
                        alone = True
                        failed.append(pd.Series(str(problem) or repr(problem), index=chunk, dtype=object))
                        continue
                    good = reason.isna()
                    spent[chunk] += (clock() - began) * 1000.0
                    out["latency_ms"] = spent[chunk]
                    done.append(out[good])
                    failed.append(reason[~good])
                last = pd.concat(failed) if failed else last
                pending = last.index
                if not len(pending):
                    break
            result = part.drop(columns=state)
            result = result.join(pd.concat(done)) if done else result
            result["error"] = None
            if len(pending):
                if on_error == "fail":
                    raise RuntimeError(f"evaluation failed after {attempts} attempts: {last.iloc[0]}")
                result["error"] = last.reindex(part.index)
                result["error"] = result["error"].astype(object).where(result["error"].notna(), None)
                result.loc[pending, "latency_ms"] = spent[pending]
                result.loc[pending, "tokens"] = 0.0
            return result.reindex(columns=out_columns)

        for batch in batches:
            batch = batch.reset_index(drop=True)
            for at in range(0, len(batch), size):
                yield score_batch(batch.iloc[at : at + size])

    return run


@dataclass(frozen=True)
class ResponseEvaluator:
    """Answers out of raw responses, one JSON object of any shape per row, that are stored with the rows.

    A question's key holds its answer: a number for ``noul`` and ``score`` (a level counted from 1), a text for
    ``choice``, or an object with that as ``value`` and a ``confidence``. Other keys do not matter. A row
    whose response is no object, or whose answer to a question is missing or of another type, gets the reason as
    its ``error`` and no answers; its neighbours keep theirs. ``tokens`` and ``latency_ms`` name keys with numbers.
    """

    response: str = "response"
    tokens: str = "tokens"
    latency_ms: str = "latency_ms"
    name: str = "responses"
    price_per_mtok: float = Options.price_per_mtok

    def answers(self, df: DataFrame, spec: DatasetSpec) -> DataFrame:
        def at(*keys: str) -> str:
            return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)

        def kind_of(column: str) -> Column:
            """OBJECT, ARRAY, STRING, BOOLEAN, NUMBER or VOID; NULL if there is nothing."""
            said = F.regexp_extract(F.schema_of_variant(column), "^[A-Z]+", 0)
            return F.when(said.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(said)

        rows = df.withColumn("_v", F.try_parse_json(self.response))
        rows = rows.withColumns({f"_i{i}": F.try_variant_get("_v", at(q.key), "variant") for i, q in enumerate(spec.questions)})
        apart, values, sure, problems = {}, {}, {}, F.when(F.coalesce(kind_of("_v"), F.lit("")) != "OBJECT", "the response is no JSON object")
        for i, q in enumerate(spec.questions):
            nested = kind_of(f"_i{i}") == "OBJECT"
            apart[f"_a{i}"] = F.when(nested, F.try_variant_get(f"_i{i}", at("value"), "variant")).otherwise(F.col(f"_i{i}"))
            apart[f"_s{i}"] = F.when(nested, F.try_variant_get(f"_i{i}", at("confidence"), "variant"))
        rows = rows.withColumns(apart)
        for i, q in enumerate(spec.questions):
            wanted = "STRING" if q.type == CHOICE else "NUMBER"
            given, confidence = kind_of(f"_a{i}"), kind_of(f"_s{i}")
            problems = problems.when(F.coalesce(given, F.lit("VOID")) == "VOID", f"{q.key}: no answer")
            problems = problems.when(given != wanted, F.concat(F.lit(f"{q.key}: "), F.lower(given), F.lit(f" is no {q.type}")))
            problems = problems.when(confidence.isNotNull() & ~confidence.isin("NUMBER", "VOID"), F.concat(F.lit(f"{q.key}: "), F.lower(confidence), F.lit(" is no confidence")))
            values[f"_value_{q.key}"] = F.try_variant_get(f"_a{i}", "$", "string" if q.type == CHOICE else "double")
            sure[f"_confidence_{q.key}"] = F.try_variant_get(f"_s{i}", "$", "double")
        read = rows.withColumns(values | sure).withColumn("error", problems.otherwise(F.lit(None).cast("string")))
        mapped = answer_map(spec.questions, {q.key: f"_value_{q.key}" for q in spec.questions}, {q.key: f"_confidence_{q.key}" for q in spec.questions})
        number = {c: F.coalesce(F.try_variant_get("_v", at(k), "double"), F.lit(0.0)).alias(c) for c, k in (("tokens", self.tokens), ("latency_ms", self.latency_ms))}
        kept = [c for c in df.columns if c not in state_columns(df)]
        return read.select(*kept, F.when(F.col("error").isNull(), mapped).alias("answers"), *number.values(), "error")


_EVALUATORS: dict[str, Callable[[], Evaluator]] = {}


def register_evaluator(name: str, factory: Callable[[], Evaluator]) -> None:
    _EVALUATORS[name.strip().lower()] = factory


def get_evaluator(name: str) -> Evaluator:
    wanted = name.strip().lower()
    if wanted not in _EVALUATORS:
        raise ValueError(f"unknown evaluator {wanted!r}; registered: {', '.join(sorted(_EVALUATORS)) or 'none'}")
    return _EVALUATORS[wanted]()
