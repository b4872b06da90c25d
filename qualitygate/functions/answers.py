"""Typed answers: building, validating, normalising and combining them.

``item`` is SQL text that yields one answer, for instance ``item_of("category_correct")``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from qualitygate.functions.text import sql_double, sql_name, sql_string
from qualitygate.spec import CHOICE, DEFAULT_RUBRIC, NOUL, SCORE, Question

SQL_TYPES = {NOUL: "double", CHOICE: "string", SCORE: "double"}


def item_of(key: str, answers: str = "answers") -> str:
    return f"{sql_name(answers)}[{sql_string(key)}]"


def answer_map(
    questions: Sequence[Question], values: Mapping[str, str], confidence: Mapping[str, str], first_level: int = 1
) -> Column:
    """The map of question key to answer.

    ``values`` and ``confidence`` name the columns that hold them. ``first_level`` says from where
    scores count; answers count levels from 1. A missing confidence is 1.
    """
    entries = []
    for q in questions:
        if q.key not in values:
            continue
        value = f"cast({sql_name(values[q.key])} as {SQL_TYPES[q.type]})"
        if q.type == SCORE and first_level != 1:
            value = f"({value} + {sql_double(1 - first_level)})"
        fields = {kind: value if kind == q.type else f"cast(null as {t})" for kind, t in SQL_TYPES.items()}
        sure = "1.0D"
        if q.key in confidence:
            sure = f"coalesce(cast({sql_name(confidence[q.key])} as double), 1.0D)"
        typed = ", ".join(f"{sql_string(kind)}, {text}" for kind, text in fields.items())
        key = sql_string(q.key)
        entries.append(
            f"{key}, named_struct('key', {key}, 'type', {sql_string(q.type)}, {typed}, 'confidence', {sure})"
        )
    return F.expr(f"map({', '.join(entries)})")


def in_unit_interval(value: Column) -> Column:
    """True for NULL and for numbers in [0, 1]; NaN is outside."""
    return value.isNull() | value.between(0.0, 1.0)


def _problems(item: str, prefix: str = "") -> list[tuple[str, str]]:
    """Conditions that make an answer invalid, each with its message. Scores are not range-checked."""
    return [
        (f"NOT ({item}.{name} BETWEEN 0.0D AND 1.0D)", sql_string(f"{prefix}{name} is not in [0, 1]"))
        for name in (NOUL, "confidence")
    ]


def _all_problems(questions: Sequence[Question], answers: str) -> list[tuple[str, str]]:
    return [found for q in questions for found in _problems(item_of(q.key, answers), f"{q.key}: ")]


def _case(branches: Sequence[tuple[str, str]], otherwise: str) -> Column:
    if not branches:
        return F.expr(otherwise)
    return F.expr("CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in branches) + f" ELSE {otherwise} END")


def answer_problem(item: str) -> Column:
    """Why an answer is invalid, or NULL."""
    return _case(_problems(item), "cast(null as string)")


def answers_problem(questions: Sequence[Question], answers: str = "answers", error: str = "error") -> Column:
    """``error``, or the first problem among a row's answers with its key, or NULL."""
    given = sql_name(error)
    return _case([(f"{given} IS NOT NULL", given), *_all_problems(questions, answers)], "cast(null as string)")


def answers_or_raise(questions: Sequence[Question], answers: str = "answers", error: str = "error") -> Column:
    """True for a row without a problem; a row with one ends the job."""
    given = sql_name(error)
    problems = [(f"{given} IS NOT NULL", given), *_all_problems(questions, answers)]
    return _case([(when, f"cast(raise_error({text}) as boolean)") for when, text in problems], "true")


def _unit_sql(item: str, n_levels: int, kind: str | None = None) -> str:
    """Goodness of an answer; 0 for an absent one. With ``kind`` the type is known beforehand."""
    if n_levels < 2:
        raise ValueError("a rubric needs at least two levels")
    place = f"(coalesce({item}.score, 1.0D) - 1.0D) / {sql_double(n_levels - 1)}"
    by_kind = {
        NOUL: f"coalesce({item}.noul, 0.0D)",
        SCORE: f"greatest(0.0D, least(1.0D, {place}))",
        CHOICE: f"coalesce({item}.confidence, 0.0D)",
    }
    if kind is not None:
        return by_kind[kind]
    return f"CASE {item}.type {' '.join(f'WHEN {sql_string(k)} THEN {v}' for k, v in by_kind.items())} ELSE 0.0D END"


def answer_unit(item: str, n_levels: int = len(DEFAULT_RUBRIC)) -> Column:
    """Goodness of one answer in [0, 1]."""
    return F.expr(_unit_sql(item, n_levels))


def row_quality(
    weights: Mapping[str, float], questions: Sequence[Question] = (), answers: str = "answers"
) -> Column:
    """Weighted mean of the answers that are present, in the order of ``weights``; 0 without any.

    A plain row expression: no explode, no shuffle. It is kept short because the JVM leaves very
    long generated methods uncompiled: an absent answer adds 0 to the sum anyway, and the types of
    ``questions`` are settled here rather than per row.
    """
    known = {q.key: q for q in questions}
    total, weight_sum = "0.0D", "0.0D"
    for key, weight in weights.items():
        item, w, q = item_of(key, answers), sql_double(weight), known.get(key)
        n_levels = len(q.rubric) if q and q.type == SCORE else len(DEFAULT_RUBRIC)
        total += f" + {w} * {_unit_sql(item, n_levels, q.type if q else None)}"
        weight_sum += f" + if({item} IS NULL, 0.0D, {w})"
    return F.expr(f"coalesce(try_divide({total}, {weight_sum}), 0.0D)")


def token_cost(tokens: Column, price_per_mtok: float) -> Column:
    """Cost of one call; a missing token count is 0."""
    return F.coalesce(tokens.cast("double"), F.lit(0.0)) / F.lit(1_000_000.0) * F.lit(float(price_per_mtok))


def quality_band(quality: Column) -> Column:
    return F.when(quality >= 0.7, "green").when(quality >= 0.5, "yellow").otherwise("red")


def answer_text(item: str) -> Column:
    """An answer for display: one digit for a score, two for a probability, the option for a choice."""
    return F.expr(
        f"CASE {item}.type WHEN {sql_string(SCORE)} THEN format_number({item}.score, '0.0') "
        f"WHEN {sql_string(CHOICE)} THEN {item}.choice ELSE format_number({item}.noul, '0.00') END"
    )
