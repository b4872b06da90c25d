"""Expression builders. None touches a DataFrame."""

from qualitygate.functions.answers import (
    answer_map,
    answer_problem,
    answer_text,
    answer_unit,
    answers_or_raise,
    answers_problem,
    in_unit_interval,
    item_of,
    quality_band,
    row_quality,
    token_cost,
)
from qualitygate.functions.predicates import check_status, is_blank, is_not_allowed, is_older_than, row_key, sample_hash
from qualitygate.functions.text import fixed

__all__ = [
    "answer_map",
    "answer_problem",
    "answer_text",
    "answer_unit",
    "answers_or_raise",
    "answers_problem",
    "check_status",
    "fixed",
    "in_unit_interval",
    "is_blank",
    "is_not_allowed",
    "is_older_than",
    "item_of",
    "quality_band",
    "row_key",
    "row_quality",
    "sample_hash",
    "token_cost",
]
