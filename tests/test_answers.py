import math

import pytest
from pyspark.sql import functions as F

from qualitygate.functions import (
    answer_problem,
    answer_text,
    answer_unit,
    fixed,
    in_unit_interval,
    item_of,
    quality_band,
    row_quality,
    token_cost,
)
from qualitygate.spec import ANSWERS, CHOICE, NOUL, SCORE, Question

NAN = float("nan")


def item(kind, noul=None, choice=None, score=None, confidence=1.0):
    return ("k", kind, noul, choice, score, confidence)


def one(spark, answers, column):
    df = spark.createDataFrame([(answers,)], f"answers {ANSWERS.simpleString()}")
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "answer,unit",
    [
        (item(NOUL, noul=0.3), 0.3),
        (item(NOUL), 0.0),
        (item(SCORE, score=1.0), 0.0),
        (item(SCORE, score=5.0), 1.0),
        (item(SCORE, score=3.5), 0.625),
        (item(SCORE, score=9.0), 1.0),
        (item(SCORE, score=-2.0), 0.0),
        (item(SCORE), 0.0),
        (item(SCORE, score=NAN), 1.0),
        (item(CHOICE, choice="x", confidence=0.4), 0.4),
        (item("other", noul=0.9), 0.0),
    ],
)
def test_unit(spark, answer, unit):
    assert one(spark, {"k": answer}, answer_unit(item_of("k"))) == unit


def test_unit_follows_the_rubric_length(spark):
    got = one(spark, {"k": item(SCORE, score=2.0)}, answer_unit(item_of("k"), 3))
    assert got == 0.5
    with pytest.raises(ValueError):
        answer_unit(item_of("k"), 1)


def test_quality_renormalises_over_present_keys(spark):
    weights = {"a": 0.5, "b": 0.2, "it's": 0.3}
    full = {"a": item(NOUL, noul=0.8), "b": item(NOUL, noul=0.1), "it's": item(SCORE, score=4.0), "extra": item(NOUL, noul=1.0)}
    want = (0.5 * 0.8 + 0.2 * 0.1 + 0.3 * 0.75) / (0.5 + 0.2 + 0.3)
    assert one(spark, full, row_quality(weights)) == want
    part = {k: v for k, v in full.items() if k != "b"}
    assert one(spark, part, row_quality(weights)) == (0.5 * 0.8 + 0.3 * 0.75) / (0.5 + 0.3)
    assert one(spark, {"extra": item(NOUL, noul=1.0)}, row_quality(weights)) == 0.0
    assert one(spark, {}, row_quality({})) == 0.0
    assert one(spark, None, row_quality(weights)) == 0.0
    short = row_quality({"s": 1.0}, [Question("s", SCORE, levels=("a", "b", "c"))])
    assert one(spark, {"s": item(SCORE, score=2.0)}, short) == 0.5


@pytest.mark.parametrize(
    "answer,bad",
    [
        (item(NOUL, noul=0.0), None),
        (item(NOUL, noul=1.0), None),
        (item(NOUL), None),
        (item(NOUL, noul=1.2), "noul"),
        (item(NOUL, noul=-0.1), "noul"),
        (item(NOUL, noul=NAN), "noul"),
        (item(SCORE, score=99.0), None),
        (item(CHOICE, confidence=1.01), "confidence"),
    ],
)
def test_validation(spark, answer, bad):
    got = one(spark, {"k": answer}, answer_problem(item_of("k")))
    assert (got is None) if bad is None else got.startswith(bad)


def test_unit_interval(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (1.0001,), (NAN,), (-math.inf,)], "x double")
    assert [r[0] for r in df.select(in_unit_interval(F.col("x"))).collect()] == [True, True, True, False, False, False]


def test_text_matches_python_formatting(spark):
    values = [0.125, 0.375, 0.145, 0.005, 0.994999, 1.0, 0.0, -0.001, 12.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(fixed(F.col("v"), 2)).collect()]
    assert got == [f"{v:.2f}" for v in values]
    assert one(spark, {"k": item(SCORE, score=2.25)}, answer_text(item_of("k"))) == f"{2.25:.1f}"
    assert one(spark, {"k": item(CHOICE, choice="red")}, answer_text(item_of("k"))) == "red"
    assert one(spark, {"k": item(NOUL, noul=0.125)}, answer_text(item_of("k"))) == "0.12"


def test_cost_and_band(spark):
    df = spark.createDataFrame([(0.7, 500.0), (0.69, None), (0.5, 0.0), (0.1, 2e6)], "q double, t double")
    got = df.select(quality_band(F.col("q")), token_cost(F.col("t"), 0.042)).collect()
    assert [r[0] for r in got] == ["green", "yellow", "yellow", "red"]
    assert [r[1] for r in got] == [500 / 1e6 * 0.042, 0.0, 0.0, 2e6 / 1e6 * 0.042]
