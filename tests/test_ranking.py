import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from qualitygate.operators.metrics import nearest_rank
from qualitygate.plans import first_by, ranking, value_at_rank
from tests.conftest import rows


def at_percent(values, percent):
    """The value whose place is the nearest to ``percent`` of the way from first to last, halves to the even place."""
    place = (Decimal(str(percent)) / 100 * (len(values) - 1)).quantize(Decimal(1), rounding=ROUND_HALF_EVEN)
    return sorted(values)[int(place)]


@pytest.mark.parametrize("window_rows", [1_000_000, 20])
def test_value_at_rank_equals_brute_force(spark, window_rows):
    rng = random.Random(5)
    groups = {
        "even": [rng.random() for _ in range(5000)],
        "tied": [7.0] * 3000 + [rng.random() * 20 for _ in range(2000)],
        "same": [3.0] * 400,
        "wide": [10.0 ** rng.uniform(-8, 8) * rng.choice([-1, 1]) for _ in range(3000)],
        "two": [1.0, 2.0],
        "one": [4.0],
    }
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("even", None), ("void", None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    percents = (0, 1, 50, 95, 99.9, 100)
    got = value_at_rank(df, ["g"], "v", {f"p{i}": nearest_rank(p) for i, p in enumerate(percents)}, window_rows)
    want = [(g, *[at_percent(vs, p) for p in percents]) for g, vs in groups.items()]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 26, 59])
def test_half_to_even(spark, n):
    df = spark.range(n).select(F.col("id").cast("double").alias("v"))
    got = value_at_rank(df, [], "v", {"p50": nearest_rank(50), "p95": nearest_rank(95)})
    assert rows(got) == [(at_percent(range(n), 50), at_percent(range(n), 95))]


def test_no_values_no_row(spark):
    df = spark.range(0).select(F.lit(1.0).alias("v"))
    assert rows(value_at_rank(df, [], "v", {"p50": nearest_rank(50)})) == []


def brute_first(data, k):
    out = []
    for g in {r[0] for r in data}:
        part = [r for r in data if r[0] == g]
        part.sort(key=lambda r: tuple((x is None, x or "") for x in r[1:]))
        out += part[: k(len(part))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("rate,small", [(0.29, 100_000), (0.0, 0), (0.29, 0), (0.5, 0), (1.0, 0)])
def test_first_by_equals_brute_force(spark, many_partitions, monkeypatch, rate, small):
    monkeypatch.setattr(ranking, "SMALL_TABLE_ROWS", small)
    rng = random.Random(9)
    data = [("a", f"{rng.randrange(400):03d}", rng.choice("xyz")) for _ in range(900)]
    data += [("a", "200", "hot")] * 500
    data += [("b", None, "n"), ("b", "1", "n"), ("b", "1", None)]
    data += [("c", None, "m"), ("c", None, "l")]
    data += [(None, "5", "x"), (None, "4", "x")]
    df = spark.createDataFrame(data, "g string, id string, t string").repartition(7)
    keep = lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(rate)))
    got = rows(first_by(df, ["g"], "id", ["t"], keep))
    assert got == brute_first(data, lambda n: max(1, int(n * rate)))


def test_hot_copies_spread_over_range_partitions(spark, many_partitions):
    df = spark.range(40_000).select(F.lit("g").alias("g"), F.lit("same").alias("id"))
    tagged = ranking._buckets(df.withColumn("_salt", F.rand(11)), ["g"], [F.col("id"), F.col("_salt")])
    sizes = [r["count"] for r in tagged.groupBy("_bucket").count().collect()]
    assert len(sizes) == 3 and max(sizes) < 20_000


def test_one_group_needs_no_join(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    plan = value_at_rank(df, [], "v", {"p50": nearest_rank(50)})._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
