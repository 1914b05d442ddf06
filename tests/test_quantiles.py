import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenure.operators.quantiles import describe, describe_days, exact_quantiles, histogram, value_counts


def prices(spark, pairs):
    return spark.createDataFrame(
        [(g, None if v is None else Decimal(str(v))) for g, v in pairs], "g STRING, monthly_price DECIMAL(28,6)"
    )


@pytest.mark.parametrize("n", [1, 2, 5, 500])
def test_quantiles_are_exact(spark, n):
    rng = random.Random(n)
    pairs = [("a", round(rng.uniform(-1e4, 1e11), 6)) for _ in range(n)] + [("b", 7.5)] * n
    df = prices(spark, pairs)
    counts = value_counts(df, ["g"], F.col("monthly_price"))
    out = {r["g"]: r for r in exact_quantiles(counts, ["g"], (0.25, 0.5, 0.9)).collect()}
    expected = np.quantile([v for g, v in pairs if g == "a"], [0.25, 0.5, 0.9])
    assert [out["a"][f"q_{i}"] for i in range(3)] == pytest.approx(expected, rel=1e-9)
    assert [out["b"][f"q_{i}"] for i in range(3)] == [7.5] * 3
    assert out["a"]["size"] == n


def test_quantiles_without_groups_and_without_values(spark):
    counts = value_counts(prices(spark, [("a", 1), ("b", 2), ("b", None)]), [], F.col("monthly_price"))
    row = exact_quantiles(counts, [], (0.5,)).first()
    assert (row["size"], row["q_0"]) == (2, 1.5)
    empty = value_counts(prices(spark, [("a", None)]), [], F.col("monthly_price"))
    assert exact_quantiles(empty, [], (0.5,)).count() == 0


def test_describe(spark):
    values = [10, 20, 20, 35.5]
    row = describe(prices(spark, [("a", v) for v in values] + [("a", None), (None, 5)]), ["g"], "monthly_price").first()
    assert row["count"] == 4 and row["min"] == 10 and row["max"] == 35.5
    assert row["mean"] == pytest.approx(np.mean(values)) and row["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-6)
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))


def test_describe_days(spark):
    values = [-17, 0, 0, 4, 15]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "d INT")
    row = describe_days(df, "d").first()
    assert row["count"] == 5 and row["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-6)
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))
    assert describe_days(df.where("d IS NULL"), "d").count() == 0
    assert describe_days(df.where("d = 4"), "d").first()["std"] is None


@pytest.mark.parametrize("values", [[1, 2, 2, 3, 9, 10], [5, 5, 5], [0, 1]])
def test_histogram_matches_numpy(spark, values):
    counts = value_counts(spark.createDataFrame([(v,) for v in values], "v INT"), [], F.col("v"))
    out = histogram(counts, 10).orderBy("bin").collect()
    expected, edges = np.histogram(values, bins=10)
    assert [r["n"] for r in out] == list(expected)
    assert [r["lower"] for r in out] == pytest.approx(edges[:-1], abs=1e-6)
    assert [r["upper"] for r in out] == pytest.approx(edges[1:], abs=1e-6)


def test_histogram_of_nothing(spark):
    assert histogram(spark.createDataFrame([], "value INT, n BIGINT"), 10).count() == 0
