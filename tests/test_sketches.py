"""Sketches against exact quantiles."""

import random

import pytest
from pyspark.sql import functions as F

from tenure.operators import sketches
from tenure.operators.quantiles import exact_quantiles, value_counts

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.fixture(scope="module")
def prices(spark):
    rnd = random.Random(4)
    rows = [("wide", rnd.lognormvariate(3, 1)) for _ in range(6000)] + [("few", rnd.choice([10.0, 20.0, 30.0])) for _ in range(3000)]
    rows += [("small", float(i)) for i in range(50)] + [("none", None)]
    df = spark.createDataFrame(rows, "plan string, v double").repartition(6)
    return df.select("plan", F.col("v").cast("decimal(28,6)").alias("monthly_price")).cache()


def test_ranks_are_within_the_stated_error(prices):
    made = sketches.sketched(prices, ["plan"], "monthly_price", 200)
    ranks = sketches.with_true_ranks(prices, ["plan"], "monthly_price", sketches.quantiles(made, PROBS), PROBS).collect()
    assert len(ranks) == 3 * len(PROBS)
    error = sketches.rank_error(200)
    for r in ranks:
        assert r["below"] - error <= r["prob"] <= r["up_to"] + error
    # All values are there: exact up to interpolation.
    small = {r["prob"]: r["answer"] for r in ranks if r["plan"] == "small"}
    assert (small[0.0], small[0.5], small[1.0]) == (0.0, 24.0, 49.0)


def test_parts_merge_to_the_whole(prices):
    parts = sketches.sketched(prices.withColumn("part", F.pmod(F.hash("monthly_price"), F.lit(7))), ["plan", "part"], "monthly_price")
    whole = {r["plan"]: r for r in sketches.describe(sketches.merged(parts, ["plan"])).collect()}
    exact = {r["plan"]: r for r in exact_quantiles(value_counts(prices, ["plan"], F.col("monthly_price")), ["plan"], (0.25, 0.5, 0.75)).collect()}
    assert set(whole) == {"wide", "few", "small"}
    answers = sketches.quantiles(sketches.merged(parts, ["plan"]), PROBS)
    error = sketches.rank_error()
    for r in sketches.with_true_ranks(prices, ["plan"], "monthly_price", answers, PROBS).collect():
        assert r["below"] - error <= r["prob"] <= r["up_to"] + error
    assert whole["few"]["count"] == 3000 and whole["few"]["median"] == exact["few"]["q_1"]
    assert whole["wide"]["median"] == pytest.approx(exact["wide"]["q_1"], rel=0.05)


def test_the_size_follows_the_error():
    assert sketches.rank_error(sketches.k_for(0.01)) <= 0.01 < sketches.rank_error(sketches.k_for(0.01) - 1)
    with pytest.raises(ValueError, match="no sketch"):
        sketches.k_for(1e-9)


def test_a_table_without_values_has_no_sketch(spark):
    df = spark.createDataFrame([("a", None)], "plan string, v double")
    assert sketches.sketched(df, ["plan"], "v").collect() == [] and sketches.sketched(df, [], "v").collect() == []
