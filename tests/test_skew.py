"""One customer with a third of all rows: the plans must split it and lose nothing."""

import pytest
from pyspark.sql import functions as F

from tenure.operators.sequences import customer_days
from tenure.operators.staging import staged
from tenure.plans import clean, metrics
from tenure.plans.load import load_subscriptions
from tenure.session import shuffle_partitions

ROWS = 60_000


@pytest.fixture
def eager_splitting(spark):
    """Thresholds low enough for a test; joins may not broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(spark):
    customer = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 500))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int"))
    return spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("row_id"),
        customer.alias("customer_id"),
        start.cast("string").alias("start_date"),
        F.date_add(start, (F.hash("id") % 20 + 20).cast("int")).cast("string").alias("end_date"),
        F.lit("basic").alias("plan"),
        (F.col("id") % 50).cast("string").alias("monthly_price"),
    )


@pytest.fixture
def people(skewed):
    names = skewed.select("customer_id").distinct()
    return staged(names.withColumn("signup_date", F.lit("2024-01-01").cast("date")), "people")


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_rows_of_a_join_are_split(spark, eager_splitting, skewed, people):
    loaded = load_subscriptions(skewed, people).rows
    assert len(loaded.collect()) == ROWS
    assert "skew=true" in final_plan(loaded)


def test_splitting_also_happens_below_an_aggregate_on_the_same_key(spark, eager_splitting, skewed, people):
    days = customer_days(load_subscriptions(skewed, people).rows)
    rows = days.collect()
    assert "skew=true" in final_plan(days)
    assert max(sum(r["customer_id"] == name for r in rows) for name in ("hot", "c1")) <= 300


def test_metrics_do_not_depend_on_the_splitting(spark, skewed, people, request):
    def all_metrics():
        subs = load_subscriptions(skewed, people).rows
        return [
            sorted(map(tuple, df.collect()))
            for df in (metrics.monthly_mrr(subs), metrics.monthly_churn(subs), metrics.cohort_retention(people, subs), metrics.active_customers(subs))
        ]

    plain = all_metrics()
    request.getfixturevalue("eager_splitting")
    assert all_metrics() == plain


def test_every_customer_lookup_can_be_split(spark, eager_splitting, skewed, people):
    standard = clean.standardise_subscriptions(skewed)
    removed = people.where("customer_id = 'c1'").select("customer_id")
    stated = clean.with_customer_state(standard, people, removed, stage=staged)
    states = {r["customer_state"]: r["n"] for r in stated.groupBy("customer_state").agg(F.count("*").alias("n")).collect()}
    assert sum(states.values()) == ROWS and set(states) == {"known", "excluded"}
    stated.collect()
    assert "skew=true" in final_plan(stated)


def test_copies_of_one_customer_row_are_split(spark, eager_splitting, skewed):
    bronze = skewed.select("row_id", "customer_id", F.col("start_date").alias("signup_date"), F.col("plan").alias("country"))
    again = clean.duplicate_customers(clean.standardise_customers(bronze))
    assert len(again.collect()) == ROWS - bronze.select("customer_id").distinct().count()
    assert "skew=true" in final_plan(again)


def test_shuffles_grow_with_the_input():
    assert shuffle_partitions(1 << 20, 8) == 8
    assert shuffle_partitions(1 << 40, 8) == 4096
    # No upper bound: partitions stay of one size at any input.
    assert shuffle_partitions(100 * 10**12, 8) == 372_530
