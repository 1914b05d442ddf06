"""Histories stored by customer: the same results, without a shuffle of ordinary customers."""

import random
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from typed import SUBSCRIPTION_TYPES

from tenure.config import DEFAULTS
from tenure.operators import clustered, sequences
from tenure.plans import metrics, stored

SMALL = replace(DEFAULTS, hot_rows=60)


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    rnd = random.Random(8)
    rows = []
    for i in range(600):
        start = date(2024, 1, 1) + timedelta(days=rnd.randrange(200))
        end = start + timedelta(days=rnd.randrange(90)) if rnd.random() < 0.8 else None
        rows.append((i, "C0" if i % 3 == 0 else f"C{rnd.randrange(1, 40)}", start, end, "basic", 10))
    plain = spark.createDataFrame(rows, SUBSCRIPTION_TYPES.replace("DECIMAL(28,6)", "INT")).repartition(3)
    folder = str(tmp_path_factory.mktemp("stored"))
    plain.write.parquet(f"{folder}/plain")
    plain = spark.read.parquet(f"{folder}/plain")
    people = plain.groupBy("customer_id").agg(F.min("start_date").alias("signup_date"), F.min("row_id").alias("row_id")).select("row_id", "customer_id", "signup_date")
    people.write.parquet(f"{folder}/people")
    return {
        "folder": folder,
        "plain": plain,
        "subs": clustered.write_clustered(plain, f"{folder}/subs", ("start_date", "row_id"), 5, SMALL),
        "people": clustered.write_clustered(spark.read.parquet(f"{folder}/people"), f"{folder}/customers", buckets=5),
    }


PLANS = {
    "gaps": (lambda h: stored.gaps(h["subs"], SMALL), lambda h: sequences.gaps(h["plain"])),
    "overlaps_adjacent": (lambda h: stored.overlaps_adjacent(h["subs"], SMALL), lambda h: sequences.overlaps_adjacent(h["plain"])),
    "overlaps_running_max": (lambda h: stored.overlaps_running_max(h["subs"], SMALL), lambda h: sequences.overlaps_running_max(h["plain"])),
    "churn_events": (lambda h: stored.churn_events(h["subs"], SMALL), lambda h: metrics.churn_events(h["plain"])),
    "monthly_churn": (lambda h: stored.monthly_churn(h["subs"], SMALL), lambda h: metrics.monthly_churn(h["plain"])),
    "retention": (
        lambda h: stored.with_retained(h["people"].ordinary, h["subs"], SMALL),
        lambda h: metrics.with_retained(h["people"].ordinary, h["plain"]),
    ),
}


def rows_of(df):
    return Counter(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("name", PLANS)
def test_same_rows_as_from_a_plain_table(history, name):
    by_customer, plain = PLANS[name]
    assert rows_of(by_customer(history)) == rows_of(plain(history))


ORDINARY = {
    "gaps": lambda h, s: sequences.gaps(h["subs"].ordinary, s),
    "overlaps_adjacent": lambda h, s: sequences.overlaps_adjacent(h["subs"].ordinary, s),
    "overlaps_running_max": lambda h, s: sequences.overlaps_running_max(h["subs"].ordinary, s),
    "churn_events": lambda h, s: metrics.churn_events(h["subs"].ordinary, s),
    "retention": lambda h, s: metrics.with_retained(h["people"].ordinary, h["subs"].ordinary, s),
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ORDINARY)
def test_ordinary_customers_are_not_shuffled(spark, history, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ORDINARY[name](history, replace(SMALL, hot_rows=clustered.NEVER)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(customer_id" in plan_of(metrics.churn_events(history["plain"]))


def test_hot_customers_are_apart_and_split(spark, history):
    assert {r[0] for r in history["subs"].hot.select("customer_id").distinct().collect()} == {"C0"}
    assert history["subs"].ordinary.where("customer_id = 'C0'").count() == 0
    assert "_block" in plan_of(sequences.gaps(history["subs"].hot, SMALL))


def test_a_later_session_finds_the_buckets(spark, history):
    again = clustered.open_clustered(spark, f"{history['folder']}/subs")
    assert again.buckets == 5 and rows_of(clustered.read_whole(spark, f"{history['folder']}/subs")) == rows_of(history["plain"])
    assert "Exchange" not in plan_of(metrics.churn_events(again.ordinary))


def test_an_empty_table(spark, history, tmp_path):
    none = clustered.write_clustered(history["plain"].limit(0), str(tmp_path), buckets=2)
    assert stored.gaps(none).collect() == [] and clustered.read_whole(spark, str(tmp_path)).count() == 0
