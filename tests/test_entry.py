"""Every registered query against its SQL at the smallest scale, and the shape of the plans."""

import re

import oracle_check
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


@pytest.fixture(scope="module")
def duck_large():
    return oracle_check.connect(LARGER)


def test_every_query_has_sql():
    """The training-data operators beyond SQL are tested by brute force in their own folder."""
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert oracle_check.compare(spark, duck, SF_DIR, name) == []


def test_flagship(spark):
    assert entry.entry(spark).columns == ["month", "mrr"]


@pytest.mark.parametrize(
    "name",
    ["monthly_mrr", "monthly_churn", "cohort_retention", "overlaps_running_max", "subscription_gaps", "monthly_arpu", "price_outliers_iqr", "load_subscriptions_warnings"],
)
def test_plans_have_no_python_and_no_cross_product(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["cohort_sizes"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    columns = set(re.findall(r"o_\w+", " ".join(re.findall(r"FileScan parquet \[[^\]]*\]", plan))))
    assert columns == {"o_custkey", "o_orderdate"}


def test_counts_follow_from_the_derived_tables(spark, duck_large):
    """Counted from the order and customer keys, without the library or its SQL."""
    t = entry.Tables(spark, LARGER)
    dated = {k for (k,) in duck_large.execute("SELECT c_custkey FROM customer").fetchall() if k % 97 != 5 and k % 89 != 7}
    # An empty id hides the first row of a customer; those listed twice have one more.
    every = {k for (k,) in duck_large.execute("SELECT c_custkey FROM customer").fetchall()}
    kept = {k for k in every if (k in dated if k % 71 != 9 else k % 50 == 0)}
    assert t.customers.count() == len(kept)
    orders = duck_large.execute("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE o_custkey END FROM orders").fetchall()
    assert t.known.count() == sum(k % 211 != 0 and k % 223 != 0 and c in kept for k, c in orders)


@pytest.mark.parametrize("name", ["dq_customer_rules", "dq_subscription_rules"])
def test_every_rule_but_the_price_range_has_rows_that_break_it(spark, name):
    hits = {r["rule_id"]: r["hits"] for r in entry.queries()[name](spark, LARGER).collect()}
    assert [rule for rule, n in hits.items() if not n] in ([], ["price_out_of_range"])


def test_zero_prices_are_in_the_fixture(spark):
    assert entry.queries()["zero_prices"](spark, LARGER).count() > 0
