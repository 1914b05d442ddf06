"""Counters observed while writing equal aggregates over what was written."""

import pytest
from pyspark.sql import functions as F

from tenure.errors import DataQualityError
from tenure.operators.observed import nulls, staged_with
from tenure.operators.staging import staged
from tenure.plans import clean, explore

ROWS = [
    ("C1", "2024-02-01", "2024-03-01", "basic", "10"),
    ("C1", "2024-04-01", "2024-03-01", None, "ten"),
    ("C9", "", None, "pro", "10"),
    ("C1", "soon", "never", "pro", "x"),
]


def test_rule_hits_and_nulls(spark, raw_subs):
    reference = spark.sql("SELECT 'C1' AS customer_id, DATE'2024-01-01' AS signup_date")
    out = clean.clean_subscriptions(raw_subs(*ROWS), reference=reference, policy="lenient", stage=staged)
    counted = {r["rule_id"]: r["hits"] for r in clean.subscription_rule_counts(out.stated).collect()}
    assert {k: out.counts[k] for k in counted} == counted and counted["end_before_start"] == 1
    profile = {r["column_name"]: r["nulls"] for r in explore.null_profile(out.stated.select(*clean.PROFILED)).collect()}
    assert {c: out.counts[f"nulls_{c}"] for c in clean.PROFILED} == profile
    assert out.counts["rows"] == len(ROWS)


def test_the_gate_needs_no_second_scan(spark, raw_subs, monkeypatch):
    reference = spark.sql("SELECT 'C1' AS customer_id, DATE'2024-01-01' AS signup_date")
    monkeypatch.setattr(clean.Q, "examples", lambda *a: spark.createDataFrame([], "rule_id string, rank int, customer_id string, detail string"))
    seen = []
    cls = type(spark.range(1))
    agg = cls.agg
    monkeypatch.setattr(cls, "agg", lambda self, *c: (seen.append(c), agg(self, *c))[1])
    with pytest.raises(DataQualityError, match="malformed_start_date: 1 rows"):
        clean.clean_subscriptions(raw_subs(*ROWS), reference=reference, policy="strict", stage=staged)
    assert not any("count_if" in str(c) for c in seen)


@pytest.mark.parametrize("rows", [0, 5])
def test_plain_tables_and_empty_ones(spark, rows):
    df = spark.range(rows).select(F.when(F.col("id") > 1, F.col("id")).alias("x"))
    for given in (df, df.where("false"), df.limit(0)):
        written, counts = staged_with(staged, given, "some", nulls(["x"]))
        assert counts == {"rows": written.count(), "nulls_x": written.where("x IS NULL").count()}
