from datetime import date

import pytest

from tenure.errors import DataQualityError
from tenure.plans import explore, gold
from tenure.plans.clean import repair_date_ranges
from tenure.schemas import SILVER_CUSTOMERS, require_types


def test_null_profile(subs):
    out = {r["column_name"]: (r["nulls"], r["rows"]) for r in explore.null_profile(subs(("a", "2024-01-01", None, 1), ("a", "2024-01-01", "2024-01-02", 1))).collect()}
    assert out["end_date"] == (1, 2) and out["customer_id"] == (0, 2)


def test_country_variants(raw_customers):
    df = raw_customers(("1", "d", "NL"), ("2", "d", " nl"), ("3", "d", "DE"), ("4", "d", "fr "), ("5", "d", None))
    out = sorted((r["country_cleaned"], r["country"], r["customers"]) for r in explore.country_variants(df).collect())
    assert out == [("FR", "fr ", 1), ("NL", " nl", 1), ("NL", "NL", 1)]
    assert {r["country"]: r["customers"] for r in explore.country_counts(df).collect()}[None] == 1


def test_multi_active(subs):
    df = subs(("a", "2024-01-01", None, 1), ("a", "2030-01-01", "2024-06-01", 1), ("b", "2024-01-01", "2024-05-31", 1), ("b", "2024-01-01", None, 1))
    assert [tuple(r) for r in explore.multi_active_customers(df, "2024-06-01").collect()] == [("a", 2)]
    assert sorted(r["row_id"] for r in explore.multi_active_details(df, "2024-06-01").collect()) == [0, 1]


def test_gap_reports(subs):
    df = subs(
        ("a", "2024-01-01", "2024-01-31", 1), ("a", "2024-03-01", "2024-03-10", 1), ("a", "2024-03-05", None, 1), ("b", "2024-01-01", None, 1)
    )
    assert sorted((r["row_id"], r["gap_days"]) for r in explore.subscription_gaps(df).collect()) == [(0, 30), (1, -5), (2, None), (3, None)]
    assert [r["row_id"] for r in explore.gaps_exactly(df, 30).collect()] == [0]
    stats = explore.gap_stats(df).first()
    assert (stats["count"], stats["min"], stats["max"]) == (2, -5.0, 30.0)
    shares = explore.resubscription_shares(df).first()
    assert (shares["within_grace"], shares["gaps"], shares["within_grace_pct"], shares["open_ends_pct"]) == (2, 2, 100.0, 50.0)
    assert sum(r["n"] for r in explore.gap_histogram(df).collect()) == 2


def test_shares_without_gaps(subs):
    row = explore.resubscription_shares(subs(("a", "2024-01-01", None, 1))).first()
    assert row["within_grace_pct"] == 0.0 and row["open_ends_pct"] == 100.0


def test_durations(subs):
    df = subs(("a", "2024-01-01", "2024-01-01", 1), ("a", "2024-01-01", None, 1))
    assert [r["duration_days"] for r in explore.subscription_duration(df, "2024-02-01").orderBy("row_id").collect()] == [0, 31]
    assert explore.duration_stats(df, "2024-02-01").first()["mean"] == 15.5
    assert explore.duration_histogram(df, "2024-02-01").count() == 20


def test_cohorts(customers, subs):
    people = customers(*[(f"c{i}", "2024-01-05") for i in range(5)], ("x", "2024-02-01"))
    assert {r["cohort_month"]: r["cohort_size"] for r in explore.cohort_sizes(people).collect()} == {"2024-01": 5, "2024-02": 1}
    assert [r["cohort_month"] for r in explore.tiny_cohorts(people).collect()] == ["2024-02"]
    out = explore.cohort_retention_exploratory(people, subs(("c1", "2024-01-05", None, 1), ("c2", "2024-01-05", None, 1), ("c2", "2024-01-06", None, 1)))
    assert {r["cohort_month"]: r["retention_rate"] for r in out.collect()} == {"2024-01": 0.4, "2024-02": 0.0}


def test_price_filters(subs):
    df = subs(("a", "2024-01-01", None, 0), ("a", "2024-01-01", None, -1), ("a", "2024-01-01", None, 1))
    assert [r["row_id"] for r in explore.zero_prices(df).collect()] == [0]
    assert [r["row_id"] for r in explore.negative_prices(df).collect()] == [1]


def test_repair(subs):
    out = repair_date_ranges(subs(("a", "2024-02-01", "2024-01-01", 1), ("a", "2024-02-01", "2024-02-01", 1), ("a", "2024-02-01", None, 1)))
    assert [(r["end_date"], r["repaired"]) for r in out.orderBy("row_id").collect()] == [
        (None, True),
        (date(2024, 2, 1), False),
        (None, False),
    ]


def test_enriched(customers, subs):
    out = gold.subscription_enriched(
        customers(("a", "2024-01-01")),
        subs(("a", "2024-01-31", "2024-03-01", 1), ("a", "2024-04-01", None, 1), ("z", "2024-01-01", "2024-01-10", 1)),
        "2024-05-01",
    )
    rows = {r["row_id"]: r for r in out.collect()}
    assert (rows[0]["months_active"], rows[0]["subscription_duration_days"], rows[0]["is_active"], rows[0]["is_churned"]) == (3, 30, False, True)
    assert (rows[1]["months_active"], rows[1]["is_active"], rows[1]["is_churned"]) == (2, True, False)
    assert rows[2]["customer_country"] is None and rows[2]["is_churned"]


def test_arpu(subs):
    out = gold.monthly_arpu(subs(("a", "2024-01-01", "2024-01-31", 10), ("a", "2024-01-05", "2024-01-31", 5), ("b", "2024-03-01", None, 8))).orderBy("month").collect()
    assert [tuple(r) for r in out] == [("2024-01", 15.0, 1, 15.0), ("2024-02", 0.0, 0, None), ("2024-03", 8.0, 1, 8.0)]


def test_type_gate(customers, raw_customers):
    require_types(customers(("a", "2024-01-01")), SILVER_CUSTOMERS, "customers")
    with pytest.raises(DataQualityError, match="signup_date"):
        require_types(raw_customers(("a", "2024-01-01", "NL")), SILVER_CUSTOMERS, "customers")
