from datetime import date

import pytest

from tenure.errors import DataQualityError
from tenure.plans.clean import clean_customers, customer_reference, customer_rule_counts


def by_id(df):
    return {r["customer_id"]: r for r in df.collect()}


def rules(df):
    return sorted((r["rule_id"], r["customer_id"] or "") for r in df.collect())


def test_padding_and_duplicates(raw_customers):
    out = clean_customers(
        raw_customers((" C1 ", "2024-01-01", "US"), ("C1", "2024-01-02", "UK"), ("C2", "2024-01-03", "CA"), ("\tC1", "2024-01-04", "NL"))
    )
    rows = by_id(out.rows)
    assert set(rows) == {"C1", "C2"} and rows["C1"]["signup_date"] == date(2024, 1, 1)
    assert rules(out.warnings) == [("duplicate_customer_id", "C1"), ("duplicate_customer_id", "C1")]
    assert out.removed.count() == 0


def test_bad_dates_remove_the_customer(raw_customers):
    out = clean_customers(
        raw_customers(("C1", "2024-01-01", "US"), ("C2", "", "UK"), ("C3", "2024-13-05", "CA"), ("C4", None, "CA"), ("C5", " 2024-02-02 ", "DE"))
    )
    assert set(by_id(out.rows)) == {"C1", "C5"}
    assert sorted(r["customer_id"] for r in out.removed.collect()) == ["C2", "C3", "C4"]
    assert rules(out.warnings) == [
        ("empty_signup_date", "C2"),
        ("empty_signup_date", "C4"),
        ("malformed_signup_date", "C3"),
    ]


def test_first_row_wins_even_when_it_is_malformed(raw_customers):
    out = clean_customers(raw_customers(("C1", "bad", "US"), ("C1", "2024-01-01", "US")))
    assert out.rows.count() == 0 and [r["customer_id"] for r in out.removed.collect()] == ["C1"]


def test_country(raw_customers):
    out = clean_customers(
        raw_customers(("C1", "2024-01-01", " us "), ("C2", "2024-01-01", "Uk  "), ("C3", "2024-01-01", "  cA"), ("C4", "2024-01-01", " "), ("C5", "2024-01-01", None))
    )
    assert {k: r["country"] for k, r in by_id(out.rows).items()} == {"C1": "US", "C2": "UK", "C3": "CA", "C4": None, "C5": None}
    assert rules(out.warnings) == [("missing_country", "C4"), ("missing_country", "C5")]


def test_country_column_is_optional(raw_customers):
    bronze = raw_customers(("C1", "2024-01-01", "US")).drop("country")
    out = clean_customers(bronze)
    assert out.rows.first()["country"] is None and out.warnings.count() == 0


def test_empty_id_is_fatal_under_the_strict_policy(raw_customers):
    bronze = raw_customers(("C1", "2024-01-01", "US"), (" ", "2024-01-01", "US"), (None, "2024-01-01", "US"))
    with pytest.raises(DataQualityError, match="empty_customer_id: 2 rows"):
        clean_customers(bronze, policy="strict")
    out = clean_customers(bronze, policy="lenient")
    assert set(by_id(out.rows)) == {"C1"}
    assert [r for r, _ in rules(out.warnings.where("customer_id = '' OR customer_id IS NULL"))] == ["empty_customer_id"] * 2


def test_full_cleaning_passes_the_strict_gate(raw_customers):
    out = clean_customers(
        raw_customers(
            (" C001 ", "2024-01-01", "us"), ("C002", "2024-02-01", " uk"), ("C002", "2024-02-02", "UK"), ("C003", "invalid", "CA"), ("C004", "2024-04-01", None)
        ),
        policy="strict",
    )
    assert set(by_id(out.rows)) == {"C001", "C002", "C004"}
    assert [r["customer_id"] for r in out.removed.collect()] == ["C003"]


def test_rule_counts(raw_customers):
    bronze = raw_customers(
        ("", "2024-01-01", "US"), (None, "x", "US"), ("C1", "2024-01-01", ""), ("C1", "x", ""), ("C2", "", "US"), ("C3", "x", "US")
    )
    assert {r["rule_id"]: r["hits"] for r in customer_rule_counts(bronze).collect()} == {
        "empty_customer_id": 2,
        "duplicate_customer_id": 1,
        "empty_signup_date": 1,
        "malformed_signup_date": 1,
        "missing_country": 1,
    }


def test_reference_leaves_out_excluded_ids_and_keeps_undated_ones(raw_customers, ids):
    bronze = raw_customers((" C1", "2024-01-01", "US"), ("C1", "2024-02-01", "US"), ("C2", "x", "US"), ("C3", "2024-01-01", "US"))
    out = by_id(customer_reference(bronze, ids("C3")))
    assert {k: r["signup_date"] for k, r in out.items()} == {"C1": date(2024, 1, 1), "C2": None}


def test_missing_columns(raw_customers):
    with pytest.raises(DataQualityError, match="signup_date"):
        clean_customers(raw_customers(("C1", "2024-01-01", "US")).drop("signup_date"))


def test_unknown_policy(raw_customers):
    with pytest.raises(ValueError, match="policy"):
        clean_customers(raw_customers(("C1", "2024-01-01", "US")), policy="harsh")
