from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest

from tenure.config import DEFAULTS
from tenure.errors import DataQualityError
from tenure.operators import findings
from tenure.operators.staging import staged
from tenure.plans import clean, gold
from tenure.plans.clean import clean_subscriptions

GOOD = ("C1", "2024-01-01", "2024-02-01", "basic", "30")


def rules(df):
    return sorted(r["rule_id"] for r in df.collect())


def test_valid_rows_pass(raw_subs):
    rows = clean_subscriptions(raw_subs(GOOD, ("C2", "2024-01-01", "", "pro", "50"), ("C2", "2024-02-01", None, "pro", "50"))).rows
    assert rows.count() == 3
    assert rows.columns == list(clean.SILVER_COLUMNS)


def test_text_fields_are_cleaned(raw_subs):
    row = clean_subscriptions(raw_subs((" C1 ", " 2024-01-01 ", " ", "baisc ", " thirty"))).rows.first()
    assert (row["customer_id"], row["start_date"], row["end_date"], row["plan"], row["monthly_price"]) == (
        "C1",
        date(2024, 1, 1),
        None,
        "basic",
        Decimal(30),
    )


def test_plan_case_is_kept(raw_subs):
    assert clean_subscriptions(raw_subs(("C1", "2024-01-01", "", "Pro", "1"))).rows.first()["plan"] == "Pro"


@pytest.mark.parametrize(
    ("row", "rule"),
    [
        (("", "2024-01-01", "", "basic", "30"), "empty_customer_id"),
        (("C1", " ", "", "basic", "30"), "empty_start_date"),
        (("C1", "not-a-date", "", "basic", "30"), "malformed_start_date"),
        (("C1", "2024-01-01", "", "basic", "forty-five"), "non_numeric_price"),
        (("C1", "2024-01-01", "", "basic", None), "non_numeric_price"),
        (("C1", "2024-02-01", "2024-01-01", "basic", "30"), "end_before_start"),
    ],
)
def test_fatal_rules(raw_subs, row, rule):
    bronze = raw_subs(GOOD, row)
    with pytest.raises(DataQualityError, match=rule):
        clean_subscriptions(bronze)
    lenient = clean_subscriptions(bronze, policy="lenient")
    assert lenient.rows.count() == 1
    assert rule in rules(lenient.warnings)


def test_all_fatal_rules_are_reported_together(raw_subs):
    bronze = raw_subs(("", "2024-01-01", "", "basic", "30"), ("C1", "never", "", "basic", "30"), ("C2", "2024-01-01", "", "basic", "x"))
    with pytest.raises(DataQualityError) as error:
        clean_subscriptions(bronze)
    for rule in ("empty_customer_id: 1 rows", "malformed_start_date: 1 rows", "non_numeric_price: 1 rows"):
        assert rule in str(error.value)


def test_same_day_end_is_valid(raw_subs):
    assert clean_subscriptions(raw_subs(("C1", "2024-01-01", "2024-01-01", "basic", "30"))).rows.count() == 1


def test_malformed_end_is_open_and_flagged(raw_subs):
    out = clean_subscriptions(raw_subs(("C1", "2024-01-01", "2024-02-30", "basic", "30")))
    row = out.rows.first()
    assert row["end_date"] is None and row["end_date_raw"] == "2024-02-30" and row["end_date_malformed"]
    assert rules(out.warnings) == ["malformed_end_date"]


def reference(customers, ids):
    return customers(*ids).select("customer_id", "signup_date")


def test_unknown_and_excluded_customers_are_dropped(raw_subs, customers, ids):
    bronze = raw_subs(GOOD, ("C2", "2024-01-01", "", "basic", "30"), ("C9", "2024-01-01", "", "basic", "30"))
    known = reference(customers, [("C1", "2024-01-01"), ("C2", "2024-01-01")])
    out = clean_subscriptions(bronze, reference=known, excluded=ids("C2"))
    assert [r["customer_id"] for r in out.rows.collect()] == ["C1"]
    assert rules(out.warnings) == ["excluded_customer", "unknown_customer"]
    only_excluded = clean_subscriptions(bronze, excluded=ids("C2"))
    assert sorted(r["customer_id"] for r in only_excluded.rows.collect()) == ["C1", "C9"]


def test_no_reference_means_no_filter_and_an_empty_one_drops_all(raw_subs, customers):
    assert clean_subscriptions(raw_subs(GOOD)).rows.count() == 1
    empty = reference(customers, [("C1", "2024-01-01")]).limit(0)
    assert clean_subscriptions(raw_subs(GOOD), reference=empty).rows.count() == 0


def test_start_before_signup(raw_subs, customers):
    known = reference(customers, [("C1", "2024-01-02")])
    with pytest.raises(DataQualityError, match="start_before_signup"):
        clean_subscriptions(raw_subs(GOOD), reference=known)
    lenient = clean_subscriptions(raw_subs(GOOD), reference=known, policy="lenient")
    assert lenient.rows.count() == 1 and rules(lenient.warnings) == ["start_before_signup"]


def test_overlap_policy(raw_subs):
    bronze = raw_subs(GOOD, ("C1", "2024-02-01", "", "basic", "30"))
    assert rules(clean_subscriptions(bronze).warnings) == ["overlap"]
    with pytest.raises(DataQualityError, match="overlap: 1 rows"):
        clean_subscriptions(bronze, overlap_policy="strict")
    with pytest.raises(ValueError, match="overlap_policy"):
        clean_subscriptions(bronze, overlap_policy="ignore")


def test_range_policy_opens_the_end(raw_subs):
    bronze = raw_subs(("C1", "2024-02-01", "2024-01-01", "basic", "30"))
    out = clean_subscriptions(bronze, range_policy="null_end")
    assert out.rows.first()["end_date"] is None and rules(out.warnings) == ["end_before_start"]
    with pytest.raises(ValueError, match="range_policy"):
        clean_subscriptions(bronze, range_policy="swap")


def test_flag_policy_keeps_the_rows(raw_subs):
    bronze = raw_subs(GOOD, ("C1", "never", "", "basic", "x"))
    out = clean_subscriptions(bronze, policy="flag")
    assert out.rows.count() == 2
    assert rules(out.warnings) == ["malformed_start_date", "non_numeric_price"]


def test_staging_does_not_change_results(raw_subs, customers):
    bronze = raw_subs(GOOD, ("C9", "2024-01-01", "", "basic", "30"))
    known = reference(customers, [("C1", "2024-01-01")])
    plain, stored = (clean_subscriptions(bronze, reference=known, stage=s) for s in (None, staged))
    assert plain.rows.collect() == stored.rows.collect()
    assert rules(plain.warnings) == rules(stored.warnings)


def test_further_missing_value_words(raw_subs):
    settings = replace(DEFAULTS, na_values=("", "N/A"))
    row = clean_subscriptions(raw_subs(("C1", "2024-01-01", "N/A", "basic", "1")), settings=settings).rows.first()
    assert row["end_date_raw"] is None and not row["end_date_malformed"]


def priced(raw_subs, *prices):
    return clean_subscriptions(raw_subs(*[("C1", f"2024-01-{i + 1:02d}", f"2024-01-{i + 1:02d}", "basic", p) for i, p in enumerate(prices)])).rows


def test_outliers(raw_subs):
    out = clean.price_outliers(priced(raw_subs, "10", "11", "12", "13", "100")).collect()
    assert [float(r["monthly_price"]) for r in out] == [100.0]
    assert (out[0]["lower_bound"], out[0]["upper_bound"]) == (8.0, 16.0)


def test_no_outliers_for_few_or_equal_prices(raw_subs):
    assert clean.price_outliers(priced(raw_subs, "1", "1", "100")).count() == 0
    assert clean.price_outliers(priced(raw_subs, "5", "5", "5", "5", "5", "100")).count() == 0


def test_plan_price_spread(raw_subs):
    out = clean.plan_price_spread(priced(raw_subs, "10", "10.0", "12")).collect()
    assert [(r["plan"], r["rows"], r["distinct_prices"], r["min_price"], r["max_price"]) for r in out] == [("basic", 3, 2, 10.0, 12.0)]
    assert clean.plan_price_spread(priced(raw_subs, "10", "10")).count() == 0


def test_examples_keep_the_first_rows_per_rule(raw_subs):
    bronze = raw_subs(*[("C1", "never", "", "basic", "x")] * 9)
    warnings = clean_subscriptions(bronze, policy="lenient").warnings
    shown = findings.examples(warnings, 5).collect()
    assert sorted((r["rule_id"], r["row_id"]) for r in shown) == [
        (rule, i) for rule in ("malformed_start_date", "non_numeric_price") for i in range(5)
    ]


def test_quarantine_names_the_first_broken_rule(raw_subs, customers, ids):
    bronze = raw_subs(
        GOOD,
        ("C2", "x", "", "basic", "1"),
        ("C9", "x", "", "basic", "1"),
        ("C1", "x", "", "basic", "y"),
        ("C1", "2024-01-01", "", "basic", "-1"),
        ("C1", "2024-01-01", "2023-01-01", "basic", "-1"),
    )
    stated = clean.with_customer_state(
        clean.standardise_subscriptions(bronze), reference(customers, [("C1", "2024-01-01")]), ids("C2")
    )
    out = {r["row_id"]: (r["rule_id"], r["is_customer_missing"]) for r in gold.quarantine(stated).collect()}
    assert out == {
        1: ("excluded_customer", True),
        2: ("unknown_customer", True),
        3: ("malformed_start_date", False),
        4: ("negative_price", False),
        5: ("end_before_start", False),
    }
