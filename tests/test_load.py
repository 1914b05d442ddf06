from datetime import date

import pytest

from tenure.errors import DataQualityError
from tenure.plans.load import load_customers, load_subscriptions, number_lines, overlap_warnings


def messages(df):
    return [r["message"] for r in df.orderBy("row_id", "rule_id").collect()]


def test_duplicate_customers(raw_customers):
    out = load_customers(number_lines(raw_customers(("C1", "2024-01-01", "NL"), ("C1", "2024-01-02", "DE"))))
    assert [r["country"] for r in out.rows.collect()] == ["NL"]
    assert messages(out.warnings) == ["Duplicate customer_id 'C1' at row 3 - skipping"]


def test_the_first_valid_row_of_an_id_wins(raw_customers):
    out = load_customers(raw_customers(("C1", "bad", "NL"), ("C1", "2024-01-02", "DE"), ("C1", "bad", "SE")))
    assert [r["country"] for r in out.rows.collect()] == ["DE"]
    assert sorted((r["row_id"], r["rule_id"]) for r in out.warnings.collect()) == [(0, "invalid_customer"), (2, "duplicate_customer_id")]


@pytest.mark.parametrize("signup", ["2024-13-45", "2024-02-30", "", None])
def test_invalid_signup(raw_customers, signup):
    out = load_customers(raw_customers(("C1", signup, "NL"), ("C2", "2024-01-01", "NL")))
    assert out.rows.count() == 1 and out.warnings.count() == 1


def test_missing_country_is_kept(raw_customers):
    out = load_customers(raw_customers(("C1", "2024-01-01", None), ("C2", "2024-01-01", " nl ")))
    assert {r["customer_id"]: r["country"] for r in out.rows.collect()} == {"C1": "", "C2": "NL"}
    assert messages(out.warnings) == ["Customer 'C1' has missing country - keeping record"]


def test_far_dates(raw_customers):
    out = load_customers(raw_customers(("C1", "1900-01-01", "NL"), ("C2", "2099-12-31", "NL")))
    assert out.rows.count() == 2 and out.warnings.count() == 0


def test_missing_columns(raw_customers, raw_subs, ids):
    with pytest.raises(DataQualityError, match="country"):
        load_customers(raw_customers(("C1", "2024-01-01", "NL")).drop("country"))
    with pytest.raises(DataQualityError, match=r"end_date.*plan"):
        load_subscriptions(raw_subs(("C1", "2024-01-01", "", "basic", "1")).drop("end_date", "plan"), ids("C1"))


def load(raw_subs, ids, *rows):
    return load_subscriptions(number_lines(raw_subs(*rows)), ids("C1", "C2"))


@pytest.mark.parametrize(
    ("row", "rule"),
    [
        (("C9", "2024-01-01", "", "basic", "30"), "unknown_customer"),
        ((None, "2024-01-01", "", "basic", "30"), "unknown_customer"),
        ((" C1", "2024-01-01", "", "basic", "30"), "unknown_customer"),
        (("C1", "", "", "basic", "30"), "invalid_start_date"),
        (("C1", "2024-02-30", "", "basic", "30"), "invalid_start_date"),
        (("C1", "2024-01-01", "", "basic", "thirty"), "non_numeric_price"),
        (("C1", "2024-01-01", "", "basic", "fifty five"), "non_numeric_price"),
        (("C1", "2024-01-01", "", "basic", None), "non_numeric_price"),
        (("C1", "2024-01-01", "", "basic", "-30.0"), "negative_price"),
        (("C1", "2024-02-01", "2024-01-01", "basic", "30"), "end_before_start"),
        (("C9", "bad", "bad", "basic", "bad"), "unknown_customer"),
    ],
)
def test_dropped_rows(raw_subs, ids, row, rule):
    out = load(raw_subs, ids, ("C2", "2024-01-01", "", "basic", "30"), row)
    assert [r["customer_id"] for r in out.rows.collect()] == ["C2"]
    assert [(r["rule_id"], r["severity"]) for r in out.warnings.collect()] == [(rule, "dropped")]


@pytest.mark.parametrize(
    "row",
    [
        ("C1", "2024-01-01", "2024-01-01", "basic", "0.0"),
        ("C1", "2020-01-01", "2030-12-31", "basic", "99999.99"),
        ("C1", "2099-01-01", None, "enterprise-x", " 50.0 "),
        ("C1", " 2024-10-14 ", " ", "basic", "1e3"),
    ],
)
def test_accepted_rows(raw_subs, ids, row):
    out = load(raw_subs, ids, row)
    assert out.rows.count() == 1 and out.warnings.count() == 0


def test_plan_is_trimmed_and_lowered_but_not_corrected(raw_subs, ids):
    out = load(raw_subs, ids, ("C1", "2024-01-01", "", " Baisc ", "30"))
    assert out.rows.first()["plan"] == "baisc"


def test_one_row_may_warn_twice(raw_subs, ids):
    out = load(raw_subs, ids, ("C1", "2024-01-01", "2024-02-30", "basic", "x"))
    assert out.rows.count() == 0
    assert messages(out.warnings) == [
        "Invalid end_date for subscription at row 2 - treating as active",
        "Invalid monthly_price 'x' at row 2 - skipping",
    ]


def test_malformed_end_is_active(raw_subs, ids):
    row = load(raw_subs, ids, ("C1", "2024-01-01", "soon", "basic", "1")).rows.first()
    assert (row["start_date"], row["end_date"]) == (date(2024, 1, 1), None)


def test_combined_dirty_set(raw_customers, raw_subs):
    people = load_customers(
        raw_customers(("C1", "2024-01-01", "NL"), ("C1", "2024-01-02", "NL"), ("C2", "2024-01-01", "DE"), ("C3", "2024-99-01", "FR"))
    )
    assert (people.rows.count(), people.warnings.count()) == (2, 2)
    out = load_subscriptions(
        raw_subs(
            ("C1", "2023-12-01", None, "basic", "30"),
            ("C2", "2024-01-01", None, "pro", "50"),
            ("C3", "2024-01-01", None, "pro", "50"),
            ("C2", "2024-03-01", "2024-02-01", "pro", "50"),
        ),
        people.rows,
    )
    assert (out.rows.count(), out.warnings.count()) == (2, 2)


def test_typed_silver_loads_as_well(subs, customers):
    people = load_customers(customers(("C1", "2024-01-01")))
    out = load_subscriptions(subs(("C1", "2024-01-01", None, 30), ("C9", "2024-01-01", None, 30)), people.rows)
    # Numbered like the lines of a text file with a header.
    assert out.rows.count() == 1 and messages(out.warnings) == ["Unknown customer_id 'C9' at row 3 - skipping subscription"]


def test_row_ids_instead_of_lines(subs, customers):
    people = load_customers(customers(("C1", "2024-01-01")), lines=False)
    out = load_subscriptions(subs(("C1", "2024-01-01", None, 30), ("C9", "2024-01-01", None, 30)), people.rows, lines=False)
    assert messages(out.warnings) == ["Unknown customer_id 'C9' at row 1 - skipping subscription"]


def test_overlap_messages(subs):
    out = overlap_warnings(subs(("C1", "2024-01-01", "2024-03-01", 1), ("C1", "2024-03-01", None, 1), ("C1", "2024-05-01", None, 1)))
    assert messages(out) == ["Customer 'C1' has overlapping subscriptions: 2024-01-01 to 2024-03-01 overlaps with 2024-03-01 to active"]
