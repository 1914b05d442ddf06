import random
from calendar import monthrange
from datetime import date, timedelta

import pytest

from tenure.operators.sequences import customer_days
from tenure.plans import gold
from tenure.plans import metrics as M


def table(df, *columns):
    return {r[columns[0]]: r[columns[1]] if len(columns) == 2 else tuple(r[c] for c in columns[1:]) for r in df.collect()}


def mrr(df):
    return table(M.monthly_mrr(df), "month", "mrr")


def churn(df):
    return table(M.monthly_churn(df), "month", "churned_count")


def test_mrr_counts_the_whole_month(subs):
    assert mrr(subs(("a", "2024-01-01", None, 30), ("b", "2024-01-15", None, 50))) == {"2024-01": 80.0}


def test_mrr_stops_after_the_end_month(subs):
    assert mrr(subs(("a", "2024-01-01", "2024-01-31", 30))) == {"2024-01": 30.0}


def test_mrr_fills_quiet_months_across_years(subs):
    out = mrr(subs(("a", "2023-11-10", "2023-12-01", 10), ("b", "2024-02-28", "2024-03-01", 5.55)))
    assert out == {"2023-11": 10.0, "2023-12": 10.0, "2024-01": 0.0, "2024-02": 5.55, "2024-03": 5.55}


def test_mrr_of_an_open_subscription_runs_to_the_last_month(subs):
    out = mrr(subs(("a", "2024-01-10", None, 10), ("b", "2024-03-01", "2024-04-30", 1)))
    assert out == {"2024-01": 10.0, "2024-02": 10.0, "2024-03": 11.0, "2024-04": 11.0}


def test_mrr_counts_overlapping_subscriptions_twice(subs):
    assert mrr(subs(("a", "2024-01-01", None, 10), ("a", "2024-01-02", None, 10))) == {"2024-01": 20.0}


@pytest.mark.parametrize(
    ("following", "expected"),
    [(None, 1), ("2024-03-15", 0), ("2024-03-29", 0), ("2024-03-30", 1), ("2024-04-01", 1)],
)
def test_churn_window(subs, following, expected):
    rows = [("a", "2024-01-01", "2024-02-28", 10)]
    if following:
        rows.append(("a", following, None, 10))
    assert churn(subs(*rows))["2024-02"] == expected


def test_churn_with_a_negative_gap(subs):
    # The later start lies before the first end: resubscribed. The later one ends: churn.
    out = churn(subs(("a", "2024-01-01", "2024-05-31", 1), ("a", "2024-02-01", "2024-03-31", 1)))
    assert out["2024-05"] == 0 and out["2024-03"] == 1


def test_an_earlier_open_subscription_does_not_prevent_churn(subs):
    assert churn(subs(("a", "2024-01-01", None, 1), ("a", "2024-02-01", "2024-02-10", 1)))["2024-02"] == 1


def test_equal_starts_are_ordered_by_row(subs):
    out = churn(subs(("a", "2024-01-01", "2024-01-10", 1), ("a", "2024-01-01", "2024-02-10", 1)))
    assert out == {"2024-01": 0, "2024-02": 1}
    out = churn(subs(("a", "2024-01-01", "2024-02-10", 1), ("a", "2024-01-01", "2024-01-10", 1)))
    assert out == {"2024-01": 1, "2024-02": 0}


def test_retention(customers, subs):
    people = customers(("a", "2024-01-05"), ("b", "2024-01-20"))
    out = M.cohort_retention(people, subs(("a", "2024-01-05", None, 1), ("b", "2024-01-20", "2024-02-20", 1))).collect()
    assert [tuple(r) for r in out] == [("2024-01", 2, 1, 0.5)]


def test_retention_per_cohort_counts_customers_once(customers, subs):
    people = customers(("a", "2024-01-05"), ("b", "2024-02-20"))
    data = subs(("a", "2024-01-05", None, 1), ("a", "2024-01-06", None, 1), ("b", "2024-02-20", None, 1))
    out = table(M.cohort_retention(people, data), "cohort_month", "retention_rate_3m")
    assert out == {"2024-01": 1.0, "2024-02": 1.0}


@pytest.mark.parametrize(
    ("signup", "end", "kept"),
    [
        ("2024-01-15", "2024-04-15", 1),
        ("2024-01-15", "2024-04-14", 0),
        ("2023-11-30", "2024-02-29", 1),
        ("2022-11-30", "2023-02-28", 1),
        ("2022-11-30", "2023-02-27", 0),
    ],
)
def test_retention_target_day(customers, subs, signup, end, kept):
    out = M.cohort_retention(customers(("a", signup)), subs(("a", signup, end, 1))).first()
    assert out["active_after_3_months"] == kept


def test_customers_without_subscriptions_count_in_the_size(customers, subs):
    out = M.cohort_retention(customers(("a", "2024-01-15"), ("b", "2024-01-16")), subs(("b", "2024-01-16", None, 1))).first()
    assert (out["cohort_size"], out["active_after_3_months"]) == (2, 1)


def test_empty_inputs_give_empty_results(customers, subs):
    nothing, nobody = subs(("a", "2024-01-01", None, 1)).limit(0), customers(("a", "2024-01-01")).limit(0)
    assert M.monthly_mrr(nothing).count() == 0
    assert M.monthly_churn(nothing).count() == 0
    assert M.churn_events(nothing).count() == 0
    assert M.cohort_retention(nobody, nothing).count() == 0
    assert M.active_customers(nothing).count() == 0


def random_history(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = date(2023, 1, 1) + timedelta(days=rng.randrange(500))
        end = None if rng.random() < 0.1 else start + timedelta(days=rng.randrange(120))
        customer = "hot" if rng.random() < 0.34 else f"c{rng.randrange(30)}"
        rows.append((customer, start.isoformat(), end and end.isoformat(), rng.randrange(1, 5000) / 100))
    return rows


def brute_force(rows):
    """Month by month over every row."""
    typed = [(c, date.fromisoformat(s), date.fromisoformat(e) if e else None, p) for c, s, e, p in rows]
    days = [r[1] for r in typed] + [r[2] for r in typed if r[2]]
    month, out = min(days).replace(day=1), {}
    while month <= max(days):
        last = month.replace(day=monthrange(month.year, month.month)[1])
        active = [r for r in typed if r[1] <= last and (r[2] is None or r[2] >= month)]
        out[month.strftime("%Y-%m")] = (round(sum(r[3] for r in active), 2), len({r[0] for r in active}))
        month = last + timedelta(days=1)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_monthly_metrics_equal_brute_force(subs, seed):
    rows = random_history(seed)
    expected = brute_force(rows)
    df = subs(*rows)
    assert mrr(df) == pytest.approx({m: v[0] for m, v in expected.items()})
    assert table(M.active_customers(df), "month", "active_customers") == {m: v[1] for m, v in expected.items()}
    both = table(gold.monthly_aggregates(df), "month", "mrr", "active_customers", "churned_count")
    assert {m: v[1] for m, v in both.items()} == {m: v[1] for m, v in expected.items()}
    assert {m: v[2] for m, v in both.items()} == churn(df)


def test_range_reaches_an_end_covered_by_an_open_subscription(subs):
    out = table(M.active_customers(subs(("a", "2024-01-01", None, 1), ("a", "2024-02-01", "2024-05-01", 1))), "month", "active_customers")
    assert out == {f"2024-{m:02d}": 1 for m in range(1, 6)}


def test_history_shrinks_to_one_row_per_day(subs):
    rows = [("a", "2024-01-01", None, 1)] * 50 + [("a", "2024-01-02", "2024-01-03", 1)] * 50
    assert customer_days(subs(*rows)).count() == 2
