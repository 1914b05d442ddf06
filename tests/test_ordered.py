"""Ordered operators against plain loops, with the hot-key path switched on and off."""

import random
from collections import defaultdict
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from typed import SUBSCRIPTION_TYPES

from tenure.config import DEFAULTS
from tenure.operators import ordered
from tenure.operators.sequences import gaps, overlaps_adjacent, overlaps_running_max

START = date(2024, 1, 1)


def skewed_rows(seed: int, n: int = 400):
    """A third of the rows belong to one customer, many of them on the same day."""
    rng = random.Random(seed)
    rows = []
    for i in rng.sample(range(5 * n), n):
        customer = "hot" if rng.random() < 0.34 else f"c{rng.randrange(40)}"
        start = START + timedelta(days=0 if rng.random() < 0.3 else rng.randrange(25))
        end = None if rng.random() < 0.2 else start + timedelta(days=rng.randrange(20))
        rows.append((i, customer, start, end, "basic", 1))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SUBSCRIPTION_TYPES.replace("DECIMAL(28,6)", "INT"))


def histories(rows):
    by_customer = defaultdict(list)
    for r in rows:
        by_customer[r[1]].append(r)
    for history in by_customer.values():
        history.sort(key=lambda r: (r[2], r[0]))
    return by_customer


def expected_next(rows):
    out = {}
    for history in histories(rows).values():
        for this, following in zip(history, history[1:] + [None]):
            out[this[0]] = (following[2], following[3]) if following else (None, None)
    return out


def expected_running(rows):
    out = {}
    for history in histories(rows).values():
        latest, holder = None, None
        for r in history:
            end = r[3] or date(9999, 12, 31)
            if latest is not None and r[2] <= latest:
                out[r[0]] = (holder[2], holder[3])
            if latest is None or end > latest:
                latest, holder = end, r
    return out


@pytest.fixture(params=["ordinary", "hot"])
def settings(request, monkeypatch):
    """The hot variant splits every key above 3 rows into blocks of 8 row ids."""
    if request.param == "ordinary":
        return DEFAULTS
    for function in ("next_in_order", "greatest_before"):
        original = getattr(ordered, function)
        small = lambda *a, _f=original, **k: _f(*a, block_bits=3, **k)
        monkeypatch.setattr(f"tenure.operators.sequences.{function}", small)
    return replace(DEFAULTS, hot_rows=3)


@pytest.mark.parametrize("seed", [1, 2])
def test_next_row(spark, settings, seed):
    rows = skewed_rows(seed)
    out = gaps(frame(spark, rows), settings).collect()
    assert len(out) == len(rows)
    expected = expected_next(rows)
    for r in out:
        assert (r["next_start"], r["next_end"]) == expected[r["row_id"]]
        gap = (r["next_start"] - r["end_date"]).days if r["next_start"] and r["end_date"] else None
        assert r["gap_days"] == gap


@pytest.mark.parametrize("seed", [3, 4])
def test_running_overlaps(spark, settings, seed):
    rows = skewed_rows(seed)
    out = overlaps_running_max(frame(spark, rows), settings).collect()
    assert {r["row_id"]: (r["previous_start"], r["previous_end"]) for r in out} == expected_running(rows)
    assert len(out) == len(expected_running(rows))


def test_adjacent_overlaps(spark, settings):
    rows = skewed_rows(5)
    out = {r["row_id"] for r in overlaps_adjacent(frame(spark, rows), settings).collect()}
    following = expected_next(rows)
    assert out == {r[0] for r in rows if r[3] and following[r[0]][0] and following[r[0]][0] <= r[3]}


def test_first_holder_of_an_equal_end_wins(spark, subs, settings):
    rows = subs(("a", "2024-01-01", "2024-03-01", 1), ("a", "2024-01-05", "2024-03-01", 1), ("a", "2024-02-01", None, 1))
    out = overlaps_running_max(rows, settings).orderBy("row_id").collect()
    assert [r["previous_start"] for r in out] == [date(2024, 1, 1), date(2024, 1, 1)]


def test_hot_keys_are_bounded_by_the_share_of_rows(spark, monkeypatch):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert [r["k"] for r in ordered.hot_keys(rows, "k", 10).collect()] == [0]
    monkeypatch.setattr(ordered, "MAX_HOT_KEYS", 2)
    # With two slots a key must hold more than half of all rows.
    assert ordered.hot_keys(rows, "k", 10).count() == 0


def test_ordinary_plan_drops_the_hot_branch(spark):
    df = gaps(frame(spark, skewed_rows(6)), DEFAULTS)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "_from_days" not in plan


def test_first_per_key_limits_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), (1000 - F.col("id")).alias("row_id"))
    first = ordered.first_per_key(rows, "k", "row_id")
    assert sorted((r["k"], r["row_id"]) for r in first.collect()) == [(0, 1), (1, 3), (2, 2)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_positions_over_sparse_ids(spark):
    rng = random.Random(7)
    row_ids = rng.sample(range(1 << 40), 300)
    df = spark.createDataFrame([(i,) for i in row_ids], "row_id BIGINT")
    out = ordered.positions(df, "row_id", "p").collect()
    assert {r["row_id"]: r["p"] for r in out} == {v: i for i, v in enumerate(sorted(row_ids))}
