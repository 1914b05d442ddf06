"""The rule table: what a severity does to silver, quarantine, counts and findings."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, FLAG, LENIENT, STRICT
from tenure.errors import DataQualityError
from tenure.operators import dispositions as D
from tenure.operators import findings as Q
from tenure.operators.staging import staged
from tenure.plans import clean, gold, load, registry

# rule -> a row that breaks it and no other rule; the good row is always there.
GOOD = ("C1", "2024-02-01", "2024-03-01", "basic", "10")
BROKEN = {
    "excluded_customer": ("C8", "2024-02-01", None, "basic", "10"),
    "empty_customer_id": (" ", "2024-02-01", None, "basic", "10"),
    "unknown_customer": ("C9", "2024-02-01", None, "basic", "10"),
    "empty_start_date": ("C1", "", None, "basic", "10"),
    "malformed_start_date": ("C1", "soon", None, "basic", "10"),
    "malformed_end_date": ("C1", "2024-02-01", "never", "basic", "10"),
    "non_numeric_price": ("C1", "2024-02-01", None, "basic", "ten"),
    "price_out_of_range": ("C1", "2024-02-01", None, "basic", "1e40"),
    "end_before_start": ("C1", "2024-02-01", "2024-01-15", "basic", "10"),
    "start_before_signup": ("C1", "2023-12-01", "2024-01-15", "basic", "10"),
    "plan_typo": ("C1", "2024-02-01", None, "baisc", "10"),
    "price_word": ("C1", "2024-02-01", None, "basic", "thirty"),
}


@pytest.fixture(scope="module")
def sides(spark):
    reference = spark.sql("SELECT 'C1' AS customer_id, DATE'2024-01-01' AS signup_date")
    return {"reference": reference, "excluded": spark.sql("SELECT 'C8' AS customer_id")}


def cleaned(raw_subs, sides, rule, severity, policy, extra=()):
    settings = replace(DEFAULTS, severities=((rule, severity),)) if severity else DEFAULTS
    out = clean.clean_subscriptions(raw_subs(GOOD, BROKEN[rule]), policy=policy, settings=settings, extra=extra, **sides)
    return settings, out


def hits(out, settings, rule):
    counts = {r["rule_id"]: (r["severity"], r["hits"]) for r in clean.subscription_rule_counts(out.stated, settings).collect()}
    found = [r["severity"] for r in out.warnings.where(F.col("rule_id") == rule).collect()]
    quarantined = [r["rule_id"] for r in gold.quarantine(out.stated, settings).collect()]
    return counts.get(rule), found, quarantined


@pytest.mark.parametrize("policy", [STRICT, LENIENT, FLAG])
@pytest.mark.parametrize("rule", BROKEN)
def test_monitor_keeps_the_row_as_it_is(raw_subs, sides, rule, policy):
    if rule == "price_word" and policy != FLAG:
        pytest.skip("an uncorrected word is no number, which another rule is about")
    settings, out = cleaned(raw_subs, sides, rule, Q.MONITOR, policy)
    rows = {r["row_id"]: r for r in out.rows.collect()}
    assert set(rows) >= {0, 1}
    if policy == LENIENT:
        count, found, quarantined = hits(out, settings, rule)
        assert count == (Q.MONITOR, 1) and found == [Q.MONITOR] and quarantined == []
    if rule == "end_before_start":
        assert str(rows[1]["end_date"]) == "2024-01-15"
    if rule == "plan_typo":
        assert rows[1]["plan"] == "baisc"


@pytest.mark.parametrize("policy", [STRICT, LENIENT, FLAG])
@pytest.mark.parametrize("rule", BROKEN)
def test_dropped_leaves_the_row_out(raw_subs, sides, rule, policy):
    settings, out = cleaned(raw_subs, sides, rule, Q.DROPPED, policy)
    assert [r["row_id"] for r in out.rows.collect()] == [0]
    if policy == LENIENT:
        count, found, quarantined = hits(out, settings, rule)
        assert count == (Q.DROPPED, 1) and found == [Q.DROPPED] and quarantined == [rule]


@pytest.mark.parametrize("rule", BROKEN)
def test_fatal_is_gated(raw_subs, sides, rule):
    with pytest.raises(DataQualityError, match=f"{rule}: 1 rows"):
        cleaned(raw_subs, sides, rule, Q.FATAL, STRICT)


@pytest.mark.parametrize("rule", ["malformed_end_date", "end_before_start", "plan_typo", "price_word"])
def test_repaired_mends_the_row(raw_subs, sides, rule):
    settings, out = cleaned(raw_subs, sides, rule, Q.REPAIRED, LENIENT)
    row = out.rows.where("row_id = 1").first()
    assert (row["end_date"], row["plan"]) == (None, "basic") and row["monthly_price"] in (10, 30)
    assert hits(out, settings, rule)[1:] == ([Q.REPAIRED], [])


def test_corrections_are_silent_by_default(raw_subs, sides):
    _, out = cleaned(raw_subs, sides, "price_word", None, LENIENT)
    assert out.rows.where("monthly_price = 30").count() == 1 and out.warnings.where("rule_id = 'price_word'").count() == 0


def test_rules_without_a_repair_cannot_be_repaired(raw_subs, sides):
    with pytest.raises(ValueError, match="has no repair"):
        cleaned(raw_subs, sides, "empty_start_date", Q.REPAIRED, LENIENT)
    with pytest.raises(ValueError, match="severity must be one of"):
        cleaned(raw_subs, sides, "empty_start_date", "ignored", LENIENT)
    for rule, severity in (("overlap", Q.DROPPED), ("price_outlier", Q.FATAL)):
        settings = replace(DEFAULTS, severities=((rule, severity),))
        with pytest.raises(ValueError, match="looks at several rows"):
            clean.clean_subscriptions(raw_subs(GOOD), policy=LENIENT, settings=settings, **sides).warnings


@pytest.mark.parametrize("severity,left,found", [(Q.DROPPED, [0], 1), (Q.MONITOR, [0, 1], 1), (Q.SILENT, [0, 1], 0)])
def test_an_added_rule_acts_like_the_others(raw_subs, sides, severity, left, found):
    cheap = Q.Rule("cheap", F.col("monthly_price") < 5, severity, F.col("monthly_price_raw"), F.lit("cheap"))
    rows = raw_subs(GOOD, ("C1", "2024-05-01", None, "basic", "1"))
    out = clean.clean_subscriptions(rows, policy=LENIENT, extra=[cheap], **sides)
    assert [r["row_id"] for r in out.rows.orderBy("row_id").collect()] == left
    assert out.warnings.where("rule_id = 'cheap'").count() == found
    counts = {r["rule_id"]: r["hits"] for r in clean.subscription_rule_counts(out.stated, extra=[cheap]).collect()}
    assert counts["cheap"] == 1
    assert gold.quarantine(out.stated, extra=[cheap]).count() == 2 - len(left)


def test_an_added_rule_is_gated(raw_subs, sides):
    cheap = Q.Rule("cheap", F.col("monthly_price") < 5, Q.FATAL, F.lit(None), F.lit("too cheap"))
    with pytest.raises(DataQualityError, match="cheap: 1 rows.*C1: too cheap|cheap: 1 rows"):
        clean.clean_subscriptions(raw_subs(GOOD, ("C1", "2024-05-01", None, "basic", "1")), policy=STRICT, extra=[cheap], **sides)


def test_customer_rules_act(raw_customers):
    rows = raw_customers(("C1", "2024-01-01", "NL"), ("C2", "2024-01-01", None), ("C3", "", "NL"))
    drop = clean.clean_customers(rows, settings=replace(DEFAULTS, severities=(("missing_country", Q.DROPPED),)))
    assert {r["customer_id"] for r in drop.rows.collect()} == {"C1"} and {r["customer_id"] for r in drop.removed.collect()} == {"C2", "C3"}
    keep = clean.clean_customers(rows, settings=replace(DEFAULTS, severities=(("empty_signup_date", Q.MONITOR),)))
    assert keep.rows.count() == 3 and keep.removed.count() == 0
    with pytest.raises(DataQualityError, match="missing_country: 1 rows"):
        clean.clean_customers(rows, STRICT, replace(DEFAULTS, severities=(("missing_country", Q.FATAL),)))
    with pytest.raises(ValueError, match="must stay"):
        clean.clean_customers(rows, settings=replace(DEFAULTS, severities=(("duplicate_customer_id", Q.MONITOR),)))


def test_the_loader_follows_where_metrics_allow_it(raw_subs, ids):
    rows = raw_subs(GOOD, ("C9", *GOOD[1:]), ("C1", "2024-05-01", None, "basic", "-1"), ("C1", "2024-06-01", "never", "basic", "1"))

    def loaded(*severities):
        out = load.load_subscriptions(rows, ids("C1"), replace(DEFAULTS, severities=severities), lines=False)
        return [r["row_id"] for r in out.rows.orderBy("row_id").collect()], [(r["rule_id"], r["severity"]) for r in out.warnings.orderBy("row_id").collect()]

    default = [("unknown_customer", Q.DROPPED), ("negative_price", Q.DROPPED), ("malformed_end_date", Q.REPAIRED)]
    assert loaded() == ([0, 3], default)
    assert loaded(("unknown_customer", Q.MONITOR), ("negative_price", Q.MONITOR), ("malformed_end_date", Q.DROPPED)) == (
        [0, 1, 2],
        [("unknown_customer", Q.MONITOR), ("negative_price", Q.MONITOR), ("malformed_end_date", Q.DROPPED)],
    )
    assert loaded(("end_before_start", Q.MONITOR)) == ([0, 3], default)


def test_fate_names_the_gravest_action(raw_subs, sides):
    rules = clean.subscription_rules(lenient=True)
    stated = staged(clean.with_customer_state(clean.standardise_subscriptions(raw_subs(GOOD, *BROKEN.values())), **sides), "stated")
    fates = [r[0] for r in stated.orderBy("row_id").select(D.fate(rules, LENIENT)).collect()]
    assert fates == ["keep", "drop", "drop", "drop", "drop", "drop", "repair", "drop", "stop", "drop", "keep", "keep", "keep"]
    table = {r["rule_id"]: (r["action"], r["hits"]) for r in D.rule_table(stated, rules, FLAG).collect()}
    assert table["unknown_customer"] == ("keep", 1) and table["excluded_customer"] == ("drop", 1)


def test_unknown_rule_ids_are_refused(spark):
    with pytest.raises(ValueError, match="no such rule: end_befor_start"):
        registry.check_severities(replace(DEFAULTS, severities=(("end_befor_start", Q.MONITOR),)), [])
