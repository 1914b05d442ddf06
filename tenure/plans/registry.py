"""Where metrics and rules are added; the full run and the report walk these.

    @metric("monthly_arpu")
    def arpu(customers, subs, settings):
        return gold.monthly_arpu(subs)

    @rule(STAGE_SUBSCRIPTIONS)
    def free_plan(settings):
        return Rule("free_plan", F.col("monthly_price") == 0, MONITOR, F.lit(None), F.lit("price is 0"))

The first column of a metric orders its rows in the report; they may be any number. A rule sees
the rows of its stage as the built-in rules do: standardised, one row per customer id or per
subscription with the state of its customer. It is counted, gated, reported and acted upon by its
severity, which ``Settings.severities`` may change.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tenure.config import Settings
from tenure.operators.findings import Rule
from tenure.plans.clean import STAGE_CUSTOMERS, STAGE_SUBSCRIPTIONS, customer_rules, subscription_rules
from tenure.plans.metrics import METRICS

Metric = Callable[[DataFrame, DataFrame, Settings], DataFrame]
RuleBuilder = Callable[[Settings], Rule]

RULES: dict[str, list[RuleBuilder]] = {STAGE_CUSTOMERS: [], STAGE_SUBSCRIPTIONS: []}
# Rules of the catalogue that are not conditions on one row.
_OTHER = ("duplicate_customer_id", "overlap", "price_outlier", "plan_price_spread", "plan_typo", "price_word", "negative_price")


def metric(name: str) -> Callable[[Metric], Metric]:
    """Add a metric to every report from now on."""

    def add(build: Metric) -> Metric:
        if name == "metadata":
            raise ValueError("the report has a part of that name already")
        METRICS[name] = build
        return build

    return add


def rule(stage: str) -> Callable[[RuleBuilder], RuleBuilder]:
    """Add a rule to a cleaning stage of every run from now on."""

    def add(build: RuleBuilder) -> RuleBuilder:
        if stage not in RULES:
            raise ValueError(f"rules can be added to {', '.join(RULES)}: {stage!r}")
        RULES[stage].append(build)
        return build

    return add


def built(stage: str, settings: Settings) -> list[Rule]:
    """The added rules of a stage; ids must be new."""
    given = [build(settings) for build in RULES[stage]]
    taken = [r.rule_id for r in customer_rules() + subscription_rules()] + list(_OTHER)
    for r in given:
        if r.rule_id in taken:
            raise ValueError(f"there is a rule {r.rule_id!r} already")
        taken.append(r.rule_id)
    return given


def check_severities(settings: Settings, added: Sequence[Rule]) -> None:
    """Raise for a severity of a rule that does not exist: a slip of the pen would do nothing."""
    ids = {r.rule_id for r in (*customer_rules(), *subscription_rules(), *added)} | {*_OTHER}
    unknown = sorted({r for r, _ in settings.severities} - ids)
    if unknown:
        raise ValueError(f"no such rule: {', '.join(unknown)}")
