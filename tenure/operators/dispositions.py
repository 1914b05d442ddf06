"""What becomes of a row: a rule table compiled into column expressions.

A rule's severity decides, together with the policy:

============  =======  ========  ==========================================
severity      strict   lenient   flag
============  =======  ========  ==========================================
``fatal``     reject   drop      keep what the loader judges itself, else drop
``dropped``   drop     drop      keep what the loader judges itself, else drop
``repaired``  repair   repair    repair
``monitor``   keep     keep      keep
``silent``    repair   repair    repair, without a finding
============  =======  ========  ==========================================

A rule whose severity is set by the user is never left to the loader: ``dropped`` leaves the row
out and ``monitor`` keeps it as it is under every policy.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.config import FLAG, STRICT
from tenure.operators.findings import DROPPED, FATAL, REPAIRED, SILENT, Rule

KEEP = "keep"
DROP = "drop"
REPAIR = "repair"
REJECT = "reject"
#: The job ends at the first such row: leaving it out would falsify a sum.
STOP = "stop"


def action(rule: Rule, policy: str) -> str:
    """What happens to a row that this rule hits."""
    if rule.severity in (REPAIRED, SILENT):
        return REPAIR
    if rule.severity not in (FATAL, DROPPED):
        return KEEP
    if rule.severity == FATAL and policy == STRICT:
        return REJECT
    if rule.severity == FATAL and rule.stop:
        return STOP
    return KEEP if policy == FLAG and rule.handed_on else DROP


def _hit(rule: Rule) -> Column:
    return F.coalesce(rule.hit, F.lit(False))


def fate(rules: Sequence[Rule], policy: str) -> Column:
    """The gravest action over all rules that hit: reject, stop, drop, repair or keep."""
    out = F.lit(KEEP)
    for wanted in (REPAIR, DROP, STOP, REJECT):
        hits = [_hit(r) for r in rules if action(r, policy) == wanted]
        if hits:
            out = F.when(reduce(lambda a, b: a | b, hits), F.lit(wanted)).otherwise(out)
    return out


def dropping_rule(rules: Sequence[Rule], policy: str) -> Column:
    """Id of the first rule that keeps a row out, null for rows that stay."""
    out = [F.when(_hit(r), F.lit(r.rule_id)) for r in rules if action(r, policy) in (DROP, STOP, REJECT)]
    return F.coalesce(*out) if out else F.lit(None).cast("string")


def disposed(rows: DataFrame, rules: Sequence[Rule], policy: str) -> DataFrame:
    """The rows that stay, with their repairs; rules see the values before any repair."""
    gone = [_hit(r) for r in rules if action(r, policy) == DROP]
    kept = rows.where(~reduce(lambda a, b: a | b, gone)) if gone else rows
    changes: dict[str, Column] = {}
    for rule in rules:
        what = action(rule, policy)
        for column, value in rule.repair if what == REPAIR else rule.stop if what == STOP else ():
            changes[column] = F.when(_hit(rule), value).otherwise(changes.get(column, F.col(column)))
    return kept.withColumns(changes) if changes else kept


def rule_table(rows: DataFrame, rules: Sequence[Rule], policy: str) -> DataFrame:
    """(rule_id, severity, action, hits): the table as it applies, with its hits in ``rows``."""
    counted = rows.agg(*[F.count_if(r.hit).alias(r.rule_id) for r in rules])
    entries = [
        F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.severity).alias("severity"),
            F.lit(action(r, policy)).alias("action"),
            F.col(r.rule_id).alias("hits"),
        )
        for r in rules
    ]
    return counted.select(F.inline(F.array(*entries)))
