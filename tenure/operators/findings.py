"""Quality findings as rows instead of log lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FATAL = "fatal"
DROPPED = "dropped"
REPAIRED = "repaired"
MONITOR = "monitor"
#: Repaired without a finding.
SILENT = "silent"
SEVERITIES = (FATAL, DROPPED, REPAIRED, MONITOR, SILENT)

# The texts of the report's warning list. Arguments are given as text.
MESSAGES = {
    "duplicate_customer_id": "Duplicate customer_id '%s' at row %s - skipping",
    "invalid_customer": "Invalid customer at row %s: %s - skipping",
    "missing_country": "Customer '%s' has missing country - keeping record",
    "unknown_customer": "Unknown customer_id '%s' at row %s - skipping subscription",
    "malformed_end_date": "Invalid end_date for subscription at row %s - treating as active",
    "non_numeric_price": "Invalid monthly_price '%s' at row %s - skipping",
    "end_before_start": "Subscription for '%s' has end_date before start_date - skipping",
    "invalid_subscription": "Invalid subscription at row %s: %s - skipping",
    "overlap": "Customer '%s' has overlapping subscriptions: %s to %s overlaps with %s to %s",
}


class Rule(NamedTuple):
    """One rule: when it hits, how grave that is, and what to show."""

    rule_id: str
    hit: Column
    severity: str
    detail: Column
    message: Column
    #: Columns to set in a row that is repaired.
    repair: tuple[tuple[str, Column], ...] = ()
    #: Columns to set, by an expression that raises, where a fatal row must not just be left out.
    stop: tuple[tuple[str, Column], ...] = ()
    #: The loader judges such rows itself.
    handed_on: bool = False


def text(rule_id: str, *args: Column) -> Column:
    shown = [F.coalesce(a.cast("string"), F.lit("")) for a in args]
    return F.format_string(MESSAGES[rule_id], *shown)


def findings(rows: DataFrame, stage: str, rules: Sequence[Rule]) -> DataFrame:
    """One warning row per (row, hitting rule that is not silent); needs row_id and customer_id."""
    rules = [r for r in rules if r.severity != SILENT] or [Rule("none", F.lit(False), MONITOR, F.lit(None), F.lit(None))]
    hits = [
        F.when(
            r.hit,
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.severity).alias("severity"),
                r.detail.cast("string").alias("detail"),
                r.message.alias("message"),
            ),
        )
        for r in rules
    ]
    any_hit = reduce(lambda a, b: a | b, [F.coalesce(r.hit, F.lit(False)) for r in rules])
    return (
        rows.where(any_hit)
        .select("row_id", "customer_id", F.explode(F.array_compact(F.array(*hits))).alias("w"))
        .select(
            F.lit(stage).alias("stage"),
            "w.rule_id",
            "w.severity",
            "row_id",
            "customer_id",
            "w.detail",
            "w.message",
        )
    )


def with_severities(rules: Sequence[Rule], severities: Sequence[tuple[str, str]]) -> list[Rule]:
    """The rules with the severities that the settings give them; those are not left to the loader."""
    given = dict(severities)
    wrong = sorted(f"{rule}={s}" for rule, s in given.items() if s not in SEVERITIES)
    if wrong:
        raise ValueError(f"severity must be one of {', '.join(SEVERITIES)}: {wrong}")
    for r in rules:
        if given.get(r.rule_id) == REPAIRED and not r.repair:
            raise ValueError(f"rule {r.rule_id} has no repair")
    return [r._replace(severity=given[r.rule_id], handed_on=False) if r.rule_id in given else r for r in rules]


def counters(rules: Sequence[Rule]) -> list[Column]:
    return [F.count_if(r.hit).alias(r.rule_id) for r in rules]


def as_rows(one_row: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_id, severity, hits) from the one-row result of ``counters``."""
    entries = [
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.col(r.rule_id).alias("hits"))
        for r in rules
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def examples(warnings: DataFrame, count: int, unknown: int | None = None) -> DataFrame:
    """The first ``count`` findings per rule by row id, with their rank; ``unknown`` for unknown ids.

    The rank filter is applied per map task before the shuffle, so a rule that hits a third
    of all rows sends ``count`` rows per task, not all of them.
    """
    w = Window.partitionBy("stage", "rule_id").orderBy("row_id")
    most = F.when(F.col("rule_id") == "unknown_customer", unknown or count).otherwise(count)
    ranked = warnings.withColumn("rank", F.row_number().over(w))
    # The plain bound is what reaches the map side.
    return ranked.where(F.col("rank") <= max(count, unknown or 0)).where(F.col("rank") <= most)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
