"""The customer-wise plans over a history stored by customer: no shuffle of ordinary customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, Settings
from tenure.operators import sequences
from tenure.operators.clustered import KEY, Clustered, each_part
from tenure.plans import metrics


def gaps(subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    return each_part(subs, sequences.gaps, settings)


def overlaps_adjacent(subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    return each_part(subs, sequences.overlaps_adjacent, settings)


def overlaps_running_max(subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    return each_part(subs, sequences.overlaps_running_max, settings)


def churn_events(subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    return each_part(subs, metrics.churn_events, settings)


def monthly_churn(subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    parts = each_part(subs, metrics.churn_per_month, settings)
    return metrics.churn_over_months(
        parts.groupBy("first_month").agg(
            F.sum("churned_count").alias("churned_count"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
        )
    )


def with_retained(customers: DataFrame, subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    """``customers`` stored in the same buckets join without a shuffle."""
    first = metrics.with_retained(customers, subs.ordinary, settings)
    # Fewer than 65,536 customers are hot (see operators.ordered).
    hot = subs.hot.select(KEY).distinct()
    theirs = customers.join(F.broadcast(hot), KEY, "left_semi")
    also = metrics.with_retained(theirs, subs.hot, settings).where("retained").select(KEY, F.lit(True).alias("_also"))
    return first.join(F.broadcast(also), KEY, "left").select(
        *[c for c in first.columns if c != "retained"], (F.col("retained") | F.coalesce("_also", F.lit(False))).alias("retained")
    )


def cohort_retention(customers: DataFrame, subs: Clustered, settings: Settings = DEFAULTS) -> DataFrame:
    return metrics.retention_by_cohort(with_retained(customers, subs, settings))
