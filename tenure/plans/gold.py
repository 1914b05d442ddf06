"""Business-ready tables built from silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, LENIENT, Settings
from tenure.functions import scalars as S
from tenure.operators.sequences import with_next
from tenure.operators import findings as Q
from tenure.operators.dispositions import dropping_rule
from tenure.operators.months import running_months, together
from tenure.plans.clean import subscription_rules
from tenure.plans.metrics import active_cells, churn_cells, churn_per_month, mrr_cells


def subscription_enriched(
    customers: DataFrame, subs: DataFrame, as_of: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """Each subscription with its customer's fields and derived flags.

    ``customers`` must be unique by id; open ends run up to ``as_of`` for the durations.
    """
    until = F.coalesce("end_date", F.lit(as_of).cast("date"))
    first, last = S.month_start("start_date"), S.month_start(until)
    gap = F.datediff("next_start", "end_date")
    owners = customers.select(
        "customer_id", F.col("country").alias("customer_country"), F.col("signup_date").alias("customer_signup_date")
    )
    return (
        with_next(subs.select("row_id", "customer_id", "start_date", "end_date", "plan", "monthly_price"), settings)
        .join(owners, "customer_id", "left")
        .select(
            "row_id",
            "customer_id",
            "customer_country",
            "customer_signup_date",
            "start_date",
            "end_date",
            "plan",
            F.col("monthly_price").cast("double").alias("monthly_price"),
            S.is_active("end_date").alias("is_active"),
            F.datediff(until, "start_date").alias("subscription_duration_days"),
            ((F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1).alias("months_active"),
            (F.col("end_date").isNotNull() & F.coalesce(gap > settings.grace_days, F.lit(True))).alias("is_churned"),
        )
    )


def monthly_arpu(subs: DataFrame) -> DataFrame:
    """Recurring revenue per active customer and month; null in a month without customers."""
    return _by_month({"amount": mrr_cells(subs), "active_customers": active_cells(subs)})


def _by_month(measures: dict[str, DataFrame]) -> DataFrame:
    """Running totals of all measures side by side: one table of steps, no joins of months."""
    mrr = S.money(F.col("amount"))
    counts = [name for name in measures if name != "amount"]
    return running_months(together(measures), *measures).select(
        S.month_key("month").alias("month"),
        mrr.alias("mrr"),
        *counts,
        F.round(F.try_divide(mrr, F.col("active_customers")), 4).alias("arpu"),
    )


def monthly_aggregates(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """All monthly metrics side by side."""
    return _by_month(
        {
            "amount": mrr_cells(subs),
            "churned_count": churn_cells(churn_per_month(subs, settings)),
            "active_customers": active_cells(subs),
        }
    )


def quarantine(
    stated: DataFrame, settings: Settings = DEFAULTS, null_end: bool = False, extra: Sequence[Q.Rule] = ()
) -> DataFrame:
    """Rows that cannot feed the metrics, with the first rule that leaves them out.

    ``stated`` is the output of clean.with_customer_state. Write it partitioned by rule_id.
    """
    rules = subscription_rules(null_end, lenient=True, settings=settings, extra=extra)
    reason = dropping_rule(rules, LENIENT)
    if settings.severity("negative_price", Q.DROPPED) in (Q.FATAL, Q.DROPPED):
        reason = F.coalesce(reason, F.when(F.col("monthly_price") < 0, "negative_price"))
    return (
        stated.withColumn("rule_id", reason)
        .where("rule_id IS NOT NULL")
        .select(
            "row_id",
            "customer_id",
            "start_date_raw",
            "end_date_raw",
            "plan",
            "monthly_price_raw",
            "rule_id",
            (F.col("customer_state") != "known").alias("is_customer_missing"),
        )
    )
