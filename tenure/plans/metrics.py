"""Recurring revenue, churn and retention over valid subscriptions.

Valid means: start date present, price present and not negative, end date null or not
before the start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, Settings
from tenure.functions.scalars import FAR_FUTURE, money, month_key, month_start, months_later, rate
from tenure.operators.months import interval_steps, running_months
from tenure.operators.sequences import customer_days


def month_range(subs: DataFrame) -> DataFrame:
    """(lo, hi): the first and last date that occurs as a start or an end."""
    return subs.agg(
        F.least(F.min("start_date"), F.min("end_date")).alias("lo"),
        F.greatest(F.max("start_date"), F.max("end_date")).alias("hi"),
    )


def mrr_cells(subs: DataFrame) -> DataFrame:
    """Prices summed per (first month, last month), which is at most months squared rows."""
    return (
        subs.groupBy(
            month_start("start_date").alias("first_month"), month_start("end_date").alias("last_month")
        )
        .agg(F.sum("monthly_price").alias("amount"))
        .withColumn("hi", F.greatest("first_month", "last_month"))
    )


def monthly_mrr(subs: DataFrame) -> DataFrame:
    """Full monthly price of every subscription active in the month, quiet months as 0.

    One scan: the cells become month changes with a running total. No row is multiplied by its
    months and no month is compared with every subscription.
    """
    return running_months(interval_steps(mrr_cells(subs), "amount"), "amount").select(
        month_key("month").alias("month"), money(F.col("amount")).alias("mrr")
    ).orderBy("month")


def _next_day_start(days: DataFrame) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("start_date")
    return days.withColumn("next_start", F.lead("start_date").over(w))


def _is_churn(settings: Settings, end: str = "last_end") -> Column:
    """Ended, and no later start within the grace days (a start on the last grace day counts)."""
    late = F.datediff("next_start", end) > settings.grace_days
    return F.col(end).isNotNull() & F.coalesce(late, F.lit(True))


def churn_events(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Closed subscriptions without a later start within the grace days after their end.

    Starts are sorted, so the next one decides. Of several rows on the same start day only
    the last can churn, because the others are followed on that very day; the history
    shrinks to one row per customer and day before the window.
    """
    return (
        _next_day_start(customer_days(subs))
        .where(_is_churn(settings))
        .select(
            "customer_id",
            "start_date",
            F.col("last_end").alias("end_date"),
            "next_start",
            month_key("last_end").alias("month"),
        )
    )


def churn_per_month(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """(first_month, churned_count, lo, hi); rows without an event have no month and only a range."""
    return (
        _next_day_start(customer_days(subs))
        .withColumn("first_month", F.when(_is_churn(settings), month_start("last_end")))
        .groupBy("first_month")
        .agg(
            F.count("first_month").alias("churned_count"),
            month_start(F.least(F.min("start_date"), F.min("first_closed"))).alias("lo"),
            month_start(F.greatest(F.max("start_date"), F.max("last_closed"))).alias("hi"),
        )
    )


def churn_cells(per_month: DataFrame) -> DataFrame:
    # Rows without an event only stretch the range.
    return per_month.select(
        F.explode(
            F.array(
                F.struct("first_month", "churned_count", "hi"),
                F.struct(F.col("lo").alias("first_month"), F.lit(0).cast("long").alias("churned_count"), "hi"),
            )
        ).alias("c")
    ).select("c.*", F.col("c.first_month").alias("last_month"))


def churn_over_months(per_month: DataFrame) -> DataFrame:
    """(month, churned_count) for every month of the range."""
    cells = churn_cells(per_month)
    return running_months(interval_steps(cells, "churned_count"), "churned_count").select(
        month_key("month").alias("month"), "churned_count"
    )


def monthly_churn(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Churn events per month of their end date, zero-filled over the month range.

    Events and range come out of the same aggregate, so the input is read once.
    """
    return churn_over_months(churn_per_month(subs, settings))


def retention_targets(customers: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Cohort month and the date on which retention is tested."""
    return customers.select(
        "customer_id",
        "signup_date",
        month_key("signup_date").alias("cohort_month"),
        months_later("signup_date", settings.retention_months).alias("target_date"),
    )


def with_retained(customers: DataFrame, subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Targets plus ``retained``: does any subscription cover the target date.

    Subscriptions shrink to one row per customer and start day first, so a customer with a
    huge history cannot overload the join; the customer table is read once.
    """
    targets = retention_targets(customers, settings).withColumn("_member", F.col("customer_id"))
    days = customer_days(subs)
    covering = days.where(
        (F.col("customer_id") == F.col("_member").outer())
        & (F.col("start_date") <= F.col("target_date").outer())
        & (F.col("reach") >= F.col("target_date").outer())
    )
    return targets.withColumn("retained", covering.exists()).drop("_member")


def cohort_retention(customers: DataFrame, subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Share of each signup month that is active three months after signup."""
    return retention_by_cohort(with_retained(customers, subs, settings))


def retention_by_cohort(retained: DataFrame) -> DataFrame:
    active = F.count_if("retained")
    return (
        retained
        .groupBy("cohort_month")
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            active.alias("active_after_3_months"),
        )
        .withColumn("retention_rate_3m", rate(F.col("active_after_3_months"), F.col("cohort_size")))
        .orderBy("cohort_month")
    )


def active_cells(subs: DataFrame) -> DataFrame:
    """Month intervals in which customers are active, none of a customer overlapping another.

    Each customer's month intervals are merged first (one row per customer and start month,
    then a running maximum over at most one row per month), so a change of +1 / -1 counts a
    customer once, and nothing is multiplied by its months.
    """
    open_month = month_start(F.lit(FAR_FUTURE).cast("date"))
    spans = (
        subs.select(
            "customer_id",
            month_start("start_date").alias("first_month"),
            month_start("end_date").alias("last_month"),
        )
        .groupBy("customer_id", "first_month")
        .agg(
            F.max(F.coalesce("last_month", open_month)).alias("reach"),
            F.greatest(F.max("first_month"), F.max("last_month")).alias("hi"),
        )
    )
    before = (
        Window.partitionBy("customer_id")
        .orderBy("first_month")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen, first, reach = F.col("seen"), F.col("first_month"), F.col("reach")
    fresh = seen.isNull() | (reach > seen)
    # Months an earlier span already covers are not counted again.
    begins = F.when(fresh & (seen >= first), F.add_months(seen, 1)).otherwise(first)
    return (
        spans.withColumn("seen", F.max("reach").over(before))
        .groupBy(
            begins.alias("first_month"),
            F.when(fresh, F.nullif(reach, open_month)).otherwise(first).alias("last_month"),
        )
        .agg(F.count_if(fresh).alias("active_customers"), F.max("hi").alias("hi"))
    )


def active_customers(subs: DataFrame) -> DataFrame:
    """(month, active_customers): distinct customers with an active subscription."""
    return running_months(interval_steps(active_cells(subs), "active_customers"), "active_customers").select(
        month_key("month").alias("month"), "active_customers"
    )


# name -> (customers, subscriptions, settings) -> DataFrame; add an entry to add a metric.
METRICS: dict[str, Callable[[DataFrame, DataFrame, Settings], DataFrame]] = {
    "monthly_mrr": lambda customers, subs, settings: monthly_mrr(subs),
    "monthly_churn": lambda customers, subs, settings: monthly_churn(subs, settings),
    "cohort_retention": cohort_retention,
}
