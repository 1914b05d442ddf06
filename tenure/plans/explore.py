"""Exploratory profiles over cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, Settings
from tenure.functions import scalars as S
from tenure.operators.quantiles import describe, describe_days, histogram, value_counts
from tenure.operators.sequences import gaps
from tenure.operators.staging import staged
from tenure.plans.metrics import with_retained

PRICE_BINS = 10
GAP_BINS = 30
DURATION_BINS = 20


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, nulls, rows) for each column, in one pass."""
    columns = columns or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls"), F.col("_rows").alias("rows")) for c in columns]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def open_subscriptions(subs: DataFrame) -> DataFrame:
    return subs.where(S.is_active("end_date")).select("row_id", "customer_id", "start_date", "plan", "monthly_price")


def invalid_date_ranges(subs: DataFrame) -> DataFrame:
    return subs.where("end_date < start_date").select("row_id", "customer_id", "start_date", "end_date", "plan")


def start_before_signup(subs: DataFrame) -> DataFrame:
    """Needs ``signup_date`` on the rows (see clean.with_customer_state)."""
    return subs.where("start_date < signup_date").select(
        "row_id", "customer_id", "signup_date", "start_date", "plan"
    )


def priced(subs: DataFrame, condition: Column) -> DataFrame:
    return subs.where(condition).select(
        "row_id", "customer_id", "plan", F.col("monthly_price").cast("double").alias("monthly_price")
    )


def negative_prices(subs: DataFrame) -> DataFrame:
    return priced(subs, F.col("monthly_price") < 0)


def zero_prices(subs: DataFrame) -> DataFrame:
    return priced(subs, F.col("monthly_price") == 0)


def country_counts(customers: DataFrame) -> DataFrame:
    """Customers per country as written, missing ones included."""
    return customers.groupBy("country").agg(F.count(F.lit(1)).alias("customers"))


def country_variants(customers: DataFrame) -> DataFrame:
    """(country_cleaned, country, customers) where a code is written in more than one way."""
    variants = (
        customers.where("country IS NOT NULL")
        .groupBy(F.upper(S.strip("country")).alias("country_cleaned"), "country")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    uneven = (
        variants.groupBy("country_cleaned")
        .agg(F.count(F.lit(1)).alias("_n"), F.bool_or(F.col("country") != F.col("country_cleaned")).alias("_other"))
        .where("_n > 1 OR _other")
    )
    return variants.join(uneven.select("country_cleaned"), "country_cleaned", "left_semi")


def multi_active_customers(subs: DataFrame, as_of: str) -> DataFrame:
    """(customer_id, active_subscriptions) for customers with several active at ``as_of``."""
    return (
        _active(subs, as_of)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("active_subscriptions"))
        .where("active_subscriptions > 1")
    )


def multi_active_details(subs: DataFrame, as_of: str) -> DataFrame:
    """The active subscriptions of those customers."""
    several = staged(multi_active_customers(subs, as_of).select("customer_id"), "multi_active")
    return (
        _active(subs, as_of)
        .join(several, "customer_id", "left_semi")
        .select("row_id", "customer_id", "start_date", "end_date", "plan", "monthly_price")
    )


def _active(subs: DataFrame, as_of: str) -> DataFrame:
    return subs.where(S.open_end("end_date") >= F.lit(as_of).cast("date"))


def subscription_gaps(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return gaps(subs, settings).select("row_id", "customer_id", "start_date", "end_date", "next_start", "gap_days")


def gaps_exactly(subs: DataFrame, days: int, settings: Settings = DEFAULTS) -> DataFrame:
    return subscription_gaps(subs, settings).where(F.col("gap_days") == days)


def gap_stats(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return describe_days(_gap_input(subs, settings), "gap_days")


def gap_histogram(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return histogram(value_counts(_gap_input(subs, settings), [], F.col("gap_days")), GAP_BINS)


def _gap_input(subs: DataFrame, settings: Settings) -> DataFrame:
    return gaps(subs.select("row_id", "customer_id", "start_date", "end_date"), settings)


def resubscription_shares(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Share of gaps within the grace days and share of open ends, in percent."""
    gap = F.col("gap_days")
    within = F.count_if(gap <= settings.grace_days)
    open_ends = F.count_if(F.col("end_date").isNull())
    return _gap_input(subs, settings).agg(
        within.alias("within_grace"),
        F.count("gap_days").alias("gaps"),
        F.round(F.coalesce(F.try_divide(within * 100.0, F.count("gap_days")), F.lit(0.0)), 4).alias("within_grace_pct"),
        open_ends.alias("open_ends"),
        F.round(F.try_divide(open_ends * 100.0, F.count(F.lit(1))), 4).alias("open_ends_pct"),
    )


def cohort_sizes(customers: DataFrame) -> DataFrame:
    return customers.groupBy(S.month_key("signup_date").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("cohort_size")
    )


def tiny_cohorts(customers: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return cohort_sizes(customers).where(F.col("cohort_size") < settings.tiny_cohort)


def cohort_retention_exploratory(
    customers: DataFrame, subs: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Unrounded retention per signup month; run it on repaired subscriptions."""
    return (
        with_retained(customers, subs, settings)
        .groupBy("cohort_month")
        .agg(F.avg(F.col("retained").cast("int")).alias("retention_rate"))
    )


def subscription_duration(subs: DataFrame, as_of: str) -> DataFrame:
    """Days from start to end, an open end counted up to ``as_of``."""
    until = F.coalesce("end_date", F.lit(as_of).cast("date"))
    return subs.select(
        "row_id", "customer_id", "start_date", "end_date", F.datediff(until, "start_date").alias("duration_days")
    )


def duration_stats(subs: DataFrame, as_of: str) -> DataFrame:
    return describe_days(subscription_duration(subs, as_of), "duration_days")


def duration_histogram(subs: DataFrame, as_of: str) -> DataFrame:
    return histogram(value_counts(subscription_duration(subs, as_of), [], F.col("duration_days")), DURATION_BINS)


def price_stats(subs: DataFrame) -> DataFrame:
    return describe(subs, [], "monthly_price")


def plan_price_stats(subs: DataFrame) -> DataFrame:
    return describe(subs, ["plan"], "monthly_price")


def price_histogram(subs: DataFrame) -> DataFrame:
    return histogram(value_counts(subs, [], F.col("monthly_price")), PRICE_BINS)
