"""Operators over the ordered subscription history of each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.config import DEFAULTS, Settings
from tenure.functions.scalars import FAR_FUTURE, open_end
from tenure.operators.ordered import greatest_before, next_in_order


def with_next(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``next_start`` and ``next_end`` of the customer's next subscription.

    Rows need a start date; ties on it are ordered by ``row_id``.
    """
    value = F.struct("start_date", "row_id", "end_date")
    out = next_in_order(subs, "customer_id", "start_date", "row_id", value, "_next", settings.hot_rows)
    return out.select(
        *subs.columns,
        F.col("_next.start_date").alias("next_start"),
        F.col("_next.end_date").alias("next_end"),
    )


def gaps(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Days from each end date to the next start; null without an end or a next row."""
    return with_next(subs, settings).withColumn("gap_days", F.datediff("next_start", "end_date"))


def overlaps_adjacent(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A closed subscription that its direct successor starts in; a touching day counts."""
    return (
        with_next(subs.select("row_id", "customer_id", "start_date", "end_date"), settings)
        .where(F.col("end_date").isNotNull() & (F.col("next_start") <= F.col("end_date")))
        .select("row_id", "customer_id", "start_date", "end_date", "next_start", "next_end")
    )


def overlaps_running_max(subs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Subscriptions that start before the latest end seen so far, open ends included.

    ``previous_start`` and ``previous_end`` belong to the first row that reached that end.
    """
    holder = F.struct(
        open_end("end_date").alias("end"),
        (-F.unix_date("start_date")).alias("earliest"),
        (-F.col("row_id")).alias("first"),
    )
    rows = subs.select("row_id", "customer_id", "start_date", "end_date")
    out = greatest_before(rows, "customer_id", "start_date", "row_id", holder, "_holder", settings.hot_rows)
    far = F.lit(FAR_FUTURE).cast("date")
    return out.where(F.col("start_date") <= F.col("_holder.end")).select(
        "row_id",
        "customer_id",
        F.date_from_unix_date(-F.col("_holder.earliest")).alias("previous_start"),
        F.nullif(F.col("_holder.end"), far).alias("previous_end"),
        F.col("start_date").alias("current_start"),
        F.col("end_date").alias("current_end"),
    )


def customer_days(subs: DataFrame) -> DataFrame:
    """One row per customer and start day, enough for churn and coverage questions.

    ``last_end`` is the end of the last row (by ``row_id``) of that day, ``reach`` the
    latest end with open ends far in the future. The group is combined on the map side, and
    afterwards a customer has at most one row per calendar day, however many copies it had.
    """
    return subs.groupBy("customer_id", "start_date").agg(
        F.max_by("end_date", "row_id").alias("last_end"),
        F.max(open_end("end_date")).alias("reach"),
        F.min("end_date").alias("first_closed"),
        F.max("end_date").alias("last_closed"),
    )
