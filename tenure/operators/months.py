"""Running totals per calendar month, from changes instead of one row per active month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_steps(cells: DataFrame, value: str) -> DataFrame:
    """Turn (first_month, last_month or null, value, hi) into steps (month, value, hi).

    ``value`` is added in the first month and taken back in the month after the last one.
    An interval that ends before it begins changes nothing but still widens the range.
    """
    backwards = F.col("last_month") < F.col("first_month")
    amount = F.when(backwards, F.lit(0)).otherwise(F.col(value))
    lowest = F.least("first_month", "last_month")

    def step(month, change):
        return F.struct(month.alias("month"), change.alias(value), F.col("hi").alias("hi"))

    return cells.select(
        F.explode(
            F.array(
                step(F.when(backwards, lowest).otherwise(F.col("first_month")), amount),
                step(F.add_months("last_month", 1), -amount),
            )
        ).alias("s")
    ).select("s.*")


def together(measures: dict[str, DataFrame]) -> DataFrame:
    """Steps of several measures, name -> cells, as one table of steps with a column for each."""
    types = {name: dict(cells.dtypes)[name] for name, cells in measures.items()}

    def own(name: str, cells: DataFrame) -> DataFrame:
        others = [F.lit(0).cast(t).alias(n) if n != name else F.col(name).cast(t).alias(name) for n, t in types.items()]
        return interval_steps(cells, name).select("month", "hi", *others)

    return reduce(DataFrame.unionByName, [own(name, cells) for name, cells in measures.items()])


def running_months(steps: DataFrame, *values: str) -> DataFrame:
    """(month, values...): the running totals for every month from the first step to max(hi).

    Steps are summed per month first, so the windows without a partition key see at most
    one row per calendar month. Months without a step are filled from the step before.
    """
    by_month = steps.where("month IS NOT NULL").groupBy("month").agg(
        *[F.sum(v).alias(f"_change_{v}") for v in values], F.max("hi").alias("_hi")
    )
    ordered = Window.orderBy("month")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    until = F.least(F.add_months("_next", -1), F.col("_hi"))
    one_month = F.make_ym_interval(F.lit(0), F.lit(1))
    return (
        by_month.select(
            "month",
            *[F.sum(f"_change_{v}").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias(v) for v in values],
            F.lead("month").over(ordered).alias("_next"),
            F.max("_hi").over(whole).alias("_hi"),
        )
        .where(F.col("month") <= F.col("_hi"))
        .select(F.explode(F.sequence(F.col("month"), until, one_month)).alias("month"), *values)
    )
