"""Exact quantiles, summary statistics and histograms over value counts.

Values are first counted (map-side combine), so everything after that works on distinct
values, not on rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.operators.staging import staged

QUARTILES = (0.25, 0.5, 0.75)

_DIGIT_BITS = 20
_DIGIT_MASK = (1 << _DIGIT_BITS) - 1
_SCALE = 1_000_000
#: A price is split into two 64-bit integers: trillions, and millionths of the rest.
_TRILLION = Decimal(10**12)
_DIGITS = ("_d0", "_d1", "_d2", "_d3", "_d4")


def value_counts(rows: DataFrame, by: Sequence[str], value: Column, name: str = "value") -> DataFrame:
    """(by..., name, n), nulls left out."""
    return (
        rows.select(*by, value.alias(name))
        .where(F.col(name).isNotNull())
        .groupBy(*by, name)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(counts: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles of DECIMAL(28,6) values: (by..., size, q_<i> double).

    ``counts`` is (by..., value, n). A value is read as trillions (two digits of 20 bits) and
    millionths of the rest (three digits), in the order of the values. The order statistic is
    found digit by digit: sum counts per digit, locate the digit that holds the wanted rank, go
    on inside it. Digits that are the same in all values are known beforehand and skipped. A
    window group never holds more than 2**20 rows, whatever the number of distinct values, and
    the result is exact. The counts are written once, since every digit reads them.
    """
    by = list(by) or ["_all"]
    if by == ["_all"]:
        # Always 0, but not a literal: joins on it stay equi-joins.
        counts = counts.withColumn("_all", F.pmod("n", F.lit(1)))
    high, low_part = F.expr(f"value div {_TRILLION}"), ((F.col("value") % F.lit(_TRILLION)) * _SCALE).cast("long")
    digits = staged(
        counts.select(
            *by,
            F.shiftright(high, _DIGIT_BITS).alias("_d0"),
            high.bitwiseAND(_DIGIT_MASK).alias("_d1"),
            F.shiftright(low_part, 2 * _DIGIT_BITS).alias("_d2"),
            F.shiftright(low_part, _DIGIT_BITS).bitwiseAND(_DIGIT_MASK).alias("_d3"),
            low_part.bitwiseAND(_DIGIT_MASK).alias("_d4"),
            "n",
        ),
        "value_counts",
    )
    edges = digits.agg(*[F.min(d).alias(f"lo{d}") for d in _DIGITS], *[F.max(d).alias(f"hi{d}") for d in _DIGITS]).first()
    same = {d: edges[f"lo{d}"] for d in _DIGITS if edges[f"lo{d}"] == edges[f"hi{d}"]}
    size = digits.groupBy(*by).agg(F.sum("n").alias("_size"))
    wanted = []
    for i, p in enumerate(probs):
        exact = F.lit(float(p)) * (F.col("_size") - 1)
        low = F.floor(exact)
        for side, rank in (("lo", low), ("hi", F.least(low + 1, F.col("_size") - 1))):
            wanted.append(
                F.struct(
                    F.lit(i).alias("_q"), F.lit(side).alias("_side"), rank.alias("_rank"), (exact - low).alias("_part")
                )
            )
    state = size.select(*by, "_size", F.explode(F.array(*wanted)).alias("_w")).select(*by, "_size", "_w.*")

    prefix: list[str] = []
    for digit in [d for d in _DIGITS if d not in same]:
        cells = digits.groupBy(*by, *prefix, digit).agg(F.sum("n").alias("_n"))
        w = Window.partitionBy(*by, *prefix).orderBy(digit)
        upto = cells.withColumn("_upto", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        state = (
            state.join(upto, [*by, *prefix])
            .where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
            .withColumn("_rank", F.col("_rank") - (F.col("_upto") - F.col("_n")))
            .drop("_upto", "_n")
        )
        prefix.append(digit)

    d = [F.lit(same[name]).cast("long") if name in same else F.col(name) for name in _DIGITS]
    trillions = F.shiftleft(d[0], _DIGIT_BITS) + d[1]
    rest = F.shiftleft(d[2], 2 * _DIGIT_BITS) + F.shiftleft(d[3], _DIGIT_BITS) + d[4]
    found = trillions.cast("decimal(12,0)") * F.lit(_TRILLION) + rest.cast("decimal(19,0)") * F.lit(Decimal("0.000001"))
    found = found.cast("double")

    def side(i: int, name: str) -> Column:
        return F.max(F.when((F.col("_q") == i) & (F.col("_side") == name), found))

    def part(i: int) -> Column:
        return F.max(F.when(F.col("_q") == i, F.col("_part")))

    out = state.groupBy(*by).agg(
        F.max("_size").alias("size"),
        *[
            (side(i, "lo") + (side(i, "hi") - side(i, "lo")) * part(i)).alias(f"q_{i}")
            for i in range(len(probs))
        ],
    )
    return out.drop("_all")


def describe(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of a DECIMAL(28,6) column."""
    by = list(by)
    present = rows.where(F.col(value).isNotNull()).select(*by, value)
    for column in by:
        present = present.where(F.col(column).isNotNull())
    as_double = F.col(value).cast("double")
    moments = present.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(as_double), 6).alias("mean"),
        F.round(F.stddev_samp(as_double), 6).alias("std"),
        F.min(as_double).alias("min"),
        F.max(as_double).alias("max"),
    )
    counts = value_counts(present, by, F.col(value))
    quartiles = exact_quantiles(counts, by, QUARTILES)
    if by:
        joined = moments.join(quartiles, by)
        q = [F.col(f"q_{i}") for i in range(len(QUARTILES))]
    else:
        one_row = quartiles.agg(F.max(F.struct(*[f"q_{i}" for i in range(len(QUARTILES))]))).scalar()
        joined = moments.where("count > 0").withColumn("_q", one_row)
        q = [F.col(f"_q.q_{i}") for i in range(len(QUARTILES))]
    return joined.select(
        *by,
        "count",
        "mean",
        "std",
        "min",
        *[F.round(c, 6).alias(name) for c, name in zip(q, ("p25", "p50", "p75"))],
        "max",
    )


def describe_days(rows: DataFrame, value: str) -> DataFrame:
    """The same for a whole-day column; day counts are few, so one aggregate does it all."""
    counts = value_counts(rows, [], F.col(value))
    v, n = F.col("value").cast("double"), F.col("n")
    total = F.sum(n)
    mean = F.sum(v * n) / total
    spread = F.sum(v * v * n) - F.sum(v * n) * F.sum(v * n) / total
    quartiles = F.percentile(v, F.array(*[F.lit(p) for p in QUARTILES]), n)
    return (
        counts.agg(
            total.alias("count"),
            F.round(mean, 6).alias("mean"),
            F.round(F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), total - 1)), 6).alias("std"),
            F.min(v).alias("min"),
            quartiles.alias("_q"),
            F.max(v).alias("max"),
        )
        .where("count > 0")
        .select(
            "count",
            "mean",
            "std",
            "min",
            *[F.round(F.col("_q")[i], 6).alias(name) for i, name in enumerate(("p25", "p50", "p75"))],
            "max",
        )
    )


def histogram(counts: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins between the extremes of (value, n), the last one closed.

    (bin, lower, upper, n), empty bins included; no rows for no values. Equal extremes
    widen by a half on each side.
    """
    v = F.col("value").cast("double")
    # The total keeps both uses of ``counts`` identical, so its shuffle is done once.
    edges = counts.agg(
        F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.sum("n").alias("total"))
    ).scalar()
    half = F.when(F.col("e.lo") == F.col("e.hi"), 0.5).otherwise(0.0)
    lo, hi = F.col("e.lo") - half, F.col("e.hi") + half
    width = (hi - lo) / bins
    hits = (
        counts.select(v.alias("v"), "n", edges.alias("e"))
        .select("n", F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    frame = (
        counts.sparkSession.range(bins)
        .select(F.col("id").alias("bin"), edges.alias("e"))
        .where("e.lo IS NOT NULL")
        .select(
            "bin",
            F.round(lo + F.col("bin") * width, 6).alias("lower"),
            F.round(lo + (F.col("bin") + 1) * width, 6).alias("upper"),
        )
    )
    return frame.join(hits, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n")
    )
