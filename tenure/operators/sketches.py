"""Quantiles by mergeable sketches, where exact order statistics cost too much.

A sketch (KLL) of a few kilobytes stands for all values of a group. Tasks build partial sketches
and merge them, so a group of any size is no burden, and stored sketches of days or sources merge
into that of the whole without the rows. The rank of an answer is off by at most ``rank_error(k)``
of the rows with a probability of 99 %; up to k values a sketch holds all of them and is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.operators.quantiles import QUARTILES

K = 400
LEAST_K, MOST_K = 8, 65535


def rank_error(k: int = K) -> float:
    """Share of the rows by which a rank may be off."""
    # The published error of these sketches.
    return 2.296 / k**0.9723


def k_for(error: float) -> int:
    """The smallest sketch with at most that rank error."""
    k = next((k for k in range(LEAST_K, MOST_K + 1) if rank_error(k) <= error), None)
    if k is None:
        raise ValueError(f"no sketch has a rank error of {error}; the least is {rank_error(MOST_K):.6f}")
    return k


def sketched(rows: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """(by..., sketch, n, min, max) of a numeric column; null values are left out, groups without any too."""
    number = F.col(value).cast("double")
    out = rows.where(number.isNotNull()).groupBy(*by)
    return out.agg(
        F.kll_sketch_agg_double(number, k).alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
    ).where("n > 0")


def merged(sketches: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of parts, combined per ``by``."""
    return (
        sketches.groupBy(*by)
        .agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"))
        .where("n > 0")
    )


def _quantile(prob: float) -> Column:
    return F.kll_sketch_get_quantile_double("sketch", F.lit(prob))


def quantiles(sketches: DataFrame, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """The groups with ``size`` and ``q_<i>``: a value that occurs, no interpolation."""
    kept = [c for c in sketches.columns if c not in ("sketch", "n", "min", "max")]
    return sketches.select(*kept, F.col("n").alias("size"), *[_quantile(p).alias(f"q_{i}") for i, p in enumerate(probs)])


def describe(sketches: DataFrame) -> DataFrame:
    """count, min, quartiles and max of every group."""
    kept = [c for c in sketches.columns if c not in ("sketch", "n", "min", "max")]
    names = ("q25", "median", "q75")
    return sketches.select(
        *kept, F.col("n").alias("count"), "min", *[_quantile(p).alias(c) for p, c in zip(QUARTILES, names)], "max"
    )


def with_true_ranks(rows: DataFrame, by: Sequence[str], value: str, answers: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(by..., size, prob, answer, below, up_to): where the answers of ``quantiles`` stand among all rows.

    ``by`` names at least one column; a group has as many rows in the join as it has different values.

    The wanted rank lies between the shares ``below`` and ``up_to``, give or take the rank error.
    """
    entries = F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), F.col(f"q_{i}").alias("answer")) for i, p in enumerate(probs)]))
    wanted = answers.select(*by, "size", entries.alias("e")).select(*by, "size", "e.*")
    number = F.col(value).cast("double")
    counts = rows.where(number.isNotNull()).groupBy(*by, number.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    share = lambda hit: F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)) / F.first("size")
    joined = wanted.join(counts, list(by))
    return joined.groupBy(*by, "prob", "answer").agg(
        F.first("size").alias("size"),
        share(F.col("value") < F.col("answer")).alias("below"),
        share(F.col("value") <= F.col("answer")).alias("up_to"),
    )
