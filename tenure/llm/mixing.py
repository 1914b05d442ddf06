"""Mixing sources to target weights by pivotal dependent rounding.

A document of source s is wanted target(s) / size(s) times. The whole part is copied as it is;
the fractions are rounded in pairs: mass (words) moves at random from one document of a pair to
the other until one of them is at 0 or 1, so that the words of the source stay as they are and
every document keeps its expected number of copies. A source is cut into buckets by a hash of
the document. A pair leaves its larger document open more often than not, so a bucket ends with
one that may be large; to give it something to settle with, the bucket also passes on a few open
documents of every order of size. These residuals are rounded up a tree of buckets, and at its
root each document, the largest first, is paired with all smaller ones together. What is left in
the end is a fraction of the smallest, which goes to the nearer end.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.llm.common import WORD, keyed, text_of
from tenure.operators.staging import staged

#: Target words of a source are at most so many times its words.
MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
#: Documents of a source in one bucket, about; and buckets that meet at the next level.
BUCKET_ROWS = 2_000
FAN = 1_000
#: A table of sources up to this number of rows is broadcast, a larger one is joined by shuffle.
BROADCAST_SOURCES = 50_000
_EPS = 1e-9
#: Open documents of each power of two in size that a bucket passes on.
LADDER = 4


def words(text: Column | str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, docs, source_size, target: one row per source.

    Sources in code point order, null last, take the weights in turn. All words are shared by
    weight; what exceeds ``most`` times a source's words is shared again among the others. With
    the sources sorted by cap per unit of weight, those before some place are capped and all
    others get one level per unit of weight, so running totals give the level at once. The
    windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = per_source.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.col("_capped")) / F.col("_rest")
    return (
        ranked.withColumn("_capped", F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap"))
        .withColumn("_rest", F.sum("_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", level)
        .withColumn("_level", F.max(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))).over(everything))
        .withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap"))))
        .select("source", "docs", "source_size", "target")
    )


def pivotal(size: np.ndarray, share: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round the shares of one bucket pairwise, keeping sum(size * share); at most one stays open.

    Rows come in descending size, so that a large document meets many smaller ones that can
    take up its fraction. ``draw`` has one number in [0, 1) per row.
    """
    out = share.astype(float).copy()
    held = -1
    for j in range(len(out)):
        if not _EPS < out[j] < 1 - _EPS:
            out[j] = round(out[j])
            continue
        if held < 0:
            held = j
            continue
        a, b = size[held], size[j]
        up = min((1 - out[held]) * a, out[j] * b)
        down = min(out[held] * a, (1 - out[j]) * b)
        moved = up if draw[j] * (up + down) < down else -down
        out[held] += moved / a
        out[j] -= moved / b
        for k in (held, j):
            if not _EPS < out[k] < 1 - _EPS:
                out[k] = round(out[k])
        open_ = [k for k in (held, j) if 0 < out[k] < 1]
        held = open_[0] if open_ else -1
    return out


def ladder(size: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Which rows a bucket passes on: the first LADDER open ones of each power of two in size."""
    rung = np.where((share > _EPS) & (share < 1 - _EPS), np.frexp(size)[1], -1)
    place = pd.Series(rung).groupby(rung).cumcount().to_numpy()
    return (rung >= 0) & (place < LADDER)


def settle(size: np.ndarray, share: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round all shares, each paired with all smaller ones together; rows in descending size.

    The smaller ones give or take in proportion to what they have or lack, which is the same
    affine change for all of them; so running sums are enough. The sum stays as it was, and every
    row keeps its expectation, as long as the smaller ones can make up for the larger one.
    """
    out = share.astype(float).copy()
    open_ = (out > _EPS) & (out < 1 - _EPS)
    weight = np.where(open_, size, 0.0)
    later = np.append(np.cumsum(weight[::-1])[::-1], 0.0)
    mass = np.append(np.cumsum((weight * out)[::-1])[::-1], 0.0)
    scale, shift = 1.0, 0.0
    for j in np.flatnonzero(open_):
        s = min(max(scale * share[j] + shift, 0.0), 1.0)
        if not _EPS < s < 1 - _EPS:
            out[j] = round(s)
            continue
        have = max(scale * mass[j + 1] + shift * later[j + 1], 0.0)
        lack = max(later[j + 1] - have, 0.0)
        up, down = (1 - s) * size[j], s * size[j]
        if up <= have and down <= lack:
            rises = draw[j] * (up + down) < down
        else:
            # The smaller ones cannot make up for one of both, or for neither: the nearer one then.
            rises = up - have < down - lack
        out[j] = float(rises)
        if rises:
            kept = 1 - min(1.0, up / have) if have > 0 else 1.0
            scale, shift = scale * kept, shift * kept
        else:
            kept = 1 - min(1.0, down / lack) if lack > 0 else 1.0
            scale, shift = scale * kept, 1 - (1 - shift) * kept
    return out


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["size", "draw", "doc_id"], ascending=[False, True, True], kind="stable", na_position="last")


def _round_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    rows = _sorted(rows)
    size, share, draw = rows["size"].to_numpy(float), rows["share"].to_numpy(), rows["draw"].to_numpy()
    own = ~ladder(size, share)
    share = share.copy()
    share[own] = pivotal(size[own], share[own], draw[own])
    return rows.assign(share=share)


def _settle_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = _sorted(rows)
    return rows.assign(share=settle(rows["size"].to_numpy(float), rows["share"].to_numpy(), rows["draw"].to_numpy()))


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def round_copies(rows: DataFrame, seed: int = 42) -> DataFrame:
    """Replace ``share`` in [0, 1] by 0 or 1; needs doc_id, source, docs, size and share.

    A hash of the document picks bucket and draws, so reruns agree on any cluster.
    """
    buckets = F.ceil(F.col("docs") / F.lit(BUCKET_ROWS))
    fraction = (F.col("share") > _EPS) & (F.col("share") < 1 - _EPS) & (F.col("size") > 0)
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), buckets))
    whole = placed.where(~fraction).withColumn("share", F.round("share"))
    level = placed.where(fraction).withColumn("draw", _uniform(F.col("doc_id"), F.col("size"), F.lit(seed + 1)))
    top = rows.agg(F.max("docs")).first()[0] or 0
    count, step, done = -(-top // BUCKET_ROWS), 0, [whole.drop("bucket")]
    while True:
        rounded = staged(level.groupBy("source", "bucket").applyInPandas(_round_bucket, level.schema), f"rounded_{step}")
        open_ = (F.col("share") > 0) & (F.col("share") < 1)
        done.append(rounded.where(~open_).drop("bucket", "draw"))
        level, step = rounded.where(open_), step + 1
        if count <= 1:
            # One bucket per source is left, so these are at most LADDER rows for each power of two, and one.
            last = level.withColumn("draw", _uniform(F.col("doc_id"), F.col("size"), F.lit(seed)))
            done.append(last.groupBy("source").applyInPandas(_settle_source, last.schema).drop("bucket", "draw"))
            return reduce(DataFrame.unionByName, done)
        count = -(-count // FAN)
        level = level.withColumn("bucket", F.floor(F.col("bucket") / FAN)).withColumn(
            "draw", _uniform(F.col("doc_id"), F.col("size"), F.lit(seed + 1 + step))
        )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 42
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs``.

    A null text has size 0; a null source is a source of its own, the last; a source without
    words has target 0. Repeated rows are separate documents; with ties in size the draw, then
    the id decides. An empty table gives an empty result; other columns are not used.
    """
    sizes = staged(keyed(docs.withColumn("size", words("text")), "source", "size"), "mix_sizes")
    targets = staged(source_targets(sizes, weights, most), "mix_targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    ratio = F.least(F.lit(float(most)), F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    wanted = (
        sizes.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_ratio", ratio)
        .withColumn("whole", F.floor(F.col("_ratio") + _EPS))
        .withColumn("share", F.greatest(F.lit(0.0), F.col("_ratio") - F.col("whole")))
        .drop("_ratio", "_source")
    )
    copies = (F.col("whole") + F.col("share")).cast("long")
    return round_copies(wanted, seed).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def copied(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Documents of one id, source and size share their fate: the largest number of copies.
    """
    taken = mix_sources(docs, weights, most, seed).where("copies > 0")
    fate = taken.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    fate = staged(fate.select(*[F.col(c).alias(f"_{c}") for c in fate.columns]), "mix_fate")
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (words("text") == F.col("_size"))
    )
    rows = docs.join(fate, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(*docs.columns)
