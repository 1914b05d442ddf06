"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number for a key; the shard with the best draw gets the record. A draw
depends on the key and that shard alone, so one more shard takes records only into itself, and
takes its share by weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import partitions, text_of
from tenure.operators.staging import staged

#: Hexadecimal digits of the hash that make a draw: 52 bits, exact in a double.
DIGITS = 13


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """An exponential draw with rate ``weight``; the smallest one wins.

    With u uniform in (0, 1), the shard of weight w wins with probability w / sum of weights.
    """
    digest = F.md5(F.concat_ws(":", key, shard.cast("string")).cast("binary"))
    h = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return -F.ln((h + 0.5) / float(16**DIGITS)) / weight


def best(key: Column, weights: Sequence[float]) -> Column:
    """Struct (score, shard) of the winning shard; ties go to the smaller number."""
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    draws = F.transform(
        F.array(*[F.lit(float(w)) for w in weights]),
        lambda w, i: F.struct(draw(key, i, w).alias("score"), i.cast("int").alias("shard")),
    )
    return F.array_min(draws)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among ``len(weights)`` weighted shards."""
    return best(key, weights)["shard"]


def with_slots(df: DataFrame, shard: str, order: Sequence[str], name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in the order given.

    A global sort by range gives each task a run of the order, so a shard of any size is spread
    over many tasks. Only the start of each shard in each task is gathered: at most
    tasks + shards rows, the one table broadcast here. Rows equal in all of ``order`` are told
    apart by a row number, so repeated rows spread as well.
    """
    n = partitions(df.sparkSession)
    numbered = staged(df.withColumn("_row", F.monotonically_increasing_id()), "shard_rows")
    keys = [shard, *order, "_row"]
    placed = staged(
        numbered.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_pos", 33)),
        "shard_order",
    )
    runs = placed.groupBy(shard, "_part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(_before(shard))
    starts = runs.select(shard, "_part", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"))
    out = placed.join(F.broadcast(starts), [shard, "_part"])
    return out.withColumn(name, F.col("_pos") + F.col("_shift")).select(*df.columns, name)


def _before(shard: str):
    from pyspark.sql import Window

    return Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def assign_shards(
    docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Law ``key``: the key and the shards decide alone. ``grown_shard`` is the shard after one more
    of mean weight joins. Size is the UTF-8 length plus 8. A null text is empty (size 8, checksum
    0); a null key counts as the empty key; repeated rows each get a slot; an empty table gives an
    empty result; other columns of ``docs`` are not used.
    """
    body = text_of(text).cast("binary")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    extra = sum(weights) / len(weights)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        best(name, weights).alias("_best"),
        draw(name, F.lit(len(weights)), F.lit(float(extra))).alias("_new"),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("_best.shard").alias("shard"),
        F.when(F.col("_new") < F.col("_best.score"), F.lit(len(weights)))
        .otherwise(F.col("_best.shard"))
        .cast("int")
        .alias("grown_shard"),
    )
    slots = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
