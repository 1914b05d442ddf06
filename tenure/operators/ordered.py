"""Ordered operators per key that survive a key holding a third of all rows.

A window over ``partitionBy(key)`` puts a whole key into one task. Here rows are ordered
by (day, row_id) within a key, and keys are treated by size:

* A key of ordinary size is one window group: one shuffle, as usual.
* A hot key is cut into cells (day, block of 2**20 rows that follow each other by row id
  among the rows of hot keys). Blocks go by rank, not by the id's bits, so a cell has at most
  2**20 rows whatever the ids look like. Cells are combined in two further steps: the blocks
  of one day (at most hot rows / 2**20 of them), then the days of one key (bounded by the
  calendar). No step sees an unbounded group, and no row is dropped.

Which keys are hot comes from a count per key, which Spark pre-aggregates on the map side and
which is written once. A key is hot above ``max(hot_rows, total / MAX_HOT_KEYS)`` rows, so there
are always fewer than MAX_HOT_KEYS of them: that is the size bound of the broadcast (a key may
thus have a 65,536th of all rows and still be one group). Without hot keys, the usual case, the
plan is the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.operators.staging import staged

MAX_HOT_KEYS = 1 << 16
BLOCK_BITS = 20
#: No key has so many rows: for tables whose hot keys are kept elsewhere.
NEVER = 1 << 62

_CELL = ("_day", "_block")


def hot_keys(rows: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """One row per key above the size limit; fewer than MAX_HOT_KEYS rows."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    limit = F.greatest(F.lit(hot_rows).cast("double"), total / F.lit(float(MAX_HOT_KEYS)))
    return sizes.where(F.col("_n") > limit).select(key)


def _hot(rows: DataFrame, key: str, hot_rows: int) -> DataFrame | None:
    """The written list of hot keys, None if there are none."""
    if hot_rows >= NEVER:
        return None
    hot = staged(hot_keys(rows, key, hot_rows), "hot_keys")
    return None if hot.isEmpty() else hot


def _with_cells(rows: DataFrame, key: str, row_id: str, day: str, hot: DataFrame, block_bits: int):
    """(all rows with their cell, null for ordinary keys; the rows of hot keys only)."""
    hot = F.broadcast(hot)
    hot_only = (
        positions(rows.join(hot, key), row_id, "_rank")
        .withColumn("_day", F.col(day))
        .withColumn("_block", F.shiftright("_rank", block_bits))
        .drop("_rank")
    )
    ordinary = rows.join(hot, key, "left_anti").select(
        *rows.columns, F.lit(None).cast(rows.schema[day].dataType).alias("_day"), F.lit(None).cast("long").alias("_block")
    )
    return ordinary.unionByName(hot_only), hot_only


def _from_other_cells(hot_only: DataFrame, key: str, value: Column, fold, forward: bool) -> DataFrame:
    """Per cell: ``fold`` of ``value`` over all cells before it (after it if not forward)."""
    pick = F.greatest if fold is F.max else F.least

    def running(partition: list[str], order: str) -> Column:
        ordering = F.col(order).asc() if forward else F.col(order).desc()
        w = Window.partitionBy(*partition).orderBy(ordering)
        return fold("_v").over(w.rowsBetween(Window.unboundedPreceding, -1))

    cells = hot_only.groupBy(key, *_CELL).agg(fold(value).alias("_v"))
    days = (
        cells.groupBy(key, "_day")
        .agg(fold("_v").alias("_v"))
        .select(key, "_day", running([key], "_day").alias("_from_days"))
    )
    return (
        cells.select(key, *_CELL, running([key, "_day"], "_block").alias("_from_blocks"))
        .join(days, [key, "_day"])
        .select(key, *_CELL, pick("_from_blocks", "_from_days").alias("_carry"))
    )


def next_in_order(
    rows: DataFrame,
    key: str,
    day: str,
    row_id: str,
    value: Column,
    name: str,
    hot_rows: int,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``name``: the ``value`` struct of the next row of the same key, null for the last.

    ``value`` must start with (day, row_id), so that the smallest later value is the next row.
    """
    hot = _hot(rows, key, hot_rows)
    if hot is None:
        return rows.withColumn(name, F.lead(value).over(Window.partitionBy(key).orderBy(day, row_id)))
    every, hot_only = _with_cells(rows, key, row_id, day, hot, block_bits)
    w = Window.partitionBy(key, *_CELL).orderBy(day, row_id)
    local = every.repartition(key, *_CELL).withColumn("_local", F.lead(value).over(w))
    carry = _from_other_cells(hot_only, key, value, F.min, forward=False)
    return local.join(carry, [key, *_CELL], "left").select(
        *rows.columns, F.coalesce("_local", "_carry").alias(name)
    )


def greatest_before(
    rows: DataFrame,
    key: str,
    day: str,
    row_id: str,
    value: Column,
    name: str,
    hot_rows: int,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``name``: the greatest ``value`` over all earlier rows of the same key."""
    hot = _hot(rows, key, hot_rows)
    earlier = (Window.unboundedPreceding, -1)
    if hot is None:
        w = Window.partitionBy(key).orderBy(day, row_id).rowsBetween(*earlier)
        return rows.withColumn(name, F.max(value).over(w))
    every, hot_only = _with_cells(rows, key, row_id, day, hot, block_bits)
    w = Window.partitionBy(key, *_CELL).orderBy(day, row_id).rowsBetween(*earlier)
    local = every.repartition(key, *_CELL).withColumn("_local", F.max(value).over(w))
    carry = _from_other_cells(hot_only, key, value, F.max, forward=True)
    return local.join(carry, [key, *_CELL], "left").select(
        *rows.columns, F.greatest("_local", "_carry").alias(name)
    )


def first_per_key(rows: DataFrame, key: str, row_id: str) -> DataFrame:
    """The row with the smallest ``row_id`` of each key.

    Filtering ``row_number() = 1`` lets Spark keep one row per key on the map side before
    it shuffles, so many copies of one key never meet in one task.
    """
    w = Window.partitionBy(key).orderBy(row_id)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def positions(rows: DataFrame, order: str | list[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order`` over the whole table.

    A sort by range gives each task a run of the order, whatever the values look like; the
    result is written. Only the start of each run is gathered: one row per shuffle partition.
    """
    columns = [order] if isinstance(order, str) else order
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(
        rows.repartitionByRange(tasks, *columns)
        .sortWithinPartitions(*columns)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_run", F.shiftright("_place", 33)),
        "positions",
    )
    runs = placed.groupBy("_run").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select("_run", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(shifts), "_run").select(*rows.columns, (F.col("_place") + F.col("_shift")).alias(name))
