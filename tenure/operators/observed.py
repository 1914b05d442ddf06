"""Numbers about rows, counted while the rows are written.

Observed metrics are collected by the tasks that write, in the same pass, and only by attempts
that succeed; so a table needs no second scan to be judged or summed up.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Stage = Callable[[DataFrame, str], DataFrame]


def nulls(columns: Sequence[str]) -> list[Column]:
    """One counter of nulls per column."""
    return [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]


def staged_with(stage: Stage, rows: DataFrame, name: str, counters: Sequence[Column]) -> tuple[DataFrame, dict[str, int]]:
    """The rows as ``stage`` wrote them, and the counters over them, plus ``rows``.

    Counters are plain aggregates. Where the writer had nothing to do (a table known to be empty
    before it runs) there is no observation, and the counters are computed.
    """
    every = [F.count(F.lit(1)).alias("rows"), *counters]
    watch = Observation(f"{name}-{uuid.uuid4().hex}")
    written = stage(rows.observe(watch, *every), name)
    found = watch.get
    return written, dict(found) if found else written.agg(*every).first().asDict()
