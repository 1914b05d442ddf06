"""Histories stored by customer, so that what goes along them needs no shuffle.

The rows of ordinary customers are written in buckets of the customer id, sorted by customer and
start: a window or a join on the customer reads a bucket in one task and shuffles nothing. The
customers with very many rows (see operators.ordered) would make their bucket larger than any
other, so their rows are kept beside them without buckets and go on being split. Both parts lie
in one folder, which any reader of Parquet can take as a whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.config import DEFAULTS, Settings
from tenure.operators.findings import union_all
from tenure.operators.ordered import NEVER, hot_keys
from tenure.operators.staging import staged

KEY = "customer_id"
HOT = "hot"
_SPEC = "_clustered"


class Clustered(NamedTuple):
    """The two parts of a stored history; no customer is in both."""

    ordinary: DataFrame
    hot: DataFrame
    buckets: int


def _folders(path: str) -> tuple[str, str]:
    return f"{path}/{HOT}=false", f"{path}/{HOT}=true"


def _bucketed(spark: SparkSession, schema: T.StructType, folder: str, buckets: int) -> DataFrame:
    """A scan of a bucketed folder; the table exists in this session's catalog only as a name for it."""
    name = f"clustered_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)


def write_clustered(rows: DataFrame, path: str, order: tuple[str, ...] = (), buckets: int | None = None, settings: Settings = DEFAULTS) -> Clustered:
    """Store ``rows`` (read from a written table) by customer, sorted by ``order`` within one."""
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = staged(hot_keys(rows, KEY, settings.hot_rows), "hot_keys")
    ordinary, apart = _folders(path)
    rows.join(F.broadcast(hot), KEY).select(*rows.columns).write.mode("overwrite").parquet(apart)
    name = f"clustered_{uuid.uuid4().hex}"
    # One task per bucket, so a bucket is one sorted file.
    dealt = rows.join(F.broadcast(hot), KEY, "left_anti").select(*rows.columns).repartition(buckets, KEY)
    dealt.write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY, *order).option("path", ordinary).saveAsTable(name)
    spec = {"buckets": buckets, "schema": rows.schema.jsonValue()}
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{_SPEC}")
    return Clustered(spark.table(name), spark.read.schema(rows.schema).parquet(apart), buckets)


def open_clustered(spark: SparkSession, path: str) -> Clustered:
    """A stored history, with its buckets, in any later session."""
    spec = json.loads(spark.read.text(f"{path}/{_SPEC}").first()["value"])
    schema = T.StructType.fromJson(spec["schema"])
    ordinary, apart = _folders(path)
    return Clustered(_bucketed(spark, schema, ordinary, spec["buckets"]), spark.read.schema(schema).parquet(apart), spec["buckets"])


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored history as a plain table."""
    stored = open_clustered(spark, path)
    return stored.ordinary.unionByName(stored.hot)


def each_part(stored: Clustered, build: Callable[[DataFrame, Settings], DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """What ``build`` makes of the ordinary and of the hot customers, together.

    For operators that look at one customer at a time. Nobody is hot among the ordinary ones, so
    these are not counted again.
    """
    return union_all([build(stored.ordinary, replace(settings, hot_rows=NEVER)), build(stored.hot, settings)])
