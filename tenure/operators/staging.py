"""Write an intermediate result once.

Two uses: several steps read the result, or it is the lookup side of a join whose other side
may be skewed. Spark splits a hot partition of a join only when both inputs come straight out
of a shuffle; a lookup that ends in an aggregate or a window on the join key does not, a scan
of a written table does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tenure.errors import DataQualityError

SHARED_FOLDER = "spark.checkpoint.dir"

_ROOT: ContextVar[str | None] = ContextVar("staging_root", default=None)


def staging_folder(spark: SparkSession) -> str:
    """The shared folder named by the session; a local master may use its warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get(SHARED_FOLDER, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local["):
        raise DataQualityError(f"Set {SHARED_FOLDER} to a folder that all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/staging"


@contextmanager
def staging_root(spark: SparkSession) -> Iterator[str]:
    """One folder for all that is staged inside; it is removed at the end, also after an error."""
    root = f"{staging_folder(spark)}/tenure-{uuid.uuid4().hex}"
    token = _ROOT.set(root)
    try:
        yield root
    finally:
        _ROOT.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return a scan of it.

    The scan cuts the lineage: a lost executor rereads files instead of repeating joins, and
    later steps read only the columns they need.
    """
    spark = df.sparkSession
    root = _ROOT.get() or f"{staging_folder(spark)}/tenure"
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
