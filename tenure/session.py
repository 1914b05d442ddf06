"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skewed join partitions are split at run time even when that costs one more shuffle:
# a customer holding a third of all rows would otherwise keep one task busy for hours.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# One shuffle partition per this many bytes of input, before the adaptive planner merges
# small ones. Partitions of this size sort in memory on ordinary executors.
BYTES_PER_PARTITION = 256 << 20


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """How many shuffle partitions an input of that size needs."""
    return max(cores, -(-input_bytes // BYTES_PER_PARTITION))


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    ``input_bytes`` sizes the shuffles; the 200 partitions Spark starts from would hold
    half a terabyte each at 100 TB. Without it a cluster keeps its own setting.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    cores = context.defaultParallelism
    if input_bytes is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores)))
    elif context.master.startswith("local"):
        # One wave of reducers on a single machine.
        spark.conf.set("spark.sql.shuffle.partitions", str(cores))
    return spark


def build_session(app_name: str = "tenure", master: str | None = None, driver_memory: str = "4g") -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
    )
    if master:
        builder = builder.master(master)
    return configure(builder.getOrCreate())
