"""Session defaults. Reports never touch the configuration of a session they are given."""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Reducers to begin with. AQE merges small ones and cannot add any.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    # Split a reducer that holds a hot key, even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dimensions are broadcast only when Spark measures them below this size.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every column costs more than planning a report.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, floor: int = 200) -> int:
    """Reducers that keep a shuffle of `input_bytes` at about 128 MB each. AQE merges small ones
    but cannot split a shuffle that was planned with too few."""
    return max(floor, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "rivulet",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` for a dot. On a cluster pass
    `shuffle_partitions_for` of the bytes the widest join shuffles."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(CLUSTER_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
