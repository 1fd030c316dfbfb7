"""Session settings the library is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work this library leaves to Spark:
# merging small shuffle partitions, splitting skewed join partitions and
# switching to a broadcast once a side is measured to be small.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
}


def cluster_conf(shuffle_bytes: int, target_bytes: int = 200 * 1024 * 1024) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes``.

    The initial partition number is sized so that one partition stays near
    ``target_bytes``; adaptive execution merges what turns out smaller.
    """
    partitions = max(200, -(-shuffle_bytes // target_bytes))
    return {
        **BASE_CONF,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }


def local_session(cpus: int = 8, app: str = "snaptide", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams.

    The number of state partitions is fixed for the life of a checkpoint, so
    it is chosen here and not inherited from the caller's batch setting. State
    lives in RocksDB (off heap, spilling to disk) with changelog checkpoints,
    because deduplication state can outgrow executor memory.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set(
        "spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism)
    )
    sibling.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling
