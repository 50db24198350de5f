"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "kinfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them.

    Timestamps are read and shown in UTC. The number of shuffle partitions is an upper bound:
    adaptive execution merges small ones and splits skewed ones. The ids a stream remembers are
    kept by RocksDB on disk, not in the memory of the executors.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
