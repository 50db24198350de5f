"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: How stored tables are compressed; about two thirds of the bytes of Spark's default.
CODEC = "zstd"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session uses ``checkpoints`` in its warehouse folder; on a cluster it must be
    set, as a folder of one machine is lost to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "checkpoints")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written in here go as soon as it is written.

    Otherwise they stay until the driver happens to collect its garbage, and those of several steps fill the disks together.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows no longer depends on the executors that computed ``df``, and sees its true size. The
    files stay for as long as a result may be read; ``clean`` removes those of a session.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)
    _written.setdefault(id(df.sparkSession.sparkContext), []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The intermediate tables of each Spark context of this process.
_written: dict[int, list[str]] = {}


def mark(spark: SparkSession) -> int:
    """How many intermediate tables there are now; ``clean`` can remove those that came after."""
    return len(_written.get(id(spark.sparkContext), []))


def clean(spark: SparkSession, after: int = 0) -> None:
    """Remove the intermediate tables written since ``after``. No DataFrame made from one may be read
    any more, so a job calls it when its tables are written."""
    paths = _written.get(id(spark.sparkContext), [])
    for path in paths[after:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    del paths[after:]
