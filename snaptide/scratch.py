"""Shared work area for written intermediates and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_made: ContextVar[list[str] | None] = ContextVar("work areas to remove", default=None)


def work_area(spark: SparkSession, label: str = "work") -> str:
    """A new, unused folder every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a
    local master, where driver and executors are one process, may fall back to
    a temporary folder of the machine.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        area = f"{shared.rstrip('/')}/snaptide-{label}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        area = tempfile.mkdtemp(prefix=f"snaptide-{label}-")
    else:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if (made := _made.get()) is not None:
        made.append(area)
    return area


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the work areas that were made inside once the block ends; the folders it will remove are its value.

    Results are read lazily from written intermediates, so they must be written or collected inside. Nested blocks remove
    their own. What other threads make meanwhile is left alone.
    """
    areas: list[str] = []
    token = _made.set(areas)
    try:
        yield areas
    finally:
        _made.reset(token)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for area in areas:
            path = hadoop(area)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Cache ``df`` while several outputs are made from it.

    For results that are cheap to make again; a cached block is lost with its
    executor. ``materialize`` is for the others.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage with a written table: a lost executor costs a re-read, not
    a recomputation, and the reader has exact sizes for its join choices.
    """
    path = f"{work_area(df.sparkSession, label)}/data"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
