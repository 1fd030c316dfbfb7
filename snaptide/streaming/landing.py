"""New files into bronze: good rows in one table, what cannot be read in another, batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..scratch import persisted
from ..sinks.publish import even_files
from ..sources.files import REJECTED, table_there
from ..sources.headers import FILE, REASON
from .ingest import run_to_end

BATCH = "batch"
QUARANTINE = T.StructType(
    [*(T.StructField(n, T.StringType()) for n in (FILE, REJECTED, REASON)), T.StructField(BATCH, T.LongType())]
)


@dataclass
class Landed:
    """A run of ``land``: its query and the micro-batches it wrote."""

    query: StreamingQuery
    batches: list[int] = field(default_factory=list)


def land(
    df: DataFrame,
    conform: Callable[[DataFrame], DataFrame],
    bronze: str,
    quarantine: str,
    checkpoint: str,
    name: str,
    timeout: int | None = None,
    log: str | None = None,
) -> Landed:
    """Write every micro-batch of ``df`` as a folder ``batch=N`` of ``bronze``, and its rejects as one of ``quarantine``.

    ``conform`` makes the rows of a micro-batch: the columns of bronze beside ``source_file``, ``_rejected`` (the text of what
    cannot be read, else NULL) and ``reason``. A batch that is delivered again after a failure replaces its folders.
    """
    batches: list[int] = []
    spark = df.sparkSession

    def store(rows: DataFrame, number: int) -> None:
        rejected = F.col(REJECTED).isNotNull()
        good = rows.where(~rejected).drop(REJECTED, REASON)
        even_files(good).write.mode("overwrite").parquet(f"{bronze}/{BATCH}={number}")
        bad = rows.where(rejected).select(FILE, REJECTED, REASON)
        even_files(bad).write.mode("overwrite").parquet(f"{quarantine}/{BATCH}={number}")

    def write(batch: DataFrame, number: int) -> None:
        with persisted(conform(batch)) as rows:
            store(rows, number)
        batches.append(number)

    writer = df.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    query = run_to_end(writer, timeout, log)
    if not batches and not table_there(spark, quarantine, QUARANTINE):
        # both tables can be read before there is any file
        store(conform(spark.createDataFrame([], df.schema)), -1)
    return Landed(query, batches)


def with_batch(schema: T.StructType) -> T.StructType:
    """The columns of a landed table with schema ``schema``."""
    return T.StructType([*schema, T.StructField(BATCH, T.LongType())])


def read_quarantine(spark: SparkSession, path: str, batches: list[int] | None = None) -> DataFrame:
    """What could not be read: ``source_file``, ``_rejected``, ``reason`` and ``batch``; of some batches, or all."""
    rows = spark.read.schema(QUARANTINE).parquet(path)
    return rows if batches is None else rows.where(F.col(BATCH).isin(batches))
