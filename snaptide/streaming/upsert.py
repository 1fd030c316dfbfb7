"""Upsert of a stream, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.upsert import CHANGED, FIRST, FLAG, current_state, reduce_batch, rejected_rows
from ..scratch import persisted
from ..sinks.publish import COMPACT, Runs, last_run, publish, read_runs
from .ingest import run_to_end


def upsert_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    keys: Sequence[str],
    sequence_by: str | None = None,
    tiebreak: Sequence[str] = (),
    timeout: int | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch, reduced to one row per key, as a run of a change log.

    The cost of a batch follows the batch, not the table. A batch that is
    delivered again after a failure replaces its own run; a stream with another
    checkpoint adds runs of its own. ``read_state`` merges
    the runs. Rows without a key are left out and counted in the history as
    ``numRejectedRows``.
    """
    spark = df.sparkSession
    # known once Spark has given the stream its id
    started: list[Runs] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not started:
            started.append(Runs(spark, path, query_id(spark, checkpoint)))
        with persisted(batch):
            rejected = rejected_rows(batch, keys).count()
            run = started[0].of(batch_id)
            changes = reduce_batch(batch, keys, sequence_by, tiebreak)
            metrics = {"numRejectedRows": rejected}
            publish(changes, path, run, "MERGE", metrics=metrics, writer=started[0].writer, batch=batch_id)

    return run_to_end(
        df.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write), timeout, log
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave to the stream of this checkpoint."""
    return spark.read.json(f"{checkpoint}/metadata").select("id").first()[0]


def read_state(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    sequence_by: str | None = None,
    run: int | None = None,
    schema: StructType | None = None,
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Merged state after run ``run`` (the last by default), with its update flags.

    ``schema`` is that of the changes; with it no footer is read to find the columns.
    With ``update_columns`` a matched row has taken those only, and the sequence.
    """
    run = last_run(spark, path) if run is None else run
    if schema is not None:
        inner = [f for f in schema if f.name not in (FIRST, CHANGED)]
        schema = StructType([*inner, StructField(FIRST, LongType()), StructField(CHANGED, LongType())])
    log = read_runs(spark, path, run, schema, compacted=True)
    return current_state(log, keys, sequence_by, run, update_columns=update_columns)


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    sequence_by: str | None = None,
    update_columns: Sequence[str] | None = None,
) -> int:
    """Fold the log into a base at its last run, in place, and return that run.

    The base keeps for each key the run that inserted it and the run that changed it last, so the flags of
    this run and of later ones are the same as without it. A stream may go on writing; states as of
    earlier runs are still read from the runs themselves.
    """
    run = last_run(spark, path)
    log = read_runs(spark, path, run, compacted=True)
    base = current_state(log, keys, sequence_by, update_columns=update_columns, provenance=True)
    publish(base.drop("run_id"), path, run, operation=COMPACT)
    return run
