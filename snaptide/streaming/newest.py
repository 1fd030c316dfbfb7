"""Current state by streaming aggregation: the greatest row of each key, kept as state and written when it changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import named
from ..operators.latest import first_rows
from ..sinks.publish import Runs, publish, read_runs
from .ingest import run_to_end
from .upsert import query_id

PERIOD = "period_start"


def newest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], at: str | None = None, period: str | None = None, delay: str | None = None
) -> DataFrame:
    """The row of each key that is greatest by ``order``, as an aggregation in update mode.

    Rows are reduced in the tasks that read them, so a hot key sends one row per task. The state is a row per key; with a
    ``period`` it is a row per key and period of ``at`` (its begin is ``period_start``), and a watermark of ``delay`` ends what is over:
    later rows for it are left out. Rows that tie by ``order`` must be equal, else either of them may stay.
    """
    if (period is None) != (delay is None) or (period is not None and at is None):
        raise ValueError("a period needs a time column and a delay")
    groups = [named(k) for k in keys]
    if period is not None:
        df = df.withWatermark(at, delay)
        groups.append(F.window(named(at), period).alias("__period"))
    greatest = F.max_by(F.struct(*map(named, df.columns)), F.struct(*map(named, order))).alias("__row")
    state = df.groupBy(*groups).agg(greatest)
    row = [F.col("__row").getField(c).alias(c) for c in df.columns]
    return state.select(*row, *([F.col("__period.start").alias(PERIOD)] if period is not None else []))


def newest_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    keys: Sequence[str],
    order: Sequence[str],
    at: str | None = None,
    period: str | None = None,
    delay: str | None = None,
    timeout: int | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Write the keys whose ``newest`` row a micro-batch has changed as a run of a log; ``read_newest`` reads it.

    A batch that is delivered again after a failure replaces its own run.
    """
    spark = df.sparkSession
    # known once Spark has given the stream its id
    started: list[Runs] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not started:
            started.append(Runs(spark, path, query_id(spark, checkpoint)))
        publish(batch, path, started[0].of(batch_id), "UPDATE", writer=started[0].writer, batch=batch_id)

    writer = newest(df, keys, order, at, period, delay).writeStream.outputMode("update").queryName(name)
    return run_to_end(writer.option("checkpointLocation", checkpoint).foreachBatch(write), timeout, log)


def read_newest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], schema=None) -> DataFrame:
    """The last row that was written for each key, and period if there is one."""
    rows = read_runs(spark, path, schema=schema)
    groups = [*keys, *([PERIOD] if PERIOD in rows.columns else [])]
    return first_rows(rows, groups, ["run_id", *order]).drop("run_id")
