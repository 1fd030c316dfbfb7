"""Run-once streams: each run takes the files that are new and stops."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .progress import ProgressLog

def run_to_end(
    writer: DataStreamWriter, timeout: int | None = None, log: str | None = None, table: str | None = None
) -> StreamingQuery:
    """Start a writer on all available input and wait for it; a failure is raised here.

    With ``log`` every progress event is appended to that folder when it comes (``read_progress``). With
    ``table`` the stream goes to a catalog table.
    """
    writer = writer.trigger(availableNow=True)

    def start() -> StreamingQuery:
        return writer.start() if table is None else writer.toTable(table)

    if log is None:
        return _wait(start(), timeout)
    with ProgressLog(writer._spark, log) as events:
        query = start()
        try:
            return _wait(query, timeout)
        finally:
            events.wait(query)


def _wait(query: StreamingQuery, timeout: int | None) -> StreamingQuery:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not end within {timeout} s")
    return query


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    timeout: int | None = None,
    partition_by: Sequence[str] = (),
    log: str | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet files.

    ``partition_by`` a snapshot date lets readers as of a date skip the later
    folders; it suits files that each hold one date.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .partitionBy(*partition_by)
    )
    return run_to_end(writer, timeout, log)


def append_stream_to_table(
    df: DataFrame, table: str, checkpoint: str, name: str, timeout: int | None = None, log: str | None = None
) -> StreamingQuery:
    """Append a stream to a catalog table."""
    writer = df.writeStream.format("parquet").outputMode("append").queryName(name).option("checkpointLocation", checkpoint)
    return run_to_end(writer, timeout, log, table)


def collapse_copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop copies inside each Arrow batch of a task; no shuffle and no state.

    Spark has no map-side step for a streaming deduplication, so this is one.
    It may leave copies, and never drops the first of a value in its batch.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.Table.from_arrays([batch.column(c) for c in columns], names=list(columns))
            numbered = keys.append_column("__row", pa.array(range(batch.num_rows), pa.int64()))
            first = numbered.group_by(list(columns)).aggregate([("__row", "min")]).column("__row_min")
            yield batch.take(first.combine_chunks())

    return df.mapInArrow(collapse, df.schema)


def dedupe_stream(
    df: DataFrame,
    columns: Sequence[str],
    watermark: tuple[str, str] | None = None,
    collapse: bool = False,
) -> DataFrame:
    """First row of each value of ``columns``.

    Without a watermark every value is remembered for ever, as an exact result
    over an unbounded stream needs. With ``(time column, delay)`` the state is
    bounded: copies that arrive within the delay of each other are dropped.

    A stream shuffles every copy before it drops any. Where one row may have
    very many copies, ``collapse`` drops most of them in the task that read
    them, so they do not meet in one state partition. The columns must be flat.
    """
    rows = collapse_copies(df, columns) if collapse else df
    if watermark is not None:
        return rows.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(columns))
    return rows.dropDuplicates(list(columns))
