"""Progress of streaming queries as a table, written as it comes or read from the query."""

from __future__ import annotations

import queue
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.files import table_there

PROGRESS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("executed_at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("sink", T.StringType()),
        # rows that changed the state: of a deduplication, those it let through
        T.StructField("updated_rows", T.LongType()),
    ]
)
# What Spark keeps of a query unless it is told otherwise.
_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


class ProgressLog(StreamingQueryListener):
    """Appends every progress event of a session's queries to ``path``, one row each, as they arrive.

    So nothing of a run has to stay in the driver, and what was done before a driver is lost is on record. A thread
    writes, so no query waits for it; events that arrive during a write are written together by the next one.
    """

    def __init__(self, spark: SparkSession, path: str):
        # a folder of its own: appends of two writers to one folder may undo each other
        self.spark, self.path = spark, f"{path}/log-{uuid.uuid4().hex}"
        self._queue: queue.SimpleQueue = queue.SimpleQueue()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._failure: Exception | None = None

    def __enter__(self) -> ProgressLog:
        self._thread = threading.Thread(target=self._write_all, daemon=True)
        self._thread.start()
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self._queue.put(None)
        self._thread.join()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def _write_all(self) -> None:
        """Rows of the queue go to the log; a run id in it says that all rows of that run came before."""
        items: list = []
        while None not in items:
            items = [self._queue.get()]
            while not self._queue.empty():
                items.append(self._queue.get())
            rows = [i for i in items if isinstance(i, tuple)]
            try:
                if rows:
                    self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            except Exception as error:  # raised by ``wait``, since nothing sees this thread fail
                self._failure = self._failure or error
            for run_id in (i for i in items if isinstance(i, str)):
                self._end_of(run_id).set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        source = p.sources[0].description if p.sources else None
        updated = sum(o.numRowsUpdated for o in p.stateOperators) if p.stateOperators else None
        self._queue.put((str(p.id), str(p.runId), p.batchId, p.name, p.timestamp, p.numInputRows, source, p.sink.description, updated))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._queue.put(str(event.runId))

    def wait(self, query: StreamingQuery, timeout: float = 300) -> None:
        """Until all events of an ended query are written; raises what writing them raised."""
        if not self._end_of(str(query.runId)).wait(timeout):
            raise TimeoutError(f"progress events of {query.name} did not end within {timeout} s")
        if self._failure is not None:
            raise RuntimeError(f"progress could not be written to {self.path}") from self._failure


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch that a ``ProgressLog`` has seen; empty if none was ever logged."""
    logged = spark.createDataFrame([], PROGRESS)
    if table_there(spark, path, PROGRESS):
        logged = spark.read.schema(PROGRESS).option("recursiveFileLookup", True).parquet(path)
    # an event that was delivered twice counts once
    first = [F.first(c).alias(c) for c in PROGRESS.names if c not in ("run_id", "batch_id", "executed_at")]
    return logged.groupBy("run_id", "batch_id", "executed_at").agg(*first).select(*PROGRESS.names)


def _progress(query: StreamingQuery) -> list:
    """Every report of a run; fails where Spark may have dropped the first ones."""
    reports = query.recentProgress
    kept = int(SparkSession.active().conf.get(_KEPT, "100"))
    # Spark drops the oldest one as soon as there are as many as it keeps
    if len(reports) >= kept - 1:
        raise ValueError(f"progress of {query.name} is incomplete: only the last {len(reports)} reports are left")
    return reports


def progress_table(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """One row per micro-batch of each query, as far as Spark keeps them; ``ProgressLog`` is for runs of more."""
    rows = [
        (
            str(p["id"]),
            str(p["runId"]),
            p["batchId"],
            p["name"],
            p["timestamp"],
            p["numInputRows"],
            p["sources"][0]["description"] if p["sources"] else None,
            p["sink"]["description"],
            sum(o["numRowsUpdated"] for o in p["stateOperators"]) if p["stateOperators"] else None,
        )
        for query in queries
        for p in _progress(query)
    ]
    return spark.createDataFrame(rows, PROGRESS)


def had_changes(query: StreamingQuery) -> bool:
    """Whether the run took any row in; an idle run reports a batch of none."""
    return any(p["numInputRows"] > 0 for p in query.recentProgress) or any(p["numInputRows"] > 0 for p in _progress(query))
