"""Tables published as versioned runs, with a history of what each run wrote.

A table is a folder. ``data/run_id=N/attempt=A`` holds the files of one attempt at
run ``N``; a row in ``history``, added after the files, makes it the run. Readers go by the
history alone: a run that failed half-way is not seen, wherever it lies, and
a run that is written again replaces the former attempt at once, when its row is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.latest import first_rows
from ..schemas import HISTORY


COMPACT = "COMPACT"

# What the history holds beside its public columns: the folder of a run, and the stream and batch that wrote it.
_STORED = T.StructType(
    [
        *HISTORY,
        T.StructField("attempt", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)


def run_path(path: str, run_id: int, attempt: str) -> str:
    return f"{path}/data/run_id={run_id}/attempt={attempt}"


def written_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files, rows and bytes under ``path``, from Parquet footers only.

    They are read back and not observed during the write: a task that runs
    again after a lost executor would be observed twice.
    """
    files = (
        spark.read.schema(schema).parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count("*").alias("rows"))
    )
    return files.agg(
        F.create_map(
            F.lit("numFiles"), F.count("*").cast("string"),
            F.lit("numOutputRows"), F.coalesce(F.sum("rows"), F.lit(0)).cast("string"),
            F.lit("numOutputBytes"), F.coalesce(F.sum("size"), F.lit(0)).cast("string"),
        ).alias("operationMetrics")
    )


def even_files(df: DataFrame) -> DataFrame:
    """``df`` in partitions of near the advisory size, so that few small inputs become few files and large ones even files.

    One shuffle of what is written; adaptive execution merges and splits its partitions.
    """
    return df.hint("rebalance")


def publish(
    df: DataFrame,
    path: str,
    run_id: int,
    operation: str = "WRITE",
    user_id: str | None = None,
    user_name: str | None = None,
    metrics: Mapping[str, int] | None = None,
    writer: str | None = None,
    batch: int | None = None,
) -> None:
    """Write ``df`` as run ``run_id``, then log it with its metrics and more given ones.

    Written again by the same ``writer`` (and ``batch``), or by none both times, it replaces the former attempt; the rows of
    another writer stay beside it.
    """
    spark = df.sparkSession
    attempt = uuid.uuid4().hex
    folder = run_path(path, run_id, attempt)
    more = [F.lit(part) for name, value in (metrics or {}).items() for part in (name, str(value))]
    even_files(df).write.parquet(folder)
    written_metrics(spark, folder, df.schema).select(
        F.lit(run_id).cast("bigint").alias("version"),
        F.current_timestamp().alias("timestamp"),
        F.lit(user_id).cast("string").alias("userId"),
        F.lit(user_name).cast("string").alias("userName"),
        F.lit(operation).alias("operation"),
        (F.map_concat("operationMetrics", F.create_map(*more)) if more else F.col("operationMetrics")).alias(
            "operationMetrics"
        ),
        F.lit(attempt).alias("attempt"),
        F.lit(writer).cast("string").alias("writer"),
        F.lit(batch).cast("bigint").alias("batch"),
    ).coalesce(1).write.mode("append").parquet(f"{path}/history")


def _logged(spark: SparkSession, path: str) -> DataFrame:
    """The row of the last attempt of each writer at each run; a compaction stands beside the run it was made at.

    Two writers may have asked for the next number at once: both are in it, and neither replaces the other.
    """
    rows = spark.read.schema(_STORED).parquet(f"{path}/history")
    compacted = (F.col("operation") == COMPACT).alias("compacted")
    same = ["version", "compacted", "writer", "batch"]
    return first_rows(rows.select("*", compacted), same, ["timestamp", "attempt"])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per published run, and one per compaction."""
    return _logged(spark, path).select(*HISTORY.names)


def last_run(spark: SparkSession, path: str) -> int | None:
    return read_history(spark, path).agg(F.max("version")).first()[0]


def run_of(spark: SparkSession, path: str, writer: str, batch: int) -> int:
    """The run that ``batch`` of ``writer`` is: its own if it was logged before, else the next one.

    So a batch that is delivered again replaces itself, and a stream with a new
    checkpoint, whose batches count from zero again, replaces nothing.
    """
    try:
        logged = _logged(spark, path).where(~F.col("compacted"))
        own = F.max(F.when((F.col("writer") == writer) & (F.col("batch") == batch), F.col("version")))
        known, last = logged.agg(own, F.max("version")).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return known if known is not None else 0 if last is None else last + 1


class Runs:
    """Numbers for the batches of one start of a stream: the history is read for the first of them only.

    Only that one can have been delivered before. Numbers that another writer takes meanwhile do no harm, since a run
    is known by its writer and batch as well.
    """

    def __init__(self, spark: SparkSession, path: str, writer: str):
        self.spark, self.path, self.writer = spark, path, writer
        self.last: int | None = None

    def of(self, batch: int) -> int:
        self.last = run_of(self.spark, self.path, self.writer, batch) if self.last is None else self.last + 1
        return self.last


def next_run(spark: SparkSession, path: str) -> int:
    """The number after the last published run; 0 for a new table."""
    return run_of(spark, path, "", -1)


def _folder(spark: SparkSession, path: str, run_id: int) -> str:
    attempts = _logged(spark, path).where((F.col("version") == run_id) & ~F.col("compacted"))
    row = attempts.orderBy(F.desc("timestamp"), F.desc("attempt")).select("attempt").first()
    if row is None:
        raise ValueError(f"run {run_id} is not published under {path}")
    return run_path(path, run_id, row[0])


def read_run(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """Rows of one run; the last published one by default, and of two writers of one number the later one's."""
    run = last_run(spark, path) if run_id is None else run_id
    if run is None:
        raise ValueError(f"nothing published under {path}")
    return spark.read.parquet(_folder(spark, path, run))


def read_runs(
    spark: SparkSession, path: str, up_to: int | None = None, schema: T.StructType | None = None, compacted: bool = False
) -> DataFrame:
    """Rows of all published runs with their ``run_id``.

    With ``compacted`` the last compaction up to ``up_to`` stands for the runs it holds.
    Columns are merged by name, from the footers of all files, unless ``schema`` declares them.
    Only the folders of those runs are listed, however many there have been: the driver gets their numbers.
    """
    reader = spark.read.option("mergeSchema", schema is None).option("basePath", f"{path}/data")
    if schema is not None:
        fields = [f for f in schema if f.name not in ("run_id", "attempt")]
        reader = reader.schema(T.StructType([*fields, T.StructField("run_id", T.LongType()), T.StructField("attempt", T.StringType())]))
    logged = _logged(spark, path)
    if up_to is not None:
        logged = logged.where(F.col("version") <= up_to)
    # a row per run
    rows = logged.select("version", "attempt", "compacted").collect()
    base = max((r["version"] for r in rows if r["compacted"]), default=None) if compacted else None
    wanted = [
        run_path(path, r["version"], r["attempt"])
        for r in rows
        if (r["version"] == base if r["compacted"] else base is None or r["version"] > base) and (compacted or not r["compacted"])
    ]
    if not wanted:
        raise ValueError(f"nothing published under {path}")
    return reader.parquet(*wanted).withColumn("run_id", F.col("run_id").cast("bigint")).drop("attempt")


def append_files(df: DataFrame, path: str) -> None:
    """Append files; columns may be added over time (see ``read_merged``)."""
    even_files(df).write.mode("append").parquet(path)


def overwrite_files(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All files of a table with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").json(path)
