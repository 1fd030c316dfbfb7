"""Snapshot files, as batch or as stream, with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

REJECTED = "_rejected"


def _csv_options(date_format: str, header: bool) -> dict[str, str]:
    # The header is skipped, not matched: it may repeat names, and the schema
    # binds by position.
    return {"header": str(header).lower(), "enforceSchema": "true", "dateFormat": date_format}


def with_rejects(schema: T.StructType, keep_rejects: bool) -> T.StructType:
    return T.StructType([*schema, T.StructField(REJECTED, T.StringType())]) if keep_rejects else schema


def read_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_format: str,
    header: bool = True,
    keep_rejects: bool = False,
) -> DataFrame:
    """All snapshot files of a directory.

    ``date_format`` has no default: a date that does not parse would become
    NULL without a word. With ``keep_rejects`` the text of a malformed line is
    kept in ``_rejected``, to be counted by the quality suite.
    """
    reader = spark.read.options(**_csv_options(date_format, header))
    if keep_rejects:
        reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    return reader.schema(with_rejects(schema, keep_rejects)).csv(path)


def stream_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_format: str,
    max_files: int | None = None,
    glob: str = "*.csv",
    keep_rejects: bool = False,
) -> DataFrame:
    """New snapshot files of a directory as a stream, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.options(**_csv_options(date_format, True)).option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if keep_rejects:
        reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    return reader.schema(with_rejects(schema, keep_rejects)).csv(path)


def read_raw(spark: SparkSession, path: str, columns: int, header: bool = True) -> DataFrame:
    """Raw CSV as text columns ``c0``, ``c1``, …, for cleaning."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(columns)])
    return spark.read.option("header", str(header).lower()).schema(schema).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table_there(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Whether there is a folder at ``path``."""
    try:
        read_table(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """The files of a Parquet table as a stream: each file once."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Keep the file each row came from."""
    return df.withColumn(name, F.col("_metadata.file_name"))
