"""Catalog tables and views."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.names import named
from ..scratch import work_area


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Create an empty Parquet table with a declared schema unless it exists."""
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def save_table(df: DataFrame, table: str) -> None:
    """Replace a managed table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int | None = None) -> None:
    """Replace a managed table by one in sorted buckets of its keys, one file each.

    A join or an upsert on the keys then reads it in place: only the other side is shuffled, into as many partitions. There
    must be at least as many buckets as shuffle partitions, which is how many there are by default. The
    new table is complete before the old one goes, and ``df`` may read the old one.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh = f"{table}_{uuid.uuid4().hex[:8]}"
    dealt = df.repartition(buckets, *[named(k) for k in keys])
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")


def create_distinct_table(spark: SparkSession, table: str, source: str) -> None:
    """``table`` as the distinct rows of another table."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet AS SELECT DISTINCT * FROM {source}")


def insert_by_name(df: DataFrame, table: str) -> None:
    """Append to a table by column name; an insert by position could swap columns."""
    columns = df.sparkSession.table(table).columns
    missing = set(columns) ^ set(df.columns)
    if missing:
        raise ValueError(f"columns differ: {sorted(missing)}")
    df.select(*[f"`{c}`" for c in columns]).write.insertInto(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def reset(spark: SparkSession, tables: Sequence[str], views: Sequence[str] = (), *, confirm: bool) -> str:
    """Drop tables and views and return a fresh work area for checkpoints and files.

    Old files are left alone: a new folder is as clean as an emptied one, and a
    reader of the old one is not cut off.
    """
    if not confirm:
        raise ValueError("reset drops tables; pass confirm=True")
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for view in views:
        spark.catalog.dropTempView(view)
    return work_area(spark, "reset")
