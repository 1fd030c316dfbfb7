"""Cleaning of a directory of raw snapshot files in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import named
from ..operators.cleaning import assign_names, drop_blank_columns
from ..sources.files import read_raw


def clean_snapshots(
    spark: SparkSession,
    path: str,
    raw_columns: int,
    schema: T.StructType,
    date_format: str,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Raw files without their blank columns, named by position and typed.

    A value that does not fit its type becomes NULL; count it with the quality
    suite.
    """
    kept = drop_blank_columns(read_raw(spark, path, raw_columns))
    names = [*schema.names, *drop]
    if len(kept.columns) != len(names):
        raise ValueError(f"{len(kept.columns)} columns hold values, {len(names)} are declared")
    table = assign_names(kept, names, drop)

    def typed(field: T.StructField):
        column = named(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.try_to_timestamp(column, F.lit(date_format)).cast("date").alias(field.name)
        return column.try_cast(field.dataType).alias(field.name)

    return table.select(*[typed(field) for field in schema])
