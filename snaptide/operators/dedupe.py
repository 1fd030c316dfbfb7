"""Duplicate removal and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.names import named


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values of ``columns`` (all by default); copies are dropped before the shuffle too."""
    return (df if columns is None else df.select(*columns)).distinct()


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per value of ``columns``, batch or stream. See ``streaming.ingest.dedupe_stream``."""
    return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()


def duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Values that occur more than once, with their number of ``copies``."""
    names = list(columns or df.columns)
    return (
        df.groupBy(*[named(c) for c in names])
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )
