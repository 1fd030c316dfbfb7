"""Cleaning of raw snapshot files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.names import named
from ..functions.text import blank_to_null, collapse_separators


def blank_columns(df: DataFrame) -> list[str]:
    """Columns without any value. One pass; the driver gets one row of booleans."""

    def value(field: T.StructField):
        column = named(field.name)
        return blank_to_null(column) if isinstance(field.dataType, T.StringType) else column

    seen = df.agg(
        *[F.bool_or(value(field).isNotNull()).alias(str(i)) for i, field in enumerate(df.schema)]
    ).first()
    return [c for i, c in enumerate(df.columns) if not seen[i]]


def drop_blank_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold only NULL, empty text or whitespace in the whole input.

    Columns go, values do not shift: a missing value inside a row stays missing.
    """
    blank = set(blank_columns(df))
    return df.select(*[named(c) for c in df.columns if c not in blank])


def compact_row(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Move the non-NULL values of each row to the left and name the places.

    Opt-in: a value missing mid-row moves all values after it. There is a place for every
    column, so no value is lost; places beyond the values of a row are NULL.
    """
    if len(names) < len(columns):
        raise ValueError(f"{len(columns)} columns need as many places, not {len(names)}")
    values = F.filter(F.array(*[named(c).cast("string") for c in columns]), lambda v: v.isNotNull())
    others = [named(c) for c in df.columns if c not in columns]
    return df.select(*others, *[F.get(values, F.lit(i)).alias(name) for i, name in enumerate(names)])


def assign_names(df: DataFrame, names: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Name the columns by position, then drop padding columns."""
    return df.toDF(*names).drop(*drop)


def clean_lines(df: DataFrame, column: str = "value", separator: str = ",") -> DataFrame:
    """Raw delimited lines without empty and one-space fields."""
    return df.withColumn(column, collapse_separators(F.col(column), separator))
