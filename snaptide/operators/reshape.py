"""Projections: rename, derive, select, flatten, pivot, explode, append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import named
from ..functions.measures import home_away_totals


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names such as ``W.1`` are taken as they are. Unknown names are an error."""
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.withColumnsRenamed(dict(names))


def undot_columns(df: DataFrame) -> DataFrame:
    """``played.home`` becomes ``played_home``, so that the name is not read as a field."""
    names = [c.replace(".", "_") for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns would share a name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def add_totals(df: DataFrame, totals: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns(home_away_totals(dict(totals)))


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[named(name) for name in names])


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as flat columns named by their path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.selectExpr(
        *[
            ".".join(f"`{part}`" for part in path) + f" AS `{separator.join(path)}`"
            for path in leaves(df.schema, ())
        ]
    )


def pivot_sum(
    df: DataFrame,
    keys: Sequence[str],
    pivot: str,
    values: Sequence[str],
    measure: Column,
) -> DataFrame:
    """Sum of ``measure`` per key, one column per pivot value.

    The values are given: no job to find them, and the same columns each run.
    """
    return df.groupBy(*keys).pivot(pivot, list(values)).agg(measure)


def explode_map(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per map entry; rows with an empty map go."""
    others = [named(c) for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias(key, value))


def append_rows(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Append by name; a column missing on one side is NULL there."""
    result = first
    for df in more:
        result = result.unionByName(df, allowMissingColumns=True)
    return result
