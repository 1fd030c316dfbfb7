"""Ranks, leaderboards and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.names import named
from ..scratch import materialize
from .matching import join_on_keys


def _sort_columns(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [named(name).desc() if way == "desc" else named(name).asc() for name, way in order]


def rank_rows(
    df: DataFrame,
    order: Sequence[tuple[str, str]],
    partition_by: Sequence[str] = (),
    name: str = "ranking",
) -> DataFrame:
    """Exact ``RANK()`` without sending a whole partition to one task.

    Rows that tie share a rank, so the distinct sort values are counted first,
    map-side. The counted values are dealt into sorted ranges, summed within their
    range and shifted by the rows of the ranges before it; the ranks are joined back on
    the sort values. A value that holds a third of all rows is one counted value.
    ``df`` is read twice, so hand in a table or a materialised result.
    """
    group = [named(c) for c in partition_by]
    values = [*partition_by, *[column for column, _ in order]]
    sorting = _sort_columns(order)
    counted = df.groupBy(*map(named, values)).agg(F.count("*").alias("__rows"))
    # Which value lands in which range must not change between reads.
    ranged = materialize(
        counted.repartitionByRange(*[c.asc() for c in group], *sorting).withColumn("__range", F.spark_partition_id()),
        "ranges",
    )
    # one row per range and group
    shift = (
        ranged.groupBy(*group, "__range")
        .agg(F.sum("__rows").alias("__rows"))
        .withColumn("__shift", _weight_before(Window.partitionBy(*group).orderBy("__range")))
        .drop("__rows")
    )
    inside = Window.partitionBy(*group, "__range").orderBy(*sorting)
    ranks = (
        join_on_keys(ranged, shift, [*partition_by, "__range"], "inner")
        .withColumn(name, (F.col("__shift") + _weight_before(inside) + 1).cast("bigint"))
        .drop("__shift", "__range", "__rows")
    )
    return join_on_keys(df, ranks, values, "inner")


def _weight_before(window: WindowSpec) -> Column:
    """Rows that the values before this one stand for; the values are distinct."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).cast("bigint")


def top_k(df: DataFrame, order: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps at most ``k``. End ``order`` with a unique column."""
    return df.orderBy(*_sort_columns(order)).limit(k)


def ordered(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sorted for a view. A sort before a write promises no order to its readers."""
    return df.orderBy(*_sort_columns(order))
