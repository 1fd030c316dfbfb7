"""Distinct counts that add up: a sketch per day, merged over any range of days without reading the rows again."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.names import named

# 2 ** PRECISION registers: 16 KB a sketch at most.
PRECISION = 14


def relative_error(precision: int = PRECISION) -> float:
    """Three standard errors of a count, as a share of it; counts of a few thousand are nearly exact."""
    return 3 * 1.04 / math.sqrt(1 << precision)


def sketches(df: DataFrame, by: Sequence[str], column: str, precision: int = PRECISION) -> DataFrame:
    """A mergeable ``sketch`` of the different values of ``column`` for each value of ``by``; NULL is no value.

    Sketches are merged in the tasks that read the rows, so a day with very many rows sends one of them per task. Those of
    a new day are appended to a stored table; the days before are not read again.
    """
    return df.groupBy(*map(named, by)).agg(F.hll_sketch_agg(named(column), precision).alias("sketch"))


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups from stored ones, and the ``distinct_count`` of each."""
    union = stored.groupBy(*map(named, by)).agg(F.hll_union_agg("sketch").alias("sketch"))
    return union.withColumn("distinct_count", F.hll_sketch_estimate("sketch"))


def distinct_over(stored: DataFrame, ranges: DataFrame, day: str, low: str = "low", high: str = "high") -> DataFrame:
    """The ``distinct_count`` of each range of days, both ends included; 0 where no day of it has a sketch.

    A range is spelled out into its days, so the join is one of equal days and moves a sketch per day and range.
    """
    keyed = ranges.select(named(low).alias(low), named(high).alias(high)).distinct()
    days = keyed.withColumn("__day", F.explode(F.sequence(named(low), named(high))))
    found = days.join(stored, days["__day"] == stored[day], "left").groupBy(low, high)
    count = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return found.agg(F.coalesce(count, F.lit(0)).alias("distinct_count"))
