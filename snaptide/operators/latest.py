"""Latest state per entity, with the tie rule stated by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.names import named
from .matching import join_on_keys


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: str = "break",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Rows with the greatest ``order`` of each key.

    ``ties="keep"`` keeps every row that shares the greatest value, as
    ``RANK() = 1`` does. ``ties="break"`` keeps one row, chosen by ``tiebreak``
    (also greatest first); leaving the choice open is an error.
    """
    if ties == "keep":
        return _keep_ties(df, keys, order)
    if ties != "break":
        raise ValueError(f"ties must be 'keep' or 'break', not {ties!r}")
    if not tiebreak:
        raise ValueError("ties='break' needs tiebreak columns")
    return first_rows(df, keys, [*order, *tiebreak])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``, in one pass.

    ``row_number() = 1`` is limited per key before the shuffle as well as after
    it, so a hot key sends one row per map task.
    """
    newest_first = Window.partitionBy(*map(named, keys)).orderBy(*[named(c).desc() for c in order])
    return (
        df.withColumn("__position", F.row_number().over(newest_first))
        .where(F.col("__position") == 1)
        .drop("__position")
    )


def _keep_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    # A maximum per key is a narrow scan, combined map-side, and the join back
    # hashes on key and value together. So the rows of a hot key spread over
    # their values, and what still ties in one partition adaptive execution
    # can split: the left side of a semi join. A rank window would sort every
    # row and pull every tied row of a key into one task.
    single = len(order) == 1
    measure = named(order[0]) if single else F.struct(*map(named, order))
    newest = df.groupBy(*map(named, keys)).agg(F.max(measure).alias("__newest"))
    if single:
        newest = newest.withColumnRenamed("__newest", order[0])
    else:
        newest = newest.select(*map(named, keys), *[F.col("__newest").getField(c).alias(c) for c in order])
    return join_on_keys(df, newest, [*keys, *order], "left_semi")


def as_of(
    df: DataFrame,
    moment: Column,
    keys: Sequence[str],
    order: Sequence[str],
    **rule,
) -> DataFrame:
    """Latest state per key among the rows whose first order column is not after ``moment``."""
    return latest(df.where(named(order[0]) <= moment), keys, order, **rule)
