"""As-of joins: for every row of one table the last row of another with its key, at or before its moment.

Rows of both tables are merged and dealt into sorted ranges of key and moment, so a key with
very many rows is split by time. Inside a range a running window finds the match; where a range begins
in the midst of a key, the last row of the ranges before it is carried in. That carry is a row per range, whatever
the number of rows, so it is sent to every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.names import named
from ..scratch import materialize

# Ranges for each shuffle partition: several, so that the ranges of a hot key even out when they are dealt to tasks.
RANGES_EACH = 4


def _merged(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, tiebreak: Sequence[str]
) -> tuple[DataFrame, list[str], list[str]]:
    """Rows of both tables with the columns they are sorted by, which are those named last."""
    more = [c for c in right.columns if c not in keys]
    clash = sorted(set(more) & set(left.columns))
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(clash)}")
    key_names = [f"k{i}" for i in range(len(keys))]
    ties = [f"t{i}" for i in range(len(tiebreak))]
    payload = F.struct(*map(named, more))
    whole = F.struct(*map(named, left.columns))

    def own(df: DataFrame, at: str, kind: int, mine: dict[str, Column], tie: Sequence[Column]) -> DataFrame:
        return df.select(
            *[named(k).alias(n) for k, n in zip(keys, key_names, strict=True)],
            named(at).alias("at"),
            F.lit(kind).alias("kind"),
            *[c.alias(t) for c, t in zip(tie, ties, strict=True)],
            # spreads rows of one key and moment, and decides between rows that tie in all else
            F.xxhash64(*[named(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]).alias("salt"),
            *[column.alias(name) for name, column in mine.items()],
        )

    known = named(right_at).isNotNull()
    for key in keys:
        known = known & named(key).isNotNull()
    asked = own(left, left_at, 1, {"asked": whole}, [F.lit(None)] * len(ties))
    given = own(right.where(known), right_at, 0, {"given": payload}, [named(c) for c in tiebreak])
    return given.unionByName(asked, allowMissingColumns=True), key_names, ["at", "kind", *ties, "salt"]


def deal(merged: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rows in sorted ranges of near-equal size, numbered by ``range`` and written, so that every reader sees the same ranges."""
    if ranges is None:
        ranges = RANGES_EACH * int(merged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = merged.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    return materialize(dealt, "ranges")


def _carry(dealt: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What the earlier ranges of its first key hand on to a range: ``range``, ``first`` (that key) and ``carried``."""
    key = F.struct(*keys)
    place = F.when(F.col("kind") == 0, F.struct(*keys, *order))
    last = F.max_by(F.struct(*keys, "given"), place)
    # a row per range
    edges = dealt.groupBy("range").agg(F.min(key).alias("first"), last.alias("last"))
    givers = edges.where("last is not null").select(
        F.col("range").alias("from"), F.struct(*[F.col(f"last.{k}").alias(k) for k in keys]).alias("first"), "last.given"
    )
    # a key goes on from range to range as their last one, so the last row of a range is the one to carry
    nearer = edges.select("range", "first").join(givers, "first").where(F.col("from") < F.col("range"))
    return nearer.groupBy("range", "first").agg(F.max_by("given", "from").alias("carried"))


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    tiebreak: Sequence[str] = (),
    how: str = "left",
    ranges: int | None = None,
) -> DataFrame:
    """Rows of ``left`` with the columns of the last row of ``right`` that has their key and is not after them.

    Of rows of ``right`` at one moment the greatest by ``tiebreak`` counts. A row of ``left`` without a match has
    NULLs, or goes with ``how="inner"``. A NULL key or moment matches nothing. Columns of ``right`` other than the keys
    must not be named as one of ``left``. Rows with equal keys, moments and all other columns (maps apart) stay in one range.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    merged, key_names, order = _merged(left, right, keys, left_at, right_at, tiebreak)
    dealt = deal(merged, [*key_names, *order], ranges)
    upto = Window.partitionBy("range", *key_names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumn("found", F.last("given", ignorenulls=True).over(upto)).where("kind = 1")
    carry = F.broadcast(_carry(dealt, key_names, order))
    found = found.withColumn("first", F.struct(*key_names)).join(carry, ["range", "first"], "left")
    match = found.select("asked", F.coalesce("found", "carried").alias("match"))
    if how == "inner":
        match = match.where("match is not null")
    return match.select(
        *[F.col("asked").getField(c).alias(c) for c in left.columns],
        *[F.col("match").getField(c).alias(c) for c in right.columns if c not in keys],
    )


def as_of_dates(
    df: DataFrame,
    moments: Sequence,
    keys: Sequence[str],
    at: str,
    tiebreak: Sequence[str] = (),
    name: str = "as_of",
    ranges: int | None = None,
) -> DataFrame:
    """Latest state per key as of each of ``moments``, in one pass: a row per key and moment from its first row on.

    ``moments`` are values of the type of ``at``, a list as long as one row may be; equal ones count once.
    """
    kind = df.schema[at].dataType.simpleString()
    listed = F.array_sort(F.array_distinct(F.array(*[F.lit(m).cast(kind) for m in moments])))
    known = df.where(named(at).isNotNull())
    first = known.groupBy(*map(named, keys)).agg(F.min(named(at)).alias("__first"))
    asked = first.select(
        *map(named, keys), F.explode(F.filter(listed, lambda moment: moment >= F.col("__first"))).alias(name)
    )
    return as_of_join(asked, known, keys, name, at, tiebreak, "inner", ranges)
