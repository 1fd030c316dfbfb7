"""Shards of near-equal size by sampled splitters.

Records are ordered by (hash of the text, id), so equal texts stand next to
each other, and a shard is a run of that order. The order is never sorted as a whole:
a size-weighted sample gives splitters, the rows are dealt into the ranges between
them, and only the rows of one range are sorted together. A splitter is a pair of
hash and id, so a text that holds a third of all rows is cut into as many ranges as
its size asks for, and a range that still comes out overfull is cut again.

The sample decides how the work is dealt, not the result: the shard of a row
follows from the exact number of bytes before it.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize

LAW = "bytes"
OVERHEAD = 8
RANGES_PER_SHARD = 4
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 24

# Hex digits of the hash by which a row finds the ranges it may lie in.
_PREFIX = 2
_ORDER = ("sort_key", "id")


def sized(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes plus 8), ``text_crc32`` and ``sort_key`` of each row; a null text has no bytes."""
    text = F.col(text_column)
    return df.select(
        F.col(id_column).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.substring(F.md5(text), 1, 16), F.lit("")).alias("sort_key"),
    )


def assign(df: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Shards differ in bytes by no more than the records on their borders. ``slot`` counts
    the records of a shard from 0 without gaps. Repeated rows are records of their own; a null
    id comes first among equal texts; ids are whole numbers; other columns of ``df`` are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = materialize(sized(df, id_column, text_column), "sized")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(RANGES_PER_SHARD * shards, -(-count // ROWS_PER_RANGE))
    bounds = _splitters(rows, total, ranges)
    dealt = materialize(_deal(rows, bounds), "dealt")
    found = _totals(dealt)
    overfull = _subdivide(dealt, bounds, found, total, ranges)
    if overfull != bounds:
        dealt = materialize(_deal(rows, overfull), "dealt")
        found = _totals(dealt)
    before = _before(rows, found)
    at = Window.partitionBy("range").orderBy(*(F.col(c).asc_nulls_first() for c in _ORDER))
    running = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        dealt.withColumn("upto", F.sum("size").over(running))
        .withColumn("nth", F.row_number().over(at).cast("long") - 1)
        .join(F.broadcast(before), "range")
    )
    # a record belongs to the shard that holds its middle byte
    shard = F.expr(f"((2 * (bytes_before + upto) - size) * {shards}L) div {max(1, 2 * total)}L")
    placed = materialize(
        placed.select(
            "id",
            "size",
            "text_crc32",
            F.least(shard.cast("int"), F.lit(shards - 1)).alias("shard"),
            (F.col("rows_before") + F.col("nth")).alias("position"),
        ),
        "placed",
    )
    # one row per shard
    heads = placed.groupBy("shard").agg(F.min("position").alias("head"))
    return placed.join(F.broadcast(heads), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("position") - F.col("head")).alias("slot")
    )


def _sample(rows: DataFrame, rate: float) -> list[tuple]:
    """Keys of a sample in which each byte counts alike, in order."""
    draw = F.pmod(F.xxhash64("id", "sort_key", F.lit("splitter")), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.where(F.col("id").isNotNull() & (draw < F.col("size") * rate)).select(*_ORDER)
    return sorted((r[0], r[1]) for r in drawn.collect())


def _quantiles(keys: list[tuple], parts: int) -> list[tuple]:
    return sorted({keys[len(keys) * k // parts] for k in range(1, parts)}) if keys else []


def _splitters(rows: DataFrame, total: int, ranges: int) -> list[tuple]:
    """The sample has about ``SAMPLES_PER_RANGE`` keys per range, whatever the size of the table."""
    return _quantiles(_sample(rows, SAMPLES_PER_RANGE * ranges / max(1, total)), ranges)


def _subdivide(dealt: DataFrame, bounds: list[tuple], found: list, total: int, ranges: int) -> list[tuple]:
    """Splitters within each range that holds over twice its share, from a denser sample of that range."""
    share = max(1.0, total / ranges)
    wide = {r["range"]: r["bytes"] for r in found if r["bytes"] > 2 * share and r["rows"] > 1}
    if not wide:
        return bounds
    keys = _sample(dealt.where(F.col("range").isin(list(wide))), 2 * SAMPLES_PER_RANGE / share)
    more = set(bounds)
    for number, size in wide.items():
        own = [k for k in keys if bisect_right(bounds, k) == number]
        more.update(_quantiles(own, int(size / share) + 1))
    return sorted(more)


def _deal(rows: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Each row with the number of its range: a join to the table of ranges, whose size is a parameter."""
    session = rows.sparkSession
    digits = [f"{i:0{_PREFIX}x}" for i in range(16**_PREFIX)]
    cells = []
    for digit in ["", *digits]:
        low = bisect_right(bounds, (digit, -(1 << 63)))
        high = bisect_right(bounds, (digit + "g" if digit else "", (1 << 63) - 1))
        for number in range(low, high + 1):
            lower = bounds[number - 1] if number else None
            upper = bounds[number] if number < len(bounds) else None
            cells.append((digit, number, *(lower or (None, None)), *(upper or (None, None))))
    table = session.createDataFrame(
        cells, "digit string, range int, low_key string, low_id long, high_key string, high_id long"
    )
    own = F.struct(F.col("sort_key"), F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63))))
    inside = (F.col("low_key").isNull() | (own >= F.struct("low_key", "low_id"))) & (
        F.col("high_key").isNull() | (own < F.struct("high_key", "high_id"))
    )
    digit = F.substring("sort_key", 1, _PREFIX)
    joined = rows.join(F.broadcast(table), (digit == F.col("digit")) & inside)
    return joined.select(*rows.columns, "range")


def _totals(dealt: DataFrame) -> list:
    """Rows and bytes per range; the number of ranges is a parameter."""
    return dealt.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()


def _before(rows: DataFrame, found: list) -> DataFrame:
    out, size, count = [], 0, 0
    for r in sorted(found, key=lambda r: r["range"]):
        out.append((r["range"], size, count))
        size, count = size + r["bytes"], count + r["rows"]
    return rows.sparkSession.createDataFrame(out, "range int, bytes_before long, rows_before long")
