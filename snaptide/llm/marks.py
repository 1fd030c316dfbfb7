"""A bit table of fixed size that tells rows that may be in a set from rows that surely are not.

It has ``BITS`` bits, whatever the size of the set, so it may be sent to every task. A bit that is
set by another member costs a row in the exact join that follows, never a result; a corpus
so large that all bits are set pays the whole join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def bit(*columns: Column | str) -> Column:
    """The bit of a row."""
    return F.pmod(F.xxhash64(*columns), F.lit(BITS)).cast("int")


def table(members: DataFrame, place: Column) -> np.ndarray:
    """The table of ``members``, whose bits are ``place``: ``BITS`` / 8 bytes."""
    # the functions count from 1
    counted = place.cast("long") + 1
    found = (
        members.groupBy(F.bitmap_bucket_number(counted).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(counted)).alias("bits"))
        .collect()
    )
    out = np.zeros(BITS // 8, np.uint8)
    for bucket, bits in found:
        low = (bucket - 1) * len(bits)
        out[low : low + len(bits)] = np.frombuffer(bytes(bits), np.uint8)[: len(out) - low]
    return out


def marked(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((marks[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool)


def where(rows: DataFrame, place: Column, marks: np.ndarray, wanted: bool = True) -> DataFrame:
    """Rows whose bit is set, or with ``wanted`` false those whose bit is not; names of columns may be any."""
    held = rows.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns)), place.alias("place"))
    out = held.drop("place")

    def keep(batches):
        for batch in batches:
            chosen = marked(marks, batch.column("place").to_numpy()) == wanted
            yield batch.filter(pa.array(chosen)).drop_columns(["place"])

    return held.mapInArrow(keep, out.schema).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns)))
