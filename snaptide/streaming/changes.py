"""Only what changed: a stream of snapshots without the rows that repeat the last state of their entity.

The state is one hash and one sequence value per entity, however many snapshots have been seen;
deduplication of whole rows would remember every row. Entities are dealt by hash into a fixed number of buckets, and a
bucket's state is read and written as one: a call into Python for each entity would cost far more than its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.names import named

# Columns inside the processor have plain names, since its rows are named tuples.
_BUCKET, _ENTITY, _HASH, _AT, _ROWS = "bucket", "entity", "hash", "at", "entities"
STATE = "last"
# How many buckets there are unless the caller says: a micro-batch calls Python that often at most.
BUCKETS = 1024
# Times to the microsecond, so that different ones are different entities.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class _Changed(StatefulProcessor):
    """Emits the rows of a bucket of entities that differ from the one before them, in the order of their sequence."""

    def __init__(self, state: T.StructType, keys: Sequence[str], whole: Sequence[str]):
        self.state, self.keys, self.whole = state, list(keys), set(whole)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(STATE, self.state)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        state = self.last.get()
        # entity -> itself, hash, at and the keys
        known = {} if state is None else {row[0]: tuple(row) for row in state[0]}
        came = pd.concat(list(rows), ignore_index=True)
        # hashes decide between rows of one moment, so that their order of arrival does not
        came = came.sort_values([_ENTITY, _AT, _HASH], ignore_index=True, kind="stable")
        keys = list(zip(*[came[k] for k in self.keys], strict=True))
        numbers = [k in self.whole for k in self.keys]
        changed, taken = [], False
        for at_row, (entity, at, content) in enumerate(zip(came[_ENTITY], came[_AT], came[_HASH], strict=True)):
            at, before = _plain(at), known.get(entity)
            if before is not None and not at >= before[2]:
                continue
            if before is None or before[1] != content:
                changed.append(at_row)
            of_entity = tuple(map(_plain, keys[at_row], numbers)) if before is None else before[3:]
            known[entity] = (entity, int(content), at, *of_entity)
            taken = True
        if taken:
            self.last.update((list(known.values()),))
        if changed:
            yield came.iloc[changed].drop(columns=[_BUCKET, _ENTITY, _HASH, _AT])

    def close(self) -> None:
        pass


def _plain(value, number: bool = False):
    """The value as the state takes it; of a ``number`` it is the text."""
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    if hasattr(value, "tolist"):
        value = value.tolist()
    if pd.api.types.is_scalar(value) and pd.isna(value):
        return None
    return int(value) if number else value


def _entity(df: DataFrame, keys: Sequence[str]) -> Column:
    """The keys as one text, which differs for different keys; NULL is a key like any other."""
    # both zeros are one key, as in a grouping
    zeros = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType | T.FloatType)}
    parts = [(named(k) + F.lit(0.0) if k in zeros else named(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    return F.to_json(F.struct(*parts), _EXACT)


def changes_only(
    df: DataFrame, keys: Sequence[str], sequence_by: str, ignored: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Rows of a stream that differ from the row of their entity before them, the first one of each entity included.

    Rows are compared on all columns but the keys, ``sequence_by`` and ``ignored``, by a hash of 64 bits. Within a
    micro-batch they are taken in the order of ``sequence_by``. A row that is older than the last one its entity has
    shown comes too late to change anything and is left out, as is one without a ``sequence_by``. NULL keys are an entity of their
    own. The session must keep its state in RocksDB (``stateful_session``).

    Entities are dealt into ``buckets`` by a hash of their keys. The rows that a bucket has in one micro-batch are sorted in
    one task, and a bucket that any row came for has its state written anew, so more entities ask for more buckets. Their
    number is fixed for the life of a checkpoint.
    """
    content = [c for c in df.columns if c not in (*keys, sequence_by, *ignored)]
    plain = {c: f"c{i}" for i, c in enumerate(df.columns)}
    # as text: pandas makes floating point numbers of whole ones with a NULL among them, which lose the last digits of large ones
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.LongType)}
    entity = _entity(df, keys)
    hashed = df.where(named(sequence_by).isNotNull()).select(
        *[(named(c).cast("string") if c in whole else named(c)).alias(name) for c, name in plain.items()],
        F.xxhash64(*map(named, content)).alias(_HASH),
        named(sequence_by).alias(_AT),
        entity.alias(_ENTITY),
        F.pmod(F.xxhash64(entity), F.lit(buckets)).alias(_BUCKET),
    )
    of_entity = T.StructType(
        [T.StructField(_ENTITY, T.StringType()), T.StructField(_HASH, T.LongType()), T.StructField(_AT, df.schema[sequence_by].dataType)]
        + [T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    )
    state = T.StructType([T.StructField(_ROWS, T.ArrayType(of_entity))])
    output = T.StructType([T.StructField(plain[f.name], T.StringType() if f.name in whole else f.dataType) for f in df.schema])
    processor = _Changed(state, [plain[k] for k in keys], [plain[c] for c in whole])
    changed = hashed.groupBy(_BUCKET).transformWithStateInPandas(processor, output, "append", "none")
    return changed.select(*[F.col(name).cast(df.schema[c].dataType).alias(c) for c, name in plain.items()])


def read_last(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The state of a stream of ``changes_only``: the keys of every entity, the ``hash`` of its last row and when it was ``at``."""
    buckets = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    rows = buckets.select(F.explode(F.col("value").getField(_ROWS)).alias("row"))
    return rows.select(*[F.col("row").getField(f"k{i}").alias(k) for i, k in enumerate(keys)], f"row.{_HASH}", f"row.{_AT}")
