"""Update-or-insert of a batch into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import named
from .latest import first_rows

FLAG = "update_flag"
UPDATED = "U"
INSERTED = "I"
# Kept in a compacted change log: the runs that inserted a key and that changed it last.
FIRST = "__first_run"
CHANGED = "__changed_run"


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def has_key(keys: Sequence[str]) -> Column:
    return _all([named(k).isNotNull() for k in keys])


def rejected_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a batch that an upsert leaves out because a key column is NULL."""
    return batch.where(~has_key(keys))


def reduce_batch(
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str | None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest by ``sequence_by``.

    Rows level on ``sequence_by`` are decided by ``tiebreak``, by default all
    other columns, so the result does not depend on the order of delivery.
    Without ``sequence_by`` nothing says which duplicate is right, and a key
    that occurs twice fails the job.
    """
    keyed = batch.where(has_key(keys))
    rest = [c for c in batch.columns if c not in keys]
    if sequence_by is not None:
        others = [
            f.name
            for f in batch.schema
            if f.name in rest and f.name != sequence_by and "map<" not in f.dataType.simpleString()
        ]
        return first_rows(keyed, keys, [sequence_by, *(tiebreak or others)])
    message = F.concat(F.lit("duplicate key in batch: "), F.to_json(F.struct(*map(named, keys))))
    return (
        keyed.groupBy(*map(named, keys))
        .agg(F.any_value(F.struct(*map(named, rest))).alias("__row"), F.count("*").alias("__copies"))
        .where(F.when(F.col("__copies") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        .select(*[named(c) if c in keys else F.col("__row").getField(c).alias(c) for c in batch.columns])
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    sequence_by: str | None = None,
    tiebreak: Sequence[str] = (),
    flag: str = FLAG,
) -> DataFrame:
    """State of ``target`` after ``source`` is merged into it.

    A matched row takes ``update_columns`` (all non-key columns of the target
    by default) from the source, also when the new value is NULL, and is
    flagged ``U``. An unmatched source row is inserted and flagged ``I``.
    Other target rows stay and have a NULL flag. With ``sequence_by`` an older
    source row does not overwrite a newer target row, and a row that wins always leaves its
    sequence, listed or not.

    It is written as two legs, not as a full outer join: the update leg is a
    left join; the insert leg finds the keys of the batch that the target has by a semi join
    and leaves them out. So a small batch is broadcast
    (by size, Spark's own check) and the target is shuffled in neither leg; a large one
    is a sort-merge join whose left side adaptive execution may split.
    """
    payload = [c for c in target.columns if c not in keys and c != flag]
    updates = list(payload if update_columns is None else update_columns)
    if sequence_by is not None and sequence_by not in updates:
        updates.append(sequence_by)
    missing = [c for c in [*keys, *updates] if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks {missing}")
    batch = reduce_batch(source, keys, sequence_by, tiebreak)

    incoming = batch.select(
        *[named(k).alias(f"__key_{k}") for k in keys],
        F.struct(*[named(c) for c in batch.columns]).alias("__new"),
    )
    same_key = _all([named(k) == named(f"__key_{k}") for k in keys])
    wins = F.col("__new").isNotNull()
    if sequence_by is not None:
        held = named(sequence_by)
        wins = wins & (held.isNull() | (F.col("__new").getField(sequence_by) >= held))
    # NULL >= x is unknown, which must count as "does not win".
    wins = F.coalesce(wins, F.lit(False))

    def updated(column: str) -> Column:
        if column not in updates:
            return named(column)
        new = F.col("__new").getField(column)
        return F.when(wins, new).otherwise(named(column)).alias(column)

    columns = [c for c in target.columns if c != flag]
    update_leg = target.join(incoming, same_key, "left").select(
        *[updated(c) for c in columns], F.when(wins, F.lit(UPDATED)).alias(flag)
    )
    asked = batch.select(*[named(k).alias(f"__key_{k}") for k in keys])
    known = target.select(*map(named, keys)).join(asked, same_key, "left_semi").distinct()
    known = known.select(*[named(k).alias(f"__key_{k}") for k in keys])
    types = {field.name: field.dataType for field in target.schema}
    insert_leg = batch.join(known, same_key, "left_anti").select(
        *[
            named(c) if c in batch.columns else F.lit(None).cast(types[c]).alias(c)
            for c in columns
        ],
        F.lit(INSERTED).alias(flag),
    )
    return update_leg.unionByName(insert_leg)


def current_state(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | None = None,
    run: int | None = None,
    run_column: str = "run_id",
    flag: str = FLAG,
    update_columns: Sequence[str] | None = None,
    provenance: bool = False,
) -> DataFrame:
    """State after every run of a change log, one row per key.

    ``changes`` holds one row per key and run. Reading it is the same as
    upserting run after run: the greatest ``sequence_by`` wins, a later run
    wins among equals, and the flags describe ``run`` (the last one). Runs
    after ``run`` are left out, which is the table as of that version. With ``update_columns`` the
    others keep the value a key was inserted with. One
    aggregation, combined map-side, replaces a rewrite of the target per run.

    Rows of a compacted log bring ``FIRST`` and ``CHANGED``, which count in place of their run; with
    ``provenance`` the result has these columns.
    """
    seen = changes if run is None else changes.where(F.col(run_column) <= run)
    origin = F.col(run_column)
    first = F.coalesce(F.col(FIRST), origin) if FIRST in changes.columns else origin
    changed = F.coalesce(F.col(CHANGED), origin) if CHANGED in changes.columns else origin
    hidden = (run_column, FIRST, CHANGED)
    payload = [c for c in changes.columns if c not in keys and c not in hidden]
    updates = payload if update_columns is None else [*update_columns, *([sequence_by] if sequence_by else [])]
    seen = seen.select(*map(named, [*keys, *payload]), first.alias(FIRST), changed.alias(CHANGED))
    order = [CHANGED] if sequence_by is None else [sequence_by, CHANGED]
    newest = [c for c in payload if c in updates]
    oldest = [c for c in payload if c not in updates]
    aggregates = [
        F.max_by(F.struct(CHANGED, *map(named, newest)), F.struct(*map(named, order))).alias("__new"),
        F.min(FIRST).alias("__first"),
    ]
    if oldest:
        aggregates.append(F.min_by(F.struct(*map(named, oldest)), F.struct(FIRST, CHANGED)).alias("__old"))
    state = seen.groupBy(*map(named, keys)).agg(*aggregates)
    last = F.col("__new").getField(CHANGED)

    def taken(column: str) -> Column:
        if column in keys:
            return named(column)
        return F.col("__new" if column in updates else "__old").getField(column).alias(column)

    columns = [last.alias(run_column) if c == run_column else taken(c) for c in changes.columns if c not in (FIRST, CHANGED)]
    if provenance:
        columns += [F.col("__first").alias(FIRST), last.alias(CHANGED)]
    if run is None:
        return state.select(*columns)
    verdict = F.when((last == run) & (F.col("__first") < run), F.lit(UPDATED)).when(last == run, F.lit(INSERTED))
    return state.select(*columns, verdict.alias(flag))
