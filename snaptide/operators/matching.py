from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.names import named


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal names in which NULL matches NULL; the left names survive."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = None
    for key in keys:
        same = named(key).eqNullSafe(named(f"__right_{key}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])
