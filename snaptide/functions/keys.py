from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the suffix of every entity key.
KEY_SUFFIX = "_123"


def entity_key(name: Column | str, suffix: str = KEY_SUFFIX) -> Column:
    """Stable key of an entity: its name in lower case, without whitespace, plus a suffix."""
    column = F.col(name) if isinstance(name, str) else name
    return F.concat(F.lower(F.regexp_replace(column, r"\s+", "")), F.lit(suffix))


def constant_key(*parts: str) -> Column:
    """The same key for every row, for a source that describes one entity only."""
    return F.concat(*[F.lit(part) for part in parts])
