from __future__ import annotations

from pyspark.sql import Column, functions as F


def named(name: str) -> Column:
    """Column of exactly this name; a dot in it is not read as a field access."""
    return F.col("`" + name.replace("`", "``") + "`")
