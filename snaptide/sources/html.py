"""Rows of HTML tables and flat HTML elements.

Built on regular expressions, so elements of the same tag inside each other
and unclosed tags are not resolved; ``unreadable_tables`` counts those tables.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import decoded, decoded_each, strip_tags, without_comments


def _inner(fragment: Column, tag: str, attributes: str = r"(?:\s[^>]*)?") -> Column:
    return F.regexp_extract_all(fragment, F.lit(f"(?is)<{tag}{attributes}>(.*?)</{tag}>"), 1)


def html_cells(pages: DataFrame, keys: Sequence[str], html: str = "html", tag: str = "td") -> DataFrame:
    """Text of every ``tag`` element of a page, numbered from 1; comments are left out, entities decoded."""
    found = _inner(without_comments(F.col(html)), tag)
    cells = pages.select(*keys, F.posexplode(found).alias("__at", "__raw"))
    return cells.select(*keys, (F.col("__at") + 1).alias("cell_no"), decoded(strip_tags(F.col("__raw"))).alias("cell_text"))


def html_table_rows(
    pages: DataFrame, keys: Sequence[str], html: str = "html", table_class: str = "leaguetable"
) -> DataFrame:
    """Rows of the tables with a class, as arrays of cell text; row 0 is the header."""
    name = re.escape(table_class)
    wanted = rf"\s(?:[^>]*\s)?class=[\"'](?:[^\"'>]*\s)?{name}(?:\s[^\"'>]*)?[\"'][^>]*"
    tables = pages.select(
        *keys, F.posexplode(_inner(without_comments(F.col(html)), "table", wanted)).alias("table_no", "__table")
    )
    rows = tables.select(*keys, "table_no", F.posexplode(_inner(F.col("__table"), "tr")).alias("row_no", "__row"))
    cells = F.transform(_inner(F.col("__row"), "t[dh]"), strip_tags)
    return rows.select(*keys, "table_no", "row_no", decoded_each(cells).alias("cells"))


def table_records(rows: DataFrame, names: Sequence[str], more: str = "more_cells") -> DataFrame:
    """Data rows (not the header) with their cells as named text columns.

    Cells beyond the names are kept in the array ``more``; a row with too few has NULLs. ``uneven_rows``
    lists both kinds.
    """
    others = [c for c in rows.columns if c != "cells"]
    beyond = F.slice("cells", len(names) + 1, F.greatest(F.size("cells") - len(names), F.lit(0)))
    return rows.where(F.col("row_no") > 0).select(
        *others, *[F.get(F.col("cells"), F.lit(i)).alias(name) for i, name in enumerate(names)], beyond.alias(more)
    )


def uneven_rows(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Data rows whose number of cells is not that of the names."""
    return rows.where((F.col("row_no") > 0) & (F.size("cells") != len(names)))


def unreadable_tables(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Pages in which table tags do not alternate: unclosed, unopened or nested tables.

    ``tags`` shows the tags in their order, ``o`` for opened and ``c`` for closed.
    """
    slashes = F.regexp_extract_all(without_comments(F.col(html)), F.lit(r"(?i)<(/?)table(?=[\s>])"), 1)
    tags = F.array_join(F.transform(slashes, lambda slash: F.when(slash == "", "o").otherwise("c")), "")
    wrong = (
        F.contains("tags", F.lit("oo"))
        | F.contains("tags", F.lit("cc"))
        | F.startswith("tags", F.lit("c"))
        | F.endswith("tags", F.lit("o"))
    )
    return pages.select(*keys, tags.alias("tags")).where(wrong)
