from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, functions as F


# What a regular expression takes for whitespace.
_BLANKS = " \t\n\x0b\f\r"


def blank_to_null(column: Column) -> Column:
    """NULL for text that is empty or only whitespace."""
    return F.when(F.btrim(column.cast("string"), F.lit(_BLANKS)) != "", column)


def collapse_separators(line: Column, separator: str = ",") -> Column:
    """Remove empty fields, then one-space fields, from a delimited line.

    A run of separators becomes one; then a field that is a single space goes. Of
    two such fields side by side one stays, since the separator between them is taken once.
    """
    runs = F.regexp_replace(line, F.lit(rf"(?:{re.escape(separator)}){{2,}}"), F.lit(separator.replace("$", r"\$")))
    return F.replace(runs, F.lit(f"{separator} {separator}"), F.lit(separator))


def strip_tags(fragment: Column) -> Column:
    """Text of an HTML fragment: tags removed, whitespace collapsed, ends trimmed; see ``decoded`` for entities."""
    plain = F.regexp_replace(fragment, r"<[^>]*>", "")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def without_comments(page: Column) -> Column:
    """A page without its comments, closed or not, so that nothing inside them is read."""
    return F.regexp_replace(page, r"(?s)<!--.*?(?:-->|\z)", "")


def _decode(text: str | None) -> str | None:
    return None if text is None else " ".join(html.unescape(text).split()) if "&" in text else text


def decoded(text: Column) -> Column:
    """Text with named and numeric character references decoded."""

    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(_decode)

    return F.pandas_udf(decode, "string")(text)


def decoded_each(texts: Column) -> Column:
    """``decoded`` for every element of an array."""

    def decode(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda cells: None if cells is None else [_decode(c) for c in cells])

    return F.pandas_udf(decode, "array<string>")(texts)
