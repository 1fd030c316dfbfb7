"""HTML tables with tables inside them and cells that span rows and columns.

A page is cut into tags and stretches of text. The running number of open tables is the depth of each of them;
among the tokens of one depth the last row or cell that was opened owns what follows, whatever deeper tables lie between. That is
a few windows over one shuffle of the pages, so the tokens of a page of any size are sorted and not held; pages without a table are not cut at all.

Pages become many times larger as tokens, and cells as a grid, which a plan cannot know. So the pages, and the cells, are written once and
weighed, and dealt into as many parts as their weight asks for: more input makes more tasks, not larger ones.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.names import named
from ..functions.text import decoded, without_comments
from ..scratch import materialize

# --- fixed values of HTML: what is not shown, what breaks a line of text, the largest spans ---
_HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
_BREAKS = r"(?i)^</?(?:br|p|div|li|ul|ol|h[1-6]|hr|dd|dt|dl|blockquote|pre)\b"
_MOST_COLUMNS, _MOST_ROWS = 1000, 65534
# --- end of fixed values ---

# About the bytes that a task sorts at a time: those of the text, and what a token, a cell or a slot takes beside it.
_PART, _EACH = 48 * 1024 * 1024, 160

_TOKENS = r"""(?is)<(?:/?(?:table|tr|td|th)\b)(?:[^>"']|"[^"]*"|'[^']*')*>|<[/!?a-z][^>]*>|[^<]+|<"""
_NAME = r"(?i)^</?(table|tr|td|th)\b"


def _dealt(df: DataFrame, keys: Sequence[str], weight: Column, label: str) -> DataFrame:
    """``df``, written once, in parts by ``keys`` of about equal weight."""
    rows = materialize(df, label)
    total = rows.agg(F.sum(weight.cast("double"))).first()[0] or 0
    return rows.repartition(int(total // _PART) + 1, *map(named, keys))


def _tokens(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """Tags and stretches of text of each page that has a table tag, with the ``depth`` of tables they lie in.

    Every token of a page is in one part, in the order of ``at``; ``table_no`` numbers the tables in the order they open.
    """
    shown = F.regexp_replace(without_comments(named(html)), _HIDDEN, " ")
    some = pages.where(F.lower(named(html)).rlike(r"</?table[\s>/]")).select(*map(named, dict.fromkeys([*keys, html])))
    # a tag, and the text behind it
    tags = F.length(named(html)) - F.length(F.replace(named(html), F.lit("<"), F.lit("")))
    some = _dealt(some, keys, F.length(named(html)) + 2 * _EACH * tags, "pages")
    cut = some.select(*map(named, keys), F.posexplode(F.regexp_extract_all(shown, F.lit(_TOKENS), 0)).alias("at", "token"))
    tag = cut.withColumn("tag", F.lower(F.regexp_extract("token", _NAME, 1))).withColumn("ends", F.startswith("token", F.lit("</")))
    table = F.col("tag") == "table"
    step = F.when(table, F.when(F.col("ends"), -1).otherwise(1)).otherwise(0)
    upto = Window.partitionBy(*map(named, keys)).orderBy("at")
    open_ = tag.withColumn("open", F.sum(step).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    deep = open_.withColumn("depth", F.col("open") + F.when(table & F.col("ends"), 1).otherwise(0))
    opened = F.when(table & ~F.col("ends") & (F.col("depth") > 0), 1).otherwise(0)
    return deep.withColumn("table_no", F.sum(opened).over(upto.rowsBetween(Window.unboundedPreceding, 0)) - 1)


def broken_tables(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Pages whose table tags do not pair: the keys, how many tables stay open and how many end that were not opened."""
    tokens = _tokens(pages, keys, html).where("tag = 'table'")
    lowest = F.min(F.least("open", F.lit(0)))
    last = F.max_by("open", "at")
    found = tokens.groupBy(*map(named, keys)).agg((last - lowest).alias("unclosed"), (-lowest).alias("unopened"))
    return found.where("unclosed > 0 OR unopened > 0")


def _span(token: Column, name: str, most: int) -> Column:
    """The span of a cell; none or one that is no number is 1, and 0 rows are all that follow."""
    text = F.regexp_extract(token, rf"""(?i)\s{name}\s*=\s*["']?\s*(\d{{1,9}})""", 1).try_cast("int")
    least = F.when(text == 0, most if name == "rowspan" else 1).otherwise(text)
    return F.least(F.coalesce(least, F.lit(1)), F.lit(most))


def table_cells(pages: DataFrame, keys: Sequence[str], html: str = "html", table_class: str | None = None) -> DataFrame:
    """Every cell of every table of a page, tables inside cells included.

    ``table_no`` numbers the tables of a page in the order they open, ``parent_no`` is the table a table lies in (or NULL) and ``depth`` how many it
    lies in, itself included. Rows and cells count from 0. ``text`` is that of the cell without the tables in
    it, with references decoded and white space collapsed. Rows and cells may lack their end tags; cells before the first
    row tag are in row 0. A ``table_class`` keeps tables with that class. Pages of ``broken_tables`` are read as
    far as they go.
    """
    by_page = [named(k) for k in keys]
    tokens = _tokens(pages, keys, html).where("depth > 0")
    level = Window.partitionBy(*by_page, "depth").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    opens = (F.col("tag") == "table") & ~F.col("ends")
    rows_open = F.sum(F.when((F.col("tag") == "tr") & ~F.col("ends"), 1).otherwise(0)).over(level)
    tokens = tokens.withColumn("rows_open", rows_open)
    # what a token lies in: the last table that was opened at its depth, and the last tag there
    of = F.last(F.when(opens, F.struct("at", "table_no", "rows_open")), ignorenulls=True).over(level)
    mark = F.last(F.when(F.col("tag") != "", F.struct("at", "tag", "ends")), ignorenulls=True).over(level)
    tokens = tokens.withColumns({"of": of, "last": mark})
    inside = F.col("last.tag").isin("td", "th") & ~F.col("last.ends")
    begins = F.col("tag").isin("td", "th") & ~F.col("ends")
    piece = F.when(F.col("tag") != "", "").when(F.col("token").rlike(_BREAKS), " ").when(F.col("token").rlike(r"(?i)^<[/!?a-z]"), "")
    pieces = F.collect_list(F.when(inside, F.struct("at", piece.otherwise(F.col("token")).alias("piece"))))
    wanted = F.lit(True)
    if table_class is not None:
        name = re.escape(table_class)
        wanted = F.col("token").rlike(rf"""(?i)\sclass\s*=\s*(?:{name}[\s>/]|["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'])""")
    # a row for each cell, and one without ``cell_at`` for each table
    cells = (
        tokens.where((inside | opens) & F.col("of").isNotNull())
        .groupBy(*by_page, "depth", F.col("of.at").alias("table_at"), F.col("of.table_no").alias("table_no"), F.when(inside, F.col("last.at")).alias("cell_at"))
        .agg(
            F.max(F.when(begins, F.col("token"))).alias("token"),
            F.min(F.greatest(F.col("rows_open") - F.col("of.rows_open") - 1, F.lit(0))).alias("row_no"),
            F.array_join(F.transform(F.array_sort(pieces), lambda p: p["piece"]), "").alias("raw"),
            F.bool_or(opens & wanted).alias("wanted"),
        )
    )
    cell = F.col("cell_at").isNotNull()
    in_row = Window.partitionBy(*by_page, "table_at", "row_no").orderBy("cell_at").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("cell_no", (F.count("cell_at").over(in_row) - 1).cast("int"))
    # the tables of a page
    tables = F.collect_list(F.when(~cell, F.struct(F.col("table_at").alias("at"), "depth", "table_no", "wanted")))
    cells = cells.withColumn("tables", tables.over(Window.partitionBy(*by_page))).where(cell)
    above = F.filter("tables", lambda t: (t["depth"] == F.col("depth") - 1) & (t["at"] < F.col("table_at")))
    if table_class is not None:
        cells = cells.where(F.exists("tables", lambda t: (t["at"] == F.col("table_at")) & t["wanted"]))
    text = F.trim(F.regexp_replace("raw", r"\s+", " "))
    return cells.select(
        *by_page,
        F.col("table_no").cast("int").alias("table_no"),
        F.array_max(above)["table_no"].cast("int").alias("parent_no"),
        F.col("depth").cast("int").alias("depth"),
        F.col("row_no").cast("int").alias("row_no"),
        "cell_no",
        F.startswith(F.lower("token"), F.lit("<th")).alias("is_header"),
        _span(F.col("token"), "colspan", _MOST_COLUMNS).alias("columns"),
        _span(F.col("token"), "rowspan", _MOST_ROWS).alias("rows"),
        decoded(text).alias("text"),
    )


def _slot(cell: Column, first: Column) -> Column:
    return F.struct(
        cell["row_no"].alias("row"),
        first.alias("first"),
        cell["columns"].alias("columns"),
        cell["rows"].alias("rows"),
        cell["text"].alias("text"),
    )


def _placed(cells: Column) -> Column:
    """Cells of a table, in their order, each with the first free column of its row.

    ``held`` are the columns that cells of earlier rows still hold, with the last row they do; a fold keeps them and the next free column.
    """
    start = F.struct(
        F.lit(-1).alias("row"),
        F.lit(0).alias("next"),
        F.expr("cast(array() AS array<struct<low:int, high:int, upto:int>>)").alias("held"),
        F.expr("cast(array() AS array<struct<row:int, first:int, columns:int, rows:int, text:string>>)").alias("out"),
    )

    def put(state: Column, cell: Column) -> Column:
        free = F.when(state["row"] == cell["row_no"], state["next"]).otherwise(F.lit(0))
        held = F.filter(state["held"], lambda h: h["upto"] >= cell["row_no"])
        maybe = F.concat(F.array(free), F.transform(held, lambda h: h["high"] + 1))
        fits = F.filter(maybe, lambda c: (c >= free) & ~F.exists(held, lambda h: (h["low"] <= c) & (c <= h["high"])))
        at = F.array_min(fits)
        more = F.struct(at.alias("low"), (at + cell["columns"] - 1).alias("high"), (cell["row_no"] + cell["rows"] - 1).alias("upto"))
        return F.struct(
            cell["row_no"].alias("row"),
            (at + cell["columns"]).alias("next"),
            F.when(cell["rows"] > 1, F.array_append(held, more)).otherwise(held).alias("held"),
            F.array_append(state["out"], _slot(cell, at)).alias("out"),
        )

    return F.aggregate(cells, start, put, lambda state: state["out"])


def table_grid(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``table_cells`` as a grid: ``cells`` has the text of each column, that of a spanning cell in all it covers.

    A column no cell covers is NULL. A span of rows ends with the table. Where cells overlap, the later one is shown.
    """
    table = [*map(named, keys), F.col("table_no"), F.col("parent_no"), F.col("depth")]
    cell = F.struct("row_no", "cell_no", "columns", "rows", "text")
    # spans of rows end with the table, so the length of long ones says little
    slots = F.col("columns") * F.least("rows", F.lit(64))
    dealt = _dealt(cells, [*keys, "table_no"], slots * (F.length("text") + _EACH), "cells")
    whole = dealt.groupBy(*table).agg(F.array_sort(F.collect_list(cell)).alias("__cells"), F.max("row_no").alias("__last"))
    # without spans a cell's column is its number
    spans = F.exists("__cells", lambda c: (c["rows"] > 1) | (c["columns"] > 1))
    as_is = F.transform("__cells", lambda c: _slot(c, c["cell_no"]))
    placed = F.when(spans, _placed(F.col("__cells"))).otherwise(as_is)
    one = whole.select(*table, "__last", F.posexplode(placed).alias("__order", "__cell"))
    down = F.sequence(F.col("__cell.row"), F.least(F.col("__cell.row") + F.col("__cell.rows") - 1, F.col("__last")))
    spread = one.select(*table, "__order", "__cell", F.explode(down).alias("row_no"))
    across = F.sequence(F.col("__cell.first"), F.col("__cell.first") + F.col("__cell.columns") - 1)
    slots = spread.select(*table, "row_no", "__order", F.col("__cell.text").alias("text"), F.explode(across).alias("column"))
    slots = slots.groupBy(*table, "row_no", "column").agg(F.max_by("text", "__order").alias("text"))
    rows = slots.groupBy(*table, "row_no").agg(
        F.max("column").alias("__width"), F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("__texts")
    )
    texts = F.transform(F.sequence(F.lit(0), F.col("__width")), lambda c: F.col("__texts")[c])
    return rows.select(*table, "row_no", texts.alias("cells"))
