"""Projections, cleaning, pivots, JSON and HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import constant_key, entity_key, total_contributions
from ..operators import cleaning, dedupe, reshape
from ..operators.ranking import top_k as first_rows
from ..plans.audit import audit_rows
from ..sources import html
from .registry import query, table


# Character references that the pages hold, the ampersand last.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&amp;": "&"}


def _decoded_sql(text: str) -> str:
    for reference, character in _REFERENCES.items():
        text = f"replace({text}, '{reference}', '{character}')"
    return text


@query(
    "SELECT c_custkey, lower(regexp_replace(c_name, '\\s+', '', 'g')) || '_123' AS entity_id FROM customer", "entity_key"
)
def entity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", entity_key("c_name").alias("entity_id"))


@query(
    """SELECT s_suppkey, 'supplier_td_123' AS source_id,
  lower(regexp_replace(s_name, '\\s+', '', 'g')) || '-x' AS entity_id FROM supplier"""
)
def constant_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key shared by the whole source beside a key with another suffix."""
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", constant_key("supplier_td", "_123").alias("source_id"), entity_key("s_name", "-x").alias("entity_id")
    )


@query("SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_extendedprice + l_tax AS gross FROM lineitem")
def rename_derive_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .transform(reshape.rename_columns, {"l_orderkey": "order_id", "l_linenumber": "line_no"})
        .transform(reshape.add_totals, {"gross": ("l_extendedprice", "l_tax")})
        .transform(reshape.select_columns, ["order_id", "line_no", "gross"])
    )


@query("SELECT s_suppkey, s_name, DATE '2024-01-31' AS match_date, 'src' AS origin FROM supplier")
def literal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    dated = reshape.with_constant(suppliers, "match_date", F.lit("2024-01-31").cast("date"))
    return reshape.with_constant(dated, "origin", "src")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("SELECT DISTINCT user_id, event_type FROM events")
def drop_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.drop_duplicates(table(spark, sf_dir, "events").select("user_id", "event_type"))


@query(
    """SELECT user_id, round(sum(value) FILTER (event_type = 'click'), 2) AS click,
  round(sum(value) FILTER (event_type = 'error'), 2) AS error,
  round(sum(value) FILTER (event_type = 'purchase'), 2) AS purchase,
  round(sum(value) FILTER (event_type = 'signup'), 2) AS signup,
  round(sum(value) FILTER (event_type = 'view'), 2) AS "view" FROM events GROUP BY user_id"""
)
def pivot_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.pivot_sum(
        table(spark, sf_dir, "events"),
        ["user_id"],
        "event_type",
        ["click", "error", "purchase", "signup", "view"],
        F.round(F.sum("value"), 2),
    )


@query(
    """SELECT o_orderstatus AS operation, CAST(year(o_orderdate) AS BIGINT) AS version,
  count(*) AS "numOutputRows", CAST(sum(o_custkey) AS BIGINT) AS "numOutputBytes" FROM orders GROUP BY ALL"""
)
def audit_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric maps of text values exploded, cast and pivoted into columns.

    A history row stands for one operation and year; its metrics come from the
    orders of that year. ``ignored`` is text that is no number.
    """
    counted = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("operation"), F.year("o_orderdate").cast("bigint").alias("version"))
        .agg(F.count("*").alias("rows"), F.sum("o_custkey").alias("bytes"))
    )
    history = counted.select(
        "operation",
        "version",
        F.create_map(
            F.lit("numOutputRows"), F.col("rows").cast("string"),
            F.lit("numOutputBytes"), F.col("bytes").cast("string"),
            F.lit("ignored"), F.lit("n/a"),
        ).alias("operationMetrics"),
    )
    return audit_rows(history, ["numOutputRows", "numOutputBytes"], ["operation", "version"])


@query(
    """SELECT event_id, 'event_type' AS key, event_type AS value FROM events
UNION ALL SELECT event_id, 'k', props->>'$.k' FROM events"""
)
def explode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.create_map(
            F.lit("event_type"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k")
        ).alias("m"),
    )
    return reshape.explode_map(events, "m")


@query(
    """SELECT event_id, v[1] AS f1, v[2] AS f2, v[3] AS f3 FROM (SELECT event_id, list_filter(
  [CASE WHEN event_type <> 'view' THEN event_type END, NULL, CAST(user_id AS VARCHAR)], lambda x: x IS NOT NULL) AS v
  FROM events)"""
)
def row_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.col("user_id").alias("c"),
    )
    return cleaning.compact_row(events, ["a", "b", "c"], ["f1", "f2", "f3"])


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def drop_blank_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.lit(" ").alias("gap"), "lang", F.lit(None).cast("int").alias("empty"), "source", "n_chars"
    )
    return cleaning.drop_blank_columns(documents)


@query(
    """SELECT doc_id, md5(regexp_replace(regexp_replace(text, ',+', ',', 'g'), ', ,', ',', 'g')) AS clean_md5
FROM documents"""
)
def separator_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cleaning.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return lines.select("doc_id", F.md5("text").alias("clean_md5"))


@query("SELECT p_partkey AS id, p_name AS label, p_retailprice AS price FROM part")
def assign_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by position; padding columns dropped."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size", "p_brand")
    return cleaning.assign_names(parts, ["id", "label", "price", "pad_1", "pad_2"], drop=["pad_1", "pad_2"])


@query("SELECT event_id, CAST(props->>'$.k' AS INT) AS props_k FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = T.StructType([T.StructField("k", T.IntegerType())])
    parsed = table(spark, sf_dir, "events").select("event_id", F.from_json("props", props).alias("props"))
    return reshape.flatten(parsed)


@query(
    f"""SELECT page_id, CAST(cell_no AS INT) AS cell_no,
  {_decoded_sql("trim(regexp_replace(regexp_replace(raw, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))")} AS cell_text FROM (
  SELECT page_id, unnest(m) AS raw, generate_subscripts(m, 1) AS cell_no FROM (
    SELECT page_id, regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS m FROM pages))"""
)
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.html_cells(table(spark, sf_dir, "pages"), ["page_id"], tag="li")


@query(
    f"""SELECT page_id, 0 AS table_no, CAST(cell_no AS INT) AS row_no, {_decoded_sql("raw_link")} AS link,
  {_decoded_sql("trim(regexp_replace(raw, '<[^>]*>', '', 'g'))")} AS label FROM (
  SELECT page_id, raw, regexp_extract(raw, 'href="([^"]*)"', 1) AS raw_link, cell_no FROM (
    SELECT page_id, unnest(m) AS raw, generate_subscripts(m, 1) AS cell_no FROM (
      SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS m FROM pages)))"""
)
def html_table_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows as records. The navigation list of each page is first written as a table."""
    as_table = F.regexp_replace(
        "html", r'<li><a href="([^"]*)">(.*?)</a></li>', '<tr>\n<td>$1</td><td class="n"><b>$2</b></td></tr>'
    )
    header = '<table id="t" class="wide leaguetable"><tr><th>link</th><th>label</th></tr>'
    as_table = F.regexp_replace(as_table, r"<nav><ul>", header)
    as_table = F.regexp_replace(as_table, r"</ul></nav>", "</table>")
    pages = table(spark, sf_dir, "pages").select("page_id", as_table.alias("html"))
    return html.table_records(html.html_table_rows(pages, ["page_id"]), ["link", "label"]).drop("more_cells")


@query(
    f"""SELECT page_id, 1 AS cell_no, {_decoded_sql("trim(regexp_replace(title, '\\s+', ' ', 'g'))")} AS cell_text FROM (
  SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages
  WHERE contains(html, '<title>'))"""
)
def html_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages with their character references decoded; a commented-out copy of each is not read."""
    twice = F.concat(F.lit("<!-- <title>no</title> -->"), F.col("html"))
    pages = table(spark, sf_dir, "pages").select("page_id", twice.alias("html"))
    return html.html_cells(pages, ["page_id"], tag="title")


@query(
    """SELECT user_id, count(*) FILTER (event_type = 'purchase') + count(*) FILTER (event_type = 'signup')
  AS contributions FROM events GROUP BY user_id ORDER BY contributions DESC, user_id LIMIT 20"""
)
def contributions_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of two counters in which a missing one means none, top k."""
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.sum(F.when(F.col("event_type") == "purchase", 1)).alias("a"),
        F.sum(F.when(F.col("event_type") == "signup", 1)).alias("b"),
    )
    total = total_contributions(F.col("a"), F.col("b")).alias("contributions")
    return first_rows(counted.select("user_id", total), [("contributions", "desc"), ("user_id", "asc")], 20)
