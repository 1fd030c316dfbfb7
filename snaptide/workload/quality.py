"""Quality suites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import dedupe, quality
from ..plans.gold import latest_table
from ..schemas import TABLE_COLUMNS
from ..scratch import materialize
from .derived import STANDINGS_SQL
from ..operators.sketches import distinct_over, relative_error, sketches
from ..scratch import work_area
from ..sinks.publish import append_files
from ..sources.files import read_table
from .registry import query, table
from .snapshots import _LATEST_SQL, _silver


@query(
    """SELECT 'row_count' AS check_name, NULL::VARCHAR AS column_name, count(*) AS observed FROM lineitem
UNION ALL SELECT 'distinct', 'l_orderkey', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'null', 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem
UNION ALL SELECT 'negative', 'l_quantity', count(*) FILTER (l_quantity < 0) FROM lineitem
UNION ALL SELECT 'range', 'l_linenumber', count(*) FILTER (l_linenumber < 1 OR l_linenumber > 4) FROM lineitem
UNION ALL SELECT 'formula', 'l_linenumber', count(*) FILTER (l_linenumber + 1 <> l_orderkey % 7) FROM lineitem
UNION ALL SELECT 'duplicates', NULL, count(*) - count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber))
  FROM lineitem"""
)
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.run_suite(
        table(spark, sf_dir, "lineitem"),
        [
            quality.row_count(),
            quality.distinct_count("l_orderkey"),
            *quality.not_null("l_quantity"),
            *quality.not_negative("l_quantity"),
            quality.in_range("l_linenumber", 1, 4),
            quality.formula("l_linenumber", F.col("l_orderkey") % 7 - 1),
            quality.no_duplicates(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]),
        ],
    )
    return report.select("check_name", "column_name", "observed")


@query("SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1")
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"])


def _each(check: str, condition: str, columns) -> str:
    """SQL that counts the rows for which ``condition`` holds, column by column."""
    return "\n".join(
        f"UNION ALL SELECT '{check}', '{c}', 0, n, n = 0 FROM (SELECT count(*) FILTER ({condition.format(c=c)}) AS n FROM latest)"
        for c in columns
    )


@query(
    f"""{_LATEST_SQL}
SELECT 'row_count' AS check_name, NULL::VARCHAR AS column_name, 20::BIGINT AS expected, count(*) AS observed,
  count(*) = 20 AS passed FROM latest
UNION ALL SELECT 'distinct', 'team', 20, count(DISTINCT team), count(DISTINCT team) = 20 FROM latest
UNION ALL SELECT 'duplicates', NULL, 0, n, n = 0 FROM (SELECT (SELECT count(*) FROM latest) - count(*) AS n
  FROM (SELECT DISTINCT * FROM latest))
UNION ALL SELECT 'formula', 'matches_played', 0, n, n = 0 FROM (
  SELECT count(*) FILTER (matches_played <> wins + draws + losses) AS n FROM latest)
UNION ALL SELECT 'formula', 'points', 0, n, n = 0 FROM (
  SELECT count(*) FILTER (points <> 3 * wins + draws) AS n FROM latest)
UNION ALL SELECT 'formula', 'goal_difference', 0, n, n = 0 FROM (
  SELECT count(*) FILTER (goal_difference <> goals_for - goals_against) AS n FROM latest)
UNION ALL SELECT 'leader', 'ranking', 1, r, r = 1 FROM (
  SELECT ranking::BIGINT AS r FROM latest ORDER BY points DESC, ranking LIMIT 1)
{_each("null", "{c} IS NULL", TABLE_COLUMNS)}
UNION ALL SELECT 'range', 'ranking', 0, count(*) FILTER (ranking < 1 OR ranking > 20),
  count(*) FILTER (ranking < 1 OR ranking > 20) = 0 FROM latest
{_each("negative", "{c} < 0", quality.COUNTERS)}"""
)
def dq_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All league-table rules on the latest table, which has more than 20 teams here."""
    current = materialize(latest_table(_silver(spark, sf_dir), ties="break"), "table")
    return quality.run_suite(current, quality.standings_rules(20))


@query(
    f"""{STANDINGS_SQL} SELECT 'formula' AS check_name, 'goal_difference' AS column_name, 0::BIGINT AS expected,
  count(*) FILTER (goal_difference IS DISTINCT FROM CASE WHEN goals_for > 0 THEN goals_for - goals_against END)
  AS observed, count(*) FILTER (goal_difference IS DISTINCT FROM
  CASE WHEN goals_for > 0 THEN goals_for - goals_against END) = 0 AS passed FROM standings"""
)
def dq_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule in which NULL on one side is a violation."""
    expected = F.when(F.col("goals_for") > 0, F.col("goals_for") - F.col("goals_against"))
    return quality.run_suite(_silver(spark, sf_dir), [quality.formula("goal_difference", expected, null_safe=True)])


@query(
    """WITH days AS (SELECT DISTINCT last_day(o_orderdate) AS high FROM orders),
  ranges AS (SELECT (high - n)::DATE AS low, high FROM days, (VALUES (6), (89), (364)) r(n))
SELECT low, high, count(DISTINCT o_custkey) AS customers, true AS within_error FROM ranges
  LEFT JOIN orders ON o_orderdate::DATE BETWEEN low AND high GROUP BY low, high"""
)
def distinct_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order in the week, quarter and year up to every end of a month, from sketches per day that two deliveries stored.

    The exact numbers beside them are counted from the orders.
    """
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_custkey")
    path = work_area(spark, "sketches")
    cut = F.lit("1998-07-01").cast("date")
    for delivery in (orders.where(F.col("day") < cut), orders.where(F.col("day") >= cut)):
        append_files(sketches(delivery, ["day"], "o_custkey"), path)
    ends = orders.select(F.last_day("day").alias("high")).distinct()
    spans = F.array(*[F.lit(n) for n in (6, 89, 364)])
    ranges = ends.select("high", F.explode(spans).alias("n")).select(F.date_sub("high", F.col("n")).alias("low"), "high")
    estimated = distinct_over(read_table(spark, path), ranges, "day")
    days = ranges.withColumn("day", F.explode(F.sequence("low", "high")))
    exact = days.join(orders.distinct(), "day").groupBy("low", "high").agg(F.count_distinct("o_custkey").alias("customers"))
    customers = F.coalesce("customers", F.lit(0))
    near = F.abs(F.col("distinct_count") - customers) <= relative_error() * customers
    both = estimated.join(exact, ["low", "high"], "left")
    return both.select("low", "high", customers.alias("customers"), near.alias("within_error"))
