"""Data-quality suite: rules on a table, reported as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.names import named
from ..schemas import TABLE_COLUMNS

# Columns of a league table that count something.
COUNTERS = [c for c in TABLE_COLUMNS if c not in ("ranking", "team", "goal_difference")]

REPORT = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("expected", T.LongType()),
        T.StructField("observed", T.LongType()),
        T.StructField("passed", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """One number that a table must show.

    ``observed`` is an aggregate over the table. A rule about distinct values
    names the columns in ``distinct`` instead: it needs its own grouping.
    """

    check_name: str
    column_name: str | None
    expected: int | None
    observed: Column | None = None
    distinct: tuple[str, ...] = ()
    copies: bool = False


def _violations(condition: Column) -> Column:
    # A comparison with NULL is unknown and does not count as a violation.
    return F.count(F.when(condition, F.lit(1)))


def row_count(expected: int | None = None) -> Rule:
    return Rule("row_count", None, expected, F.count(F.lit(1)))


def distinct_count(column: str, expected: int | None = None, approximate: bool = False) -> Rule:
    """Number of different values; NULL counts as a value.

    The approximate form needs no shuffle of the values and leaves NULL out.
    """
    if approximate:
        return Rule("distinct_approx", column, expected, F.approx_count_distinct(named(column)))
    return Rule("distinct", column, expected, distinct=(column,))


def no_duplicates(columns: Sequence[str]) -> Rule:
    """Rows beyond the first of each value; the number must be 0."""
    return Rule("duplicates", None, 0, distinct=tuple(columns), copies=True)


def not_null(*columns: str) -> list[Rule]:
    return [Rule("null", c, 0, _violations(named(c).isNull())) for c in columns]


def not_negative(*columns: str) -> list[Rule]:
    return [Rule("negative", c, 0, _violations(named(c) < 0)) for c in columns]


def in_range(column: str, low, high) -> Rule:
    return Rule("range", column, 0, _violations((named(column) < low) | (named(column) > high)))


def no_rejects(column: str) -> Rule:
    """No line that its reader could not parse (see ``read_snapshots(keep_rejects=True)``)."""
    return Rule("rejected", column, 0, _violations(named(column).isNotNull()))


def formula(column: str, expression: Column, null_safe: bool = False) -> Rule:
    """``column`` equals ``expression``. With ``null_safe`` a NULL on one side is a violation."""
    wrong = ~named(column).eqNullSafe(expression) if null_safe else named(column) != expression
    return Rule("formula", column, 0, _violations(wrong))


def leader_has_rank(measure: str, ranking: str = "ranking", expected: int = 1) -> Rule:
    """The row with most ``measure`` has the first rank; among equals the best rank counts."""
    leader = F.max_by(named(ranking), F.struct(named(measure), -named(ranking)))
    return Rule("leader", ranking, expected, leader.cast("bigint"))


def _report(totals: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report rows of one row with the observed numbers ``r0``, ``r1``, …"""

    def text(value: str | None) -> str:
        return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def row(i: int, rule: Rule) -> str:
        expected = "NULL" if rule.expected is None else str(rule.expected)
        passed = "true" if rule.expected is None else f"r{i} <=> {expected}"
        return (
            f"struct({text(rule.check_name)} AS check_name, CAST({text(rule.column_name)} AS STRING) AS column_name,"
            f" CAST({expected} AS BIGINT) AS expected, r{i} AS observed, {passed} AS passed)"
        )

    return totals.selectExpr(f"inline(array({', '.join(row(i, rule) for i, rule in enumerate(rules))}))")


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One report row per rule.

    All plain rules share one aggregate: one scan, no shuffle but of one row
    per task. A rule about distinct values reads only its own columns and
    counts groups that were combined map-side, which keeps the wide rows of
    the other rules out of its shuffle.
    """
    plain = [r for r in rules if not r.distinct]
    reports: list[DataFrame] = []
    if plain:
        totals = df.agg(*[r.observed.cast("bigint").alias(f"r{i}") for i, r in enumerate(plain)])
        reports.append(_report(totals, plain))
    for rule in rules:
        if not rule.distinct:
            continue
        groups = df.groupBy(*[named(c) for c in rule.distinct]).agg(F.count("*").alias("__rows"))
        if rule.copies:
            observed = F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).cast("bigint")
        else:
            observed = F.count("*")
        reports.append(_report(groups.agg(observed.alias("r0")), [rule]))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionAll(report)
    return result


def table_exists(spark: SparkSession, table: str) -> DataFrame:
    found = int(spark.catalog.tableExists(table))
    return spark.createDataFrame([("table_exists", table, 1, found, found == 1)], REPORT)


def column_exists(df: DataFrame, column: str) -> DataFrame:
    found = int(column in df.columns)
    return df.sparkSession.createDataFrame([("column_exists", column, 1, found, found == 1)], REPORT)


def standings_rules(teams: int) -> list[Rule]:
    """Rules of a league table of ``teams`` teams."""
    return [
        row_count(teams),
        distinct_count("team", teams),
        formula("matches_played", F.col("wins") + F.col("draws") + F.col("losses")),
        formula("points", 3 * F.col("wins") + F.col("draws")),
        formula("goal_difference", F.col("goals_for") - F.col("goals_against")),
        leader_has_rank("points"),
        *not_null(*TABLE_COLUMNS),
        in_range("ranking", 1, teams),
        no_duplicates(TABLE_COLUMNS),
        *not_negative(*COUNTERS),
    ]
