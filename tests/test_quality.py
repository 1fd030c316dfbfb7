import pytest
from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators import quality
from snaptide.plans.zones import failed_checks

TABLE = (
    "ranking int, team string, matches_played int, wins int, draws int, losses int,"
    " goals_for int, goals_against int, goal_difference int, points int"
)
GOOD = [
    (1, "A", 3, 2, 1, 0, 7, 2, 5, 7),
    (2, "B", 3, 1, 1, 1, 3, 3, 0, 4),
    (3, "C", 3, 0, 0, 3, 1, 6, -5, 0),
]


def failures(spark, data, teams=3):
    report = quality.run_suite(spark.createDataFrame(data, TABLE), quality.standings_rules(teams))
    return {(r.check_name, r.column_name, r.observed) for r in failed_checks(report).collect()}


def test_good_table_passes(spark):
    assert failures(spark, GOOD) == set()


@pytest.mark.parametrize(
    "bad, expected",
    [
        ((3, "C", 4, 0, 0, 3, 1, 6, -5, 0), {("formula", "matches_played", 1)}),
        ((3, "C", 3, 0, 0, 3, 1, 6, -5, 1), {("formula", "points", 1)}),
        ((3, "C", 3, 0, 0, 3, 1, 6, -4, 0), {("formula", "goal_difference", 1)}),
        ((9, "C", 3, 0, 0, 3, 1, 6, -5, 0), {("range", "ranking", 1)}),
        ((3, "B", 3, 0, 0, 3, 1, 6, -5, 0), {("distinct", "team", 2)}),
        ((3, "C", 3, None, 0, 3, 1, 6, -5, 0), {("null", "wins", 1)}),
        ((3, "C", 3, 0, 0, 3, -1, 4, -5, 0), {("negative", "goals_for", 1)}),
        ((2, "B", 3, 1, 1, 1, 3, 3, 0, 4), {("duplicates", None, 1), ("distinct", "team", 2)}),
        ((3, "C", 3, 3, 0, 0, 9, 1, 8, 9), {("leader", "ranking", 3)}),
    ],
)
def test_each_rule_finds_its_bad_row(spark, bad, expected):
    assert failures(spark, [*GOOD[:2], bad]) == expected


def test_row_count(spark):
    assert ("row_count", None, 3) in failures(spark, GOOD, teams=4)


def test_leader_tie_takes_the_best_rank(spark):
    tied = [(2, "A", 3, 2, 1, 0, 7, 2, 5, 7), (1, "B", 3, 2, 1, 0, 7, 2, 5, 7)]
    assert failures(spark, tied, teams=2) == set()


def test_null_operands_and_the_null_safe_form(spark):
    df = spark.createDataFrame([(1, None), (2, 2)], "a int, b int")
    plain = quality.run_suite(df, [quality.formula("a", F.col("b"))])
    safe = quality.run_suite(df, [quality.formula("a", F.col("b"), null_safe=True)])
    assert plain.first().observed == 0
    assert safe.first().observed == 1


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "t string")
    assert quality.run_suite(df, [quality.distinct_count("t")]).first().observed == 2


def test_approximate_distinct_stays_in_the_one_scan(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", None)], "t string, v int")
    suite = quality.run_suite(df, [quality.distinct_count("t", approximate=True), *quality.not_null("v")])
    assert suite._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1
    assert {(r.check_name, r.observed) for r in suite.collect()} == {("distinct_approx", 2), ("null", 1)}


def test_plain_rules_share_one_scan(spark):
    df = spark.createDataFrame(GOOD, TABLE)
    rules = [*quality.not_null("wins", "draws"), *quality.not_negative("wins"), quality.in_range("ranking", 1, 3)]
    plan = quality.run_suite(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_empty_table(spark):
    report = quality.run_suite(spark.createDataFrame([], TABLE), quality.standings_rules(20))
    failed = {(r.check_name, r.column_name) for r in failed_checks(report).collect()}
    assert failed == {("row_count", None), ("distinct", "team"), ("leader", "ranking")}


def test_existence(spark):
    assert rows(quality.table_exists(spark, "no_such_table")) == [("table_exists", "no_such_table", 1, 0, False)]
    df = spark.range(1)
    assert quality.column_exists(df, "id").first().passed
    assert not quality.column_exists(df, "team").first().passed
