import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators.latest import as_of, first_rows, latest

SCHEMA = "k string, played int, day int, rank int"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 25, 1, 17), ("a", 26, 2, 17), ("a", 26, 3, 18), ("b", 20, 1, 2), ("b", None, 9, 3), (None, 4, 1, 1),
         (None, 5, 1, 2), ("c", None, 1, 8), ("c", None, 2, 9)],
        SCHEMA,
    )


def test_keep_returns_all_tied_rows(table):
    got = rows(latest(table, ["k"], ["played"], ties="keep"))
    assert got == sorted(
        [("a", 26, 2, 17), ("a", 26, 3, 18), ("b", 20, 1, 2), (None, 5, 1, 2), ("c", None, 1, 8), ("c", None, 2, 9)],
        key=repr,
    )


def test_keep_agrees_with_rank(table, spark):
    table.createOrReplaceTempView("snapshots")
    ranked = spark.sql(
        "SELECT k, played, day, rank FROM (SELECT *, RANK() OVER (PARTITION BY k ORDER BY played DESC) r FROM snapshots) WHERE r = 1"
    )
    assert rows(latest(table, ["k"], ["played"], ties="keep")) == rows(ranked)


def test_break_returns_one_row_per_key(table):
    got = rows(latest(table, ["k"], ["played"], tiebreak=["day"]))
    assert got == sorted([("a", 26, 3, 18), ("b", 20, 1, 2), (None, 5, 1, 2), ("c", None, 2, 9)], key=repr)


def test_break_needs_a_tiebreak(table):
    with pytest.raises(ValueError, match="tiebreak"):
        latest(table, ["k"], ["played"])


def test_unknown_rule(table):
    with pytest.raises(ValueError, match="keep"):
        latest(table, ["k"], ["played"], ties="drop", tiebreak=["day"])


def test_as_of(table):
    got = rows(as_of(table.where("k = 'a'"), F.lit(2), ["k"], ["day"], tiebreak=["rank"]))
    assert got == [("a", 26, 2, 17)]


@pytest.mark.parametrize("order", [["o"], ["o", "p"]])
def test_against_brute_force_with_a_hot_key(spark, order):
    rng = random.Random(5)
    data = [
        (0 if i % 3 == 0 else rng.randrange(40), rng.randrange(5), rng.randrange(3), i) for i in range(1500)
    ]
    df = spark.createDataFrame(data, "k int, o int, p int, id int").repartition(7)
    at = {"o": 1, "p": 2}
    best = {}
    for row in data:
        value = tuple(row[at[c]] for c in order)
        best[row[0]] = max(best.get(row[0], value), value)
    expected = [row for row in data if tuple(row[at[c]] for c in order) == best[row[0]]]
    assert rows(latest(df, ["k"], order, ties="keep")) == sorted(expected, key=repr)
    last = {}
    for row in expected:
        last[row[0]] = max(last.get(row[0], row), row, key=lambda r: r[3])
    assert rows(latest(df, ["k"], order, tiebreak=["id"])) == sorted(last.values(), key=repr)
    assert rows(first_rows(df, ["k"], [*order, "id"])) == sorted(last.values(), key=repr)


def test_one_pass_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_rows(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle
