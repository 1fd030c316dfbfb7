import random

import pytest
from conftest import rows

from snaptide.operators.ranking import rank_rows, top_k


def brute(data, value, group=None):
    """Rank = 1 + rows that sort before."""
    return sorted(
        [(*r, 1 + sum(value(o) < value(r) and (group is None or o[group] == r[group]) for o in data)) for r in data],
        key=repr,
    )


@pytest.fixture
def data():
    rng = random.Random(3)
    # A third of the rows share one score.
    return [(i, "xy"[i % 2], 7 if i % 3 == 0 else rng.randrange(30), rng.randrange(4)) for i in range(240)]


def test_rank_without_groups(spark, data):
    df = spark.createDataFrame(data, "id int, league string, points int, wins int")
    got = rank_rows(df, [("points", "desc"), ("wins", "asc")])
    assert rows(got) == brute(data, lambda r: (-r[2], r[3]))


def test_rank_within_groups(spark, data):
    df = spark.createDataFrame(data, "id int, league string, points int, wins int")
    got = rank_rows(df, [("points", "desc")], partition_by=["league"])
    assert rows(got) == brute(data, lambda r: -r[2], group=1)


@pytest.mark.parametrize("partition_by", [(), ("league",)])
def test_rank_of_many_values_with_small_ties(spark, partition_by):
    rng = random.Random(8)
    data = [(i, "xy"[i % 2], rng.randrange(90), 0) for i in range(240)]
    df = spark.createDataFrame(data, "id int, league string, points int, wins int")
    got = rank_rows(df, [("points", "desc")], partition_by=partition_by)
    assert "Join" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got.select("id", "league", "points", "wins", "ranking")) == brute(
        data, lambda r: -r[2], group=1 if partition_by else None
    )


def test_null_ranks_last_when_descending(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 5), (4, None), (5, 1)], "id int, points int")
    got = rows(rank_rows(df, [("points", "desc")]))
    assert [(r[0], r[2]) for r in got] == [(1, 1), (2, 4), (3, 1), (4, 4), (5, 3)]


def test_top_k(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(50)], "id int, v int")
    assert [tuple(r) for r in top_k(df, [("v", "desc"), ("id", "asc")], 3).collect()] == [(4, 4), (9, 4), (14, 4)]
