import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators import asof
from snaptide.operators.latest import latest


def plain(left, right):
    """(key, moment, id) with the greatest (moment, tie, value) of the key up to it."""
    out = []
    for key, at, name in left:
        fit = [r[1:] for r in right if None not in (key, at) and r[0] == key and r[1] is not None and r[1] <= at]
        out.append((key, at, name, *max(fit, default=(None, None, None))))
    return sorted(out, key=repr)


def joined(spark, left, right, ranges, how="left"):
    asked = spark.createDataFrame(left, "k string, at int, name int")
    given = spark.createDataFrame(right, "k string, since int, tie int, value string")
    return asof.as_of_join(asked.repartition(3), given.repartition(3), ["k"], "at", "since", ["tie", "value"], how, ranges)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_matches_equal_brute_force_at_any_number_of_ranges(spark, ranges):
    rng = random.Random(ranges)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    left = [(rng.choice(keys), rng.choice([None, *range(60)]), i) for i in range(400)]
    right = [(rng.choice(keys), rng.choice([None, *range(60)]), rng.randrange(3), f"v{i}") for i in range(150)]
    got = joined(spark, left, right, ranges)
    assert got.columns == ["k", "at", "name", "since", "tie", "value"]
    assert rows(got) == plain(left, right)
    assert rows(joined(spark, left, right, ranges, "inner")) == [r for r in plain(left, right) if r[3] is not None]


def test_one_row_is_carried_over_many_ranges(spark):
    left = [("k", i, i) for i in range(1, 300)]
    got = joined(spark, left, [("k", 0, 0, "first"), ("j", 500, 0, "other"), ("z", 0, 0, "last")], 20)
    assert {r["value"] for r in got.collect()} == {"first"} and got.count() == 299


def test_columns_of_any_type_are_carried(spark):
    left = spark.range(100).selectExpr("1 AS k", "cast(id AS int) AS at", "map('x', id) AS m")
    right = spark.createDataFrame([(1, 0, {"a": 1}, [2], (3,))], "k int, since int, tags map<string, int>, list array<int>, s struct<v: int>")
    got = asof.as_of_join(left, right, ["k"], "at", "since", ranges=9).collect()
    assert len(got) == 100 and all((r["tags"], r["list"], r["s"]["v"], r["m"]["x"]) == ({"a": 1}, [2], 3, r["at"]) for r in got)


def test_empty_sides(spark):
    assert rows(joined(spark, [("a", 1, 1)], [], 4)) == [("a", 1, 1, None, None, None)]
    assert joined(spark, [], [("a", 1, 1, "v")], 4).count() == 0


def test_names_of_both_tables_are_refused(spark):
    df = spark.range(1).selectExpr("id AS k", "id AS at", "id AS value")
    with pytest.raises(ValueError, match="at, value"):
        asof.as_of_join(df, df, ["k"], "at", "at")


def test_all_dates_equal_one_pass_for_each(spark):
    rng = random.Random(2)
    data = [(rng.choice("abcd"), rng.randrange(50), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, day int, id int")
    moments = [-5, 0, 10, 10, 33, 49, 80]
    want = [
        (r["k"], m, r["day"], r["id"])
        for m in set(moments)
        for r in latest(df.where(F.col("day") <= m), ["k"], ["day"], tiebreak=["id"]).collect()
    ]
    got = asof.as_of_dates(df, moments, ["k"], "day", ["id"], ranges=7)
    assert rows(got) == sorted(want, key=repr)


def test_a_hot_key_is_split_by_time(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("at")
    )
    right = df.select("k", F.col("at").alias("since"), F.lit(1).alias("v"))
    merged, keys, order = asof._merged(df, right, ["k"], "at", "since", [])
    dealt = asof.deal(merged, [*keys, *order])
    sizes = sorted(r[1] for r in dealt.groupBy("range").count().collect())
    assert len(sizes) == asof.RANGES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    # what the window gets: the groups of a range and a key, dealt by their hash
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = dealt.groupBy(F.pmod(F.hash("range", *keys), F.lit(parts)).alias("task")).count()
    counts = sorted(r[1] for r in tasks.collect())
    assert counts[-1] < 4 * counts[len(counts) // 2]
