import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators.sketches import distinct_over, merged, relative_error, sketches


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_any_range_from_stored_days_within_the_stated_error(spark):
    # 60,000 values a day, of which half are those of the day before
    df = spark.range(20 * 60_000).select(
        F.date_add(F.lit(day(0)), (F.col("id") / 60_000).cast("int")).alias("day"),
        ((F.col("id") / 60_000).cast("int") * 30_000 + F.col("id") % 60_000).alias("v"),
    )
    stored = sketches(df, ["day"], "v")
    ranges = spark.createDataFrame([(day(a), day(b)) for a, b in ((0, 0), (0, 19), (3, 9), (18, 40), (50, 51))], "low date, high date")
    got = {r["low"]: r["distinct_count"] for r in distinct_over(stored, ranges.unionAll(ranges), "day").collect()}
    want = {day(0): 60_000, day(3): 60_000 + 6 * 30_000, day(18): 90_000, day(50): 0}
    ends = {(r["low"], r["high"]): r["distinct_count"] for r in distinct_over(stored, ranges, "day").collect()}
    assert abs(ends[day(0), day(19)] - 630_000) <= relative_error() * 630_000 and len(ends) == 5
    for low, count in want.items():
        found = ends[day(0), day(0)] if low == day(0) else got[low]
        assert abs(found - count) <= relative_error() * count


def test_small_counts_nulls_and_coarser_groups(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 2), ("b", 1, None), ("b", 1, 7)], "k string, day int, v int")
    stored = sketches(df, ["k", "day"], "v")
    assert rows(merged(stored, ["k"]).select("k", "distinct_count")) == [("a", 2), ("b", 1)]
    assert rows(merged(stored, ["day"]).select("day", "distinct_count")) == [(1, 3), (2, 1)]
    assert merged(stored.limit(0), ["k"]).count() == 0
