import datetime as dt

import pytest
from conftest import rows

from snaptide.session import stateful_session
from snaptide.sources.files import stream_table
from snaptide.streaming.newest import newest, newest_stream, read_newest

ROW = "k string, at timestamp, v int"


def moment(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def deliver(spark, area, *parts):
    for part in parts:
        spark.createDataFrame(part, ROW).coalesce(1).write.mode("append").parquet(f"{area}/in")


def run(spark, area, **limits):
    session = stateful_session(spark, 3)
    stream = stream_table(session, f"{area}/in", spark.read.parquet(f"{area}/in").schema, max_files=1)
    newest_stream(stream, f"{area}/log", f"{area}/checkpoint", "newest", ["k"], ["at", "v"], timeout=180, **limits)
    return rows(read_newest(spark, f"{area}/log", ["k"], ["at", "v"]))


def test_late_rows_and_restarts_change_nothing_that_is_newer(spark, area):
    deliver(spark, area, [("a", moment(2), 1), ("a", moment(1), 9), ("b", moment(1), 1), (None, moment(1), 1)], [("a", moment(1), 5)])
    want = [("a", moment(2), 1), ("b", moment(1), 1), (None, moment(1), 1)]
    assert run(spark, area) == want
    deliver(spark, area, [("b", moment(3), None), ("a", moment(2), 2), ("c", moment(1), 7), ("b", moment(2), 9)])
    want = [("a", moment(2), 2), ("b", moment(3), None), ("c", moment(1), 7), (None, moment(1), 1)]
    assert run(spark, area) == want
    assert run(spark, area) == want


def test_a_period_that_is_over_takes_no_more(spark, area):
    limits = dict(at="at", period="1 day", delay="1 day")
    deliver(spark, area, [("a", moment(1, 5), 1)], [("a", moment(2, 1), 2), ("a", moment(1, 9), 3)], [("a", moment(9), 4)])
    assert [r[:3] for r in run(spark, area, **limits)] == [("a", moment(1, 9), 3), ("a", moment(2, 1), 2), ("a", moment(9), 4)]
    deliver(spark, area, [("a", moment(1, 11), 5), ("a", moment(9, 1), 6)])
    assert [r[:3] for r in run(spark, area, **limits)] == [("a", moment(1, 9), 3), ("a", moment(2, 1), 2), ("a", moment(9, 1), 6)]
    state = spark.read.format("statestore").load(f"{area}/checkpoint")
    assert state.count() == 1


def test_a_period_needs_its_column_and_delay(spark):
    with pytest.raises(ValueError):
        newest(spark.range(1).selectExpr("id AS k"), ["k"], ["k"], period="1 day")
