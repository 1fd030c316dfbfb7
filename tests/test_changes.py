import datetime as dt
import random

import pytest
from conftest import rows

from snaptide.session import stateful_session
from snaptide.sources.files import stream_table
from snaptide.streaming.changes import BUCKETS, STATE, changes_only, read_last
from snaptide.streaming.ingest import append_stream

ROW = "k string, day date, v int, note string"


def day(n):
    return dt.date(2024, 1, n)


def deliver(spark, area, part, schema=ROW):
    spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{area}/in")


def run(spark, area, keys=("k",), by="day", ignored=(), **how):
    session = stateful_session(spark, 3)
    stream = stream_table(session, f"{area}/in", spark.read.parquet(f"{area}/in").schema, max_files=1)
    append_stream(changes_only(stream, keys, by, ignored, **how), f"{area}/out", f"{area}/checkpoint", "changes", timeout=180)
    return rows(spark.read.parquet(f"{area}/out"))


def test_unchanged_rows_go_and_the_state_is_a_row_per_entity(spark, area):
    deliver(spark, area, [("a", day(1), 1, "x"), ("b", day(1), 5, None), ("a", day(2), 1, "x"), ("a", day(3), 2, "x")])
    want = [("a", day(1), 1, "x"), ("a", day(3), 2, "x"), ("b", day(1), 5, None)]
    assert run(spark, area) == want
    # a restart: the same again, a change back, a late row, a row without a date, a NULL entity
    deliver(spark, area, [("a", day(4), 2, "x"), ("b", day(2), 5, None), ("a", day(5), 1, "x"), ("a", day(2), 9, "late")])
    deliver(spark, area, [("c", None, 1, "x"), (None, day(1), 1, "x"), (None, day(2), 1, "x"), ("b", day(3), None, None)])
    want += [("a", day(5), 1, "x"), (None, day(1), 1, "x"), ("b", day(3), None, None)]
    assert run(spark, area) == sorted(want, key=repr)
    assert run(spark, area) == sorted(want, key=repr)
    state = {r["k"]: r["at"] for r in read_last(spark, f"{area}/checkpoint", ["k"]).collect()}
    assert state == {"a": day(5), "b": day(3), None: day(2)}


def test_names_that_are_no_identifiers(spark, area):
    deliver(spark, area, [("a", day(1), 1), ("a", day(2), 1), ("a", day(3), 2)], "`W.1` string, `_at` date, `class` int")
    assert run(spark, area, ["W.1"], "_at") == [("a", day(1), 1), ("a", day(3), 2)]


def test_columns_can_be_left_out_of_the_comparison(spark, area):
    deliver(spark, area, [("a", day(1), 1, "x"), ("a", day(2), 1, "y"), ("a", day(3), 2, "y")])
    assert run(spark, area, ignored=["note"]) == [("a", day(1), 1, "x"), ("a", day(3), 2, "y")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "bigint", "string"])
def test_any_sequence_that_sorts(spark, area, kind):
    value = {"bigint": "n", "string": "cast(n AS string)"}.get(kind, f"cast(timestamp_seconds(n) AS {kind})")
    for part in ((1, 2, 3), (4, 5)):
        df = spark.createDataFrame([(n,) for n in part], "n int").selectExpr("1 AS k", f"{value} AS at", "n DIV 2 AS v")
        df.coalesce(1).write.mode("append").parquet(f"{area}/in")
        got = run(spark, area, ["k"], "at")
    assert [r[2] for r in got] == [0, 1, 2]


def states(spark, area):
    return spark.read.format("statestore").option("stateVarName", STATE).load(f"{area}/checkpoint").count()


def test_state_is_read_and_written_by_bucket_and_not_by_entity(spark, area):
    schema = "k bigint, l string, at int, v int"
    big, chance = 2**60 + 1, random.Random(3)
    keys = [(k, part) for k in (None, 0, big, big + 1) for part in (None, "", "a", '"', "null")] + [(k, "x") for k in range(1, 200)]
    known, want = {}, []
    for _ in range(2):
        part = [(k, text, chance.randrange(6), chance.randrange(2)) for k, text in keys for _ in range(3)]
        # one row of an entity for each moment
        part = list({row[:3]: row for row in part}.values())
        deliver(spark, area, part, schema)
        for row in sorted(part, key=lambda row: row[2]):
            at, v = known.get(row[:2], (-1, None))
            if row[2] >= at:
                known[row[:2]] = row[2:]
                want += [row] if v != row[3] else []
        assert run(spark, area, ["k", "l"], "at", buckets=4) == sorted(want, key=repr)
    assert states(spark, area) == 4
    last = read_last(spark, f"{area}/checkpoint", ["k", "l"]).select("k", "l", "at")
    assert rows(last) == sorted(((*key, at) for key, (at, _) in known.items()), key=repr)


def test_many_entities_take_a_bounded_number_of_states(spark, area):
    deliver(spark, area, [(n, day(d), n % 7, None) for n in range(3000) for d in (1, 2)], "k int, day date, v int, note string")
    assert len(run(spark, area)) == 3000
    assert states(spark, area) <= BUCKETS < 3000
    assert read_last(spark, f"{area}/checkpoint", ["k"]).distinct().count() == 3000


def test_keys_that_are_equal_in_a_grouping_are_one_entity(spark, area):
    deliver(spark, area, [(0.0, day(1), 1), (-0.0, day(2), 1), (None, day(1), 1), (1.5, day(1), 1)], "k double, day date, v int")
    assert len(run(spark, area)) == 3
