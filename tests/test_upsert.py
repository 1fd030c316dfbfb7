import random
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators.upsert import current_state, reduce_batch, rejected_rows, upsert

SCHEMA = "k string, day int, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_update_insert_and_untouched(spark):
    target = frame(spark, ("a", 1, 10), ("b", 1, 20))
    source = frame(spark, ("b", 2, 21), ("c", 2, 30))
    assert rows(upsert(target, source, ["k"])) == [
        ("a", 1, 10, None), ("b", 2, 21, "U"), ("c", 2, 30, "I"),
    ]


def test_update_to_null_wins(spark):
    got = rows(upsert(frame(spark, ("a", 1, 10)), frame(spark, ("a", 2, None)), ["k"]))
    assert got == [("a", 2, None, "U")]


def test_only_listed_columns_are_updated_but_inserts_take_all(spark):
    target = frame(spark, ("a", 1, 10))
    source = frame(spark, ("a", 2, 11), ("b", 2, 20))
    assert rows(upsert(target, source, ["k"], update_columns=["v"])) == [("a", 1, 11, "U"), ("b", 2, 20, "I")]


def test_duplicate_keys_are_reduced_to_the_newest(spark):
    source = frame(spark, ("a", 2, 11), ("a", 3, 12), ("b", 5, 1), ("b", 5, 2))
    got = rows(upsert(frame(spark, ("a", 1, 10)), source, ["k"], sequence_by="day"))
    assert got == [("a", 3, 12, "U"), ("b", 5, 2, "I")]


def test_duplicate_keys_without_sequence_fail(spark):
    source = frame(spark, ("a", 2, 11), ("a", 3, 12))
    with pytest.raises(Exception, match="duplicate key in batch"):
        upsert(frame(spark, ("a", 1, 10)), source, ["k"]).collect()


def test_older_row_does_not_overwrite(spark):
    target = frame(spark, ("a", 5, 50), ("b", None, 1))
    source = frame(spark, ("a", 4, 40), ("b", 1, 2))
    assert rows(upsert(target, source, ["k"], sequence_by="day")) == [("a", 5, 50, None), ("b", 1, 2, "U")]


def test_empty_batch_changes_nothing(spark):
    got = rows(upsert(frame(spark, ("a", 1, 10)), frame(spark), ["k"], sequence_by="day"))
    assert got == [("a", 1, 10, None)]


def test_into_an_empty_target(spark):
    assert rows(upsert(frame(spark), frame(spark, ("a", 1, 10)), ["k"])) == [("a", 1, 10, "I")]


def test_null_keys_are_left_out_and_reported(spark):
    source = frame(spark, (None, 1, 1), ("a", 1, 2))
    assert rows(upsert(frame(spark), source, ["k"], sequence_by="day")) == [("a", 1, 2, "I")]
    assert rows(rejected_rows(source, ["k"])) == [(None, 1, 1)]


def test_missing_source_column(spark):
    with pytest.raises(ValueError, match="lacks"):
        upsert(frame(spark), frame(spark).drop("v"), ["k"])


def test_dotted_columns_and_two_keys(spark):
    names = ["k.1", "k2", "W.1"]
    target = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], "a int, b string, c int").toDF(*names)
    source = spark.createDataFrame([(1, "y", 7), (2, "x", 8)], "a int, b string, c int").toDF(*names)
    assert rows(upsert(target, source, ["k.1", "k2"])) == [
        (1, "x", 5, None), (1, "y", 7, "U"), (2, "x", 8, "I"),
    ]


def test_same_batch_again_changes_no_payload(spark):
    target = frame(spark, ("a", 1, 10), ("b", 1, 20))
    source = frame(spark, ("b", 2, 21), ("c", 2, 30))
    once = upsert(target, source, ["k"], sequence_by="day")
    twice = upsert(once.drop("update_flag"), source, ["k"], sequence_by="day")
    assert rows(twice.drop("update_flag")) == rows(once.drop("update_flag"))


def test_duplicated_target_rows_are_all_updated(spark):
    target = frame(spark, ("a", 1, 10), ("a", 1, 11))
    got = rows(upsert(target, frame(spark, ("a", 2, 9), ("b", 2, 1)), ["k"]))
    assert got == [("a", 2, 9, "U"), ("a", 2, 9, "U"), ("b", 2, 1, "I")]


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("day"), F.lit(1).alias("v"))
    source = spark.createDataFrame([("1", 2, 2)], SCHEMA)
    merged = upsert(target, source, ["k"], sequence_by="day")
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan()
    # the target is the range; its keys may only be exchanged once they have met the batch
    assert plan.toString().split("Initial Plan")[0].count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan.toString().split("Initial Plan")[0]


def test_a_row_that_wins_leaves_its_sequence(spark):
    state = frame(spark, ("a", 1, 10))
    for day, value, held in ((5, 50, 50), (3, 30, 50), (6, 60, 60)):
        state = upsert(state, frame(spark, ("a", day, value)), ["k"], ["v"], sequence_by="day").drop("update_flag")
        assert state.first().v == held


@pytest.mark.parametrize("sequence_by", ["day", None])
def test_change_log_equals_upserts_in_turn(spark, sequence_by):
    rng = random.Random(11)
    batches = []
    for _ in range(4):
        keys = rng.sample(range(12), 7)
        batches.append([(f"k{k}", rng.randrange(6), rng.choice([None, rng.randrange(99)])) for k in keys])
    frames = [frame(spark, *batch) for batch in batches]
    log = reduce(
        lambda a, b: a.unionByName(b),
        [reduce_batch(f, ["k"], sequence_by).withColumn("run_id", F.lit(i).cast("bigint")) for i, f in enumerate(frames)],
    )
    state = frame(spark)
    for run, batch in enumerate(frames):
        state = upsert(state.drop("update_flag"), batch, ["k"], sequence_by=sequence_by)
        merged = current_state(log, ["k"], sequence_by, run)
        assert rows(merged.drop("run_id")) == rows(state)
