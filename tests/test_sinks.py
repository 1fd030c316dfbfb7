import os
import uuid
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from snaptide.operators.latest import as_of
from snaptide.operators.upsert import current_state
from snaptide.plans.audit import append_audit, audit_rows
from snaptide.schemas import HISTORY
from snaptide.scratch import CHECKPOINT_DIR, materialize, persisted, work_area
from snaptide.sinks import catalog, publish as sink


@pytest.fixture
def database(spark, area):
    name = f"db_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, name, f"{area}/{name}")
    return name


def session_with(settings, master):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_area_is_inside_the_shared_folder():
    cluster = session_with({CHECKPOINT_DIR: "s3a://bucket/shared/"}, "spark://master:7077")
    first, second = work_area(cluster, "rank"), work_area(cluster, "rank")
    assert first.startswith("s3a://bucket/shared/snaptide-rank-") and first != second


def test_only_a_local_master_may_use_a_local_folder():
    assert os.path.isdir(work_area(session_with({}, "local[2]")))
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        work_area(session_with({}, "yarn"))


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.lit(None).cast("string").alias("W.1"))
    again = materialize(df)
    assert again.count() == 10 and again.columns == df.columns
    assert "FileScan parquet" in again._jdf.queryExecution().executedPlan().toString()


def test_persisted_is_released(spark):
    with persisted(spark.range(5)) as df:
        assert df.storageLevel.useMemory and df.count() == 5
        assert "InMemoryTableScan" in df.where("id > 1")._jdf.queryExecution().executedPlan().toString()
    assert not df.storageLevel.useMemory


def test_dates_before_the_moment_are_pruned(spark, area):
    df = spark.createDataFrame([("a", "2023-03-12"), ("a", "2023-03-16")], "k string, d string")
    sink.overwrite_files(df.withColumn("d", F.col("d").cast("date")), f"{area}/t", ["d"])
    early = as_of(spark.read.parquet(f"{area}/t"), F.lit("2023-03-14").cast("date"), ["k"], ["d"], ties="keep")
    assert [str(r.d) for r in early.collect()] == ["2023-03-12"]
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_publish_again_replaces_the_run(spark, area):
    path = f"{area}/t"
    sink.publish(spark.range(5), path, 1)
    sink.publish(spark.range(7), path, 2, "MERGE", "7", "etl")
    sink.publish(spark.range(6), path, 2, "MERGE", "7", "etl")
    assert sink.last_run(spark, path) == 2
    assert sink.read_run(spark, path).count() == 6
    assert sink.read_run(spark, path, 1).count() == 5
    assert sink.read_runs(spark, path).count() == 11
    assert sink.read_runs(spark, path, 1).count() == 5
    history = {r.version: r for r in sink.read_history(spark, path).collect()}
    assert history[2].operationMetrics["numOutputRows"] == "6" and history[2].userName == "etl"


def test_a_run_without_history_is_not_seen(spark, area):
    path = f"{area}/t"
    sink.publish(spark.range(5), path, 1)
    spark.range(9).write.parquet(sink.run_path(path, 2, "unfinished"))
    assert sink.read_run(spark, path).count() == 5
    assert sink.read_runs(spark, path).count() == 5
    # neither does it come to light when a later run is complete
    sink.publish(spark.range(3), path, 3)
    assert sink.read_runs(spark, path).count() == 8
    # nor does an unfinished attempt at a complete run show
    spark.range(9).write.parquet(sink.run_path(path, 3, "again"))
    assert sink.read_run(spark, path).count() == 3
    assert sink.read_runs(spark, path).count() == 8
    with pytest.raises(ValueError):
        sink.read_run(spark, path, 2)


def test_empty_run(spark, area):
    sink.publish(spark.range(0), f"{area}/t", 1)
    assert sink.read_run(spark, f"{area}/t").count() == 0
    assert sink.read_history(spark, f"{area}/t").first().operationMetrics["numOutputRows"] == "0"


def test_append_merges_schemas(spark, area):
    sink.append_files(spark.createDataFrame([(1,)], "a int"), f"{area}/t")
    sink.append_files(spark.createDataFrame([(2, "x")], "a int, b string"), f"{area}/t")
    assert rows(sink.read_merged(spark, f"{area}/t").select("a", "b")) == [(1, None), (2, "x")]


def test_overwrite_and_exports(spark, area):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string")
    sink.overwrite_files(spark.range(3), f"{area}/o")
    sink.overwrite_files(df, f"{area}/o")
    assert rows(spark.read.parquet(f"{area}/o")) == rows(df)
    sink.export_csv(df, f"{area}/csv")
    assert rows(spark.read.schema(df.schema).option("header", True).csv(f"{area}/csv")) == rows(df)
    sink.export_json(df, f"{area}/json")
    assert rows(spark.read.schema(df.schema).json(f"{area}/json")) == rows(df)


def test_insert_by_name_does_not_swap_columns(spark, database):
    name = f"{database}.t"
    catalog.ensure_table(spark, name, T.StructType().add("rows", "long").add("bytes", "long"))
    catalog.ensure_table(spark, name, T.StructType().add("other", "string"))
    catalog.insert_by_name(spark.createDataFrame([(900, 3)], "bytes bigint, rows bigint"), name)
    assert rows(spark.table(name)) == [(3, 900)]
    with pytest.raises(ValueError, match="differ"):
        catalog.insert_by_name(spark.createDataFrame([(1,)], "rows bigint"), name)


def test_saved_distinct_table_view_and_reset(spark, database):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    catalog.save_table(df, f"{database}.t")
    catalog.save_table(df, f"{database}.t")
    catalog.create_distinct_table(spark, f"{database}.d", f"{database}.t")
    assert spark.table(f"{database}.t").count() == 3
    assert spark.table(f"{database}.d").count() == 2
    catalog.register_view(spark.table(f"{database}.d"), "current_view")
    assert spark.sql("SELECT count(*) FROM current_view").first()[0] == 2
    with pytest.raises(ValueError, match="confirm"):
        catalog.reset(spark, [f"{database}.d"], confirm=False)
    fresh = catalog.reset(spark, [f"{database}.d", f"{database}.t"], ["current_view"], confirm=True)
    assert not spark.catalog.tableExists(f"{database}.d")
    assert not spark.catalog.tableExists("current_view")
    assert not os.path.exists(f"{fresh}/checkpoints")


def test_audit_values_keep_their_columns(spark):
    history = spark.createDataFrame(
        [(1, None, "u1", "ann", "WRITE", {"numFiles": "2", "numOutputRows": "20", "numOutputBytes": "9000000000", "x": "?"}),
         (2, None, "u1", "ann", "MERGE", {"numOutputRows": "n/a", "numFiles": "1"})],
        HISTORY,
    )
    got = audit_rows(history).select("version", "numFiles", "numOutputRows", "numOutputBytes")
    assert rows(got) == [(1, 2, 20, 9000000000), (2, 1, None, None)]


def test_audit_takes_each_version_once(spark, area, database):
    path, name = f"{area}/t", f"{database}.audit"
    sink.publish(spark.range(5), path, 1, user_id="u1")
    assert append_audit(spark, sink.read_history(spark, path), name).count() == 1
    sink.publish(spark.range(6), path, 2, user_id="u1")
    audit = append_audit(spark, sink.read_history(spark, path), name)
    assert rows(audit.select("version", "userId", "numOutputRows")) == [(1, "u1", 5), (2, "u1", 6)]


def test_state_as_of_a_run(spark, area):
    path = f"{area}/t"
    sink.publish(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, 1)
    sink.publish(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), path, 2)
    log = sink.read_runs(spark, path)
    assert rows(current_state(log, ["k"], run=1).drop("run_id")) == [("a", 1, "I"), ("b", 1, "I")]
    assert rows(current_state(log, ["k"], run=2).drop("run_id")) == [("a", 1, None), ("b", 2, "U"), ("c", 2, "I")]
    assert rows(current_state(log, ["k"]).drop("run_id")) == [("a", 1), ("b", 2), ("c", 2)]


def test_two_writers_of_one_number_both_stay(spark, area):
    first, second = (spark.createDataFrame([(k, 1)], "k string, v int") for k in "ab")
    number = sink.next_run(spark, area)
    for writer, df in (("one", first), ("two", second)):
        sink.publish(df, area, number, writer=writer)
    assert rows(sink.read_runs(spark, area).select("k", "run_id")) == [("a", number), ("b", number)]
    assert sink.read_history(spark, area).count() == 2 and sink.next_run(spark, area) == number + 1
    # the same writer again replaces its own rows only, and the later writer of a number is read as the run
    sink.publish(second.withColumn("v", F.lit(2)), area, number, writer="two")
    assert rows(sink.read_runs(spark, area).select("k", "v")) == [("a", 1), ("b", 2)]
    assert rows(sink.read_run(spark, area)) == [("b", 2)]
