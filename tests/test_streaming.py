import os

import pytest
import snapshots
from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators.quality import row_count, standings_rules
from snaptide.operators.upsert import upsert
from snaptide.plans import zones as refinement
from snaptide.schemas import STANDINGS_DATE_FORMAT, STANDINGS_RAW
from snaptide.session import stateful_session
from snaptide.sinks.publish import last_run, publish, read_history, read_run, read_runs, run_of
from snaptide.sources.files import stream_snapshots, stream_table
from snaptide.streaming.ingest import append_stream, append_stream_to_table, collapse_copies, dedupe_stream
from snaptide.streaming.landing import read_quarantine
from snaptide.streaming.progress import had_changes, progress_table, read_progress
from snaptide.streaming.upsert import compact, read_state, upsert_stream

CHANGE = "k string, day int, v int"


def ingest(spark, area, **options):
    raw = stream_snapshots(spark, f"{area}/landing", STANDINGS_RAW, STANDINGS_DATE_FORMAT, **options)
    bronze = refinement.bronze_columns(raw)
    return append_stream(bronze, f"{area}/bronze", f"{area}/checkpoint", "bronze", timeout=120)


def test_restart_takes_only_new_files(spark, area):
    snapshots.write(f"{area}/landing", "2023-Mar-12.csv", snapshots.FIRST)
    assert had_changes(ingest(spark, area))
    assert spark.read.parquet(f"{area}/bronze").count() == 3
    snapshots.write(f"{area}/landing", "2023-Mar-16.csv", snapshots.SECOND)
    snapshots.write(f"{area}/landing", "notes.txt", [["not", "a", "table"]])
    ingest(spark, area)
    assert spark.read.parquet(f"{area}/bronze").count() == 7
    assert not had_changes(ingest(spark, area))
    bronze = spark.read.parquet(f"{area}/bronze")
    assert bronze.count() == 7
    assert bronze.where("snapshot_date IS NULL").count() == 0


def test_files_per_batch_are_limited_and_progress_is_a_table(spark, area):
    for i in range(4):
        snapshots.write(f"{area}/landing", f"{i}.csv", snapshots.FIRST)
    query = ingest(spark, area, max_files=2)
    progress = progress_table(spark, query).where("input_rows > 0")
    assert [tuple(r) for r in progress.orderBy("batch_id").select("query_name", "batch_id", "input_rows").collect()] == [
        ("bronze", 0, 6), ("bronze", 1, 6),
    ]
    first = progress.first()
    assert first.query_id != first.run_id and "landing" in first.source and first.sink


def copies(spark, area, parts):
    for part in parts:
        spark.createDataFrame(part, "a int, b string").coalesce(1).write.mode("append").parquet(f"{area}/in")
    session = stateful_session(spark, 2)
    return session, lambda: stream_table(session, f"{area}/in", spark.read.parquet(f"{area}/in").schema, max_files=1)


@pytest.mark.parametrize("collapse", [False, True])
def test_deduplication_over_batches_and_runs(spark, area, collapse):
    hot = [(1, "x")] * 50
    _, stream = copies(spark, area, [[*hot, (2, "y")], [*hot, (2, None), (2, None)]])

    def run():
        append_stream(dedupe_stream(stream(), ["a", "b"], collapse=collapse), f"{area}/out", f"{area}/checkpoint", "dedupe", timeout=120)

    run()
    expected = sorted([(1, "x"), (2, None), (2, "y")], key=repr)
    assert rows(spark.read.parquet(f"{area}/out")) == expected
    spark.createDataFrame([(1, "x"), (3, "z")], "a int, b string").write.mode("append").parquet(f"{area}/in")
    run()
    assert rows(spark.read.parquet(f"{area}/out")) == sorted([*expected, (3, "z")], key=repr)


def test_collapse_keeps_whole_rows_and_every_value(spark):
    data = [(i % 3 or None, i, "x") for i in range(1000)]
    df = spark.createDataFrame(data, "a int, id int, t string").coalesce(1)
    got = collapse_copies(df, ["a", "t"])
    assert rows(got) == sorted([(None, 0, "x"), (1, 1, "x"), (2, 2, "x")], key=repr)


def test_deduplication_within_watermark(spark, area):
    df = spark.sql("SELECT explode(array(1, 1, 2)) AS a, TIMESTAMP '2023-03-12 10:00:00' AS at")
    df.write.parquet(f"{area}/in")
    stream = stream_table(stateful_session(spark, 2), f"{area}/in", df.schema)
    append_stream(
        dedupe_stream(stream, ["a"], ("at", "1 hour")), f"{area}/out", f"{area}/checkpoint", "bounded", timeout=120
    )
    assert rows(spark.read.parquet(f"{area}/out").select("a")) == [(1,), (2,)]


def test_stream_to_a_catalog_table(spark, area):
    spark.range(5).write.parquet(f"{area}/in")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS streamed LOCATION '{area}/db'")
    name = "streamed.t_" + area.rstrip("/").split("-")[-1].replace("_", "")
    for _ in range(2):
        df = stream_table(spark, f"{area}/in", spark.range(1).schema)
        append_stream_to_table(df, name, f"{area}/checkpoint", "to_table", timeout=120)
    assert spark.table(name).count() == 5


def changes(spark, area, batch):
    spark.createDataFrame(batch, CHANGE).coalesce(1).write.mode("append").parquet(f"{area}/in")


def run_upsert(spark, area):
    stream = stream_table(spark, f"{area}/in", spark.read.parquet(f"{area}/in").schema, max_files=1)
    upsert_stream(stream, f"{area}/log", f"{area}/checkpoint", "upsert", ["k"], "day", timeout=120)


def test_stream_upsert_equals_batch_upserts(spark, area):
    batches = [
        [("a", 1, 10), ("b", 1, 20), ("b", 2, 21), (None, 1, 1)],
        [("b", 3, None), ("c", 3, 30)],
        [("a", 0, 99), ("c", 4, 31)],
    ]
    state = spark.createDataFrame([], CHANGE)
    for run, batch in enumerate(batches):
        changes(spark, area, batch)
        run_upsert(spark, area)
        state = upsert(state.drop("update_flag"), spark.createDataFrame(batch, CHANGE), ["k"], sequence_by="day")
        merged = read_state(spark, f"{area}/log", ["k"], "day")
        assert rows(merged.drop("run_id")) == rows(state)
        assert last_run(spark, f"{area}/log") == run
    rejects = read_history(spark, f"{area}/log").selectExpr("version", "operationMetrics['numRejectedRows']")
    assert rows(rejects) == [(0, "1"), (1, "0"), (2, "0")]
    assert rows(read_state(spark, f"{area}/log", ["k"], "day", run=0).select("k", "v")) == [("a", 10), ("b", 21)]


def test_a_batch_delivered_again_changes_nothing(spark, area):
    for batch in ([("a", 1, 10)], [("a", 2, 11), ("b", 2, 20)]):
        changes(spark, area, batch)
        run_upsert(spark, area)
    before = rows(read_state(spark, f"{area}/log", ["k"], "day"))
    publish(spark.createDataFrame([("a", 2, 11), ("b", 2, 20)], CHANGE), f"{area}/log", 1, "MERGE", writer="w", batch=7)
    assert run_of(spark, f"{area}/log", "w", 7) == 1 and run_of(spark, f"{area}/log", "w", 8) == 2
    assert rows(read_state(spark, f"{area}/log", ["k"], "day")) == before
    run_upsert(spark, area)
    assert rows(read_state(spark, f"{area}/log", ["k"], "day")) == before


def test_the_history_is_read_once_a_start(spark, area, monkeypatch):
    from snaptide.sinks import publish as sink

    for day in range(5):
        changes(spark, area, [("a", day, day), (f"b{day}", day, day)])
    asked, plain = [], sink.run_of
    monkeypatch.setattr(sink, "run_of", lambda *args: asked.append(args[-1]) or plain(*args))
    run_upsert(spark, area)
    changes(spark, area, [("a", 9, 9)])
    run_upsert(spark, area)
    assert asked == [0, 5]
    assert rows(read_history(spark, f"{area}/log").select("version")) == [(n,) for n in range(6)]
    assert rows(read_state(spark, f"{area}/log", ["k"], "day").where("k = 'a'").select("day", "run_id")) == [(9, 5)]


def test_compaction_keeps_state_and_later_flags(spark, area):
    for batch in ([("a", 1, 10), ("b", 1, 20)], [("b", 2, 21)]):
        changes(spark, area, batch)
        run_upsert(spark, area)
    before = rows(read_state(spark, f"{area}/log", ["k"], "day"))
    run = compact(spark, f"{area}/log", ["k"], "day")
    assert rows(read_state(spark, f"{area}/log", ["k"], "day")) == before
    assert rows(read_state(spark, f"{area}/log", ["k"], "day", schema=spark.createDataFrame([], CHANGE).schema)) == before
    assert read_runs(spark, f"{area}/log", compacted=True).count() == 2
    later = spark.createDataFrame([("a", 3, 12), ("c", 3, 1)], CHANGE)
    publish(later, f"{area}/log", run + 1, "MERGE")
    state = read_state(spark, f"{area}/log", ["k"], "day").drop("run_id")
    assert rows(state) == [("a", 3, 12, "U"), ("b", 2, 21, None), ("c", 3, 1, "I")]
    assert read_runs(spark, f"{area}/log", compacted=True).count() == 4
    # the state as of a run before the base
    assert rows(read_state(spark, f"{area}/log", ["k"], "day", run=0).select("k", "v")) == [("a", 10), ("b", 20)]


def test_another_checkpoint_erases_nothing(spark, area):
    changes(spark, area, [("a", 1, 10)])
    run_upsert(spark, area)
    spark.createDataFrame([("b", 1, 20)], CHANGE).write.parquet(f"{area}/other")
    stream = stream_table(spark, f"{area}/other", spark.createDataFrame([], CHANGE).schema)
    upsert_stream(stream, f"{area}/log", f"{area}/second", "other", ["k"], "day", timeout=120)
    assert rows(read_state(spark, f"{area}/log", ["k"], "day").select("k", "v")) == [("a", 10), ("b", 20)]


def test_progress_is_whole_for_both_sinks_and_never_shown_in_part(spark, area):
    spark.range(1040).repartition(104).write.parquet(f"{area}/in")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS logged LOCATION '{area}/db'")
    name = "logged.t_" + area.rstrip("/").split("-")[-1].replace("_", "")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")

    def stream():
        return stream_table(spark, f"{area}/in", spark.range(1).schema, max_files=1)

    files = append_stream(stream(), f"{area}/out", f"{area}/first", "files", timeout=300, log=f"{area}/log")
    tables = append_stream_to_table(stream(), name, f"{area}/second", "tables", timeout=300, log=f"{area}/log")
    for done in (files, tables):
        own = read_progress(spark, f"{area}/log").where(F.col("query_name") == done.name)
        assert rows(own.where("input_rows > 0").select("batch_id", "input_rows").groupBy().agg(F.count("*"), F.sum("input_rows"))) == [(104, 1040)]
        assert own.where("source IS NULL OR sink IS NULL").count() == 0
        with pytest.raises(ValueError, match="incomplete"):
            progress_table(spark, done)
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == kept
    assert read_progress(spark, f"{area}/nothing").count() == 0


def test_a_failed_run_has_logged_what_it_did(spark, area):
    for batch in ([("a", 1, 10)], [("a", 2, 11), ("a", 3, 12)]):
        changes(spark, area, batch)
    stream = stream_table(spark, f"{area}/in", spark.createDataFrame([], CHANGE).schema, max_files=1)
    with pytest.raises(Exception, match="duplicate key"):
        upsert_stream(stream, f"{area}/changes", f"{area}/checkpoint", "failing", ["k"], timeout=120, log=f"{area}/log")
    assert rows(read_progress(spark, f"{area}/log").select("batch_id", "input_rows")) == [(0, 1)]


def test_an_empty_landing_folder_is_refined(spark, area):
    os.makedirs(f"{area}/landing")
    zones = refinement.Zones(f"{area}/landing", area, state_partitions=2)
    reports, _ = refinement.refine(spark, zones, [row_count(0)])
    assert reports["league_table"].count() == 0
    with pytest.raises(refinement.QualityFailure, match="row_count"):
        refinement.refine(spark, zones, [row_count(3)])


def test_a_failing_batch_is_raised(spark, area):
    changes(spark, area, [("a", 1, 10), ("a", 2, 11)])
    stream = stream_table(spark, f"{area}/in", spark.read.parquet(f"{area}/in").schema)
    with pytest.raises(Exception, match="duplicate key"):
        upsert_stream(stream, f"{area}/log", f"{area}/checkpoint", "failing", ["k"], timeout=120)


def test_zones_from_files_to_reports(spark, area):
    zones = refinement.Zones(f"{area}/landing", area, state_partitions=2)
    snapshots.write(zones.landing, "2023-Mar-12.csv", snapshots.FIRST)
    reports, quality = refinement.refine(spark, zones, standings_rules(3))
    assert refinement.failed_checks(quality).count() == 0
    assert [r.team for r in reports["most_wins"].orderBy(F.desc("wins"), "team").collect()][:1] == ["North End"]

    snapshots.write(zones.landing, "2023-Mar-16.csv", snapshots.SECOND)
    snapshots.write(zones.landing, "2023-Mar-16-again.csv", snapshots.SECOND)
    reports, quality = refinement.refine(spark, zones, standings_rules(4))
    assert refinement.failed_checks(quality).count() == 0
    got = rows(reports["league_table"].select("ranking", "team", "wins", "points"))
    assert got == [(1, "North End", 4, 13), (2, "AFC  South", 2, 7), (3, "Westham", 1, 4), (4, "Easton", 0, 0)]
    assert spark.read.parquet(zones.silver).count() == 7
    audit = {r.step: r for r in refinement.read_audit(spark, zones).collect()}
    assert audit["bronze_ingest"].rows_in == 11 and audit["silver_upsert"].rows_in == 11
    assert audit["current"].rejected == 0 and audit["gold"].rows_out == 7
    current = refinement.read_current(spark, zones).select("team", "ranking", "update_flag")
    assert rows(current) == [("AFC  South", 2, "U"), ("Easton", 4, "U"), ("North End", 1, "U"), ("Westham", 3, "I")]


def test_ties_kept_show_both_snapshots_of_an_idle_team(spark, area):
    zones = refinement.Zones(f"{area}/landing", area, state_partitions=2)
    snapshots.write(zones.landing, "1.csv", snapshots.FIRST)
    snapshots.write(zones.landing, "2.csv", snapshots.SECOND)
    reports, quality = refinement.refine(spark, zones, standings_rules(4), ties="keep", gate=False)
    table = reports["league_table"]
    assert rows(table.where("team = 'Easton'").select("ranking")) == [(3,), (4,)]
    assert table.count() == 5
    failed = {(r.check_name, r.observed) for r in refinement.failed_checks(quality).collect()}
    assert failed == {("row_count", 5)}


def test_unreadable_lines_reach_the_quality_report(spark, area):
    zones = refinement.Zones(f"{area}/landing", area, state_partitions=2)
    snapshots.write(zones.landing, "1.csv", [*snapshots.FIRST, ["oops"], [*snapshots.FIRST[0][:-1], "2023/03/12"]])
    _, quality = refinement.refine(spark, zones, standings_rules(3), gate=False)
    failed = {(r.check_name, r.column_name): r.observed for r in refinement.failed_checks(quality).collect()}
    assert failed[("rejected", "_rejected")] == 2


def test_a_refused_run_publishes_nothing_and_the_next_one_its_good_rows(spark, area):
    zones = refinement.Zones(f"{area}/landing", area, state_partitions=2, database="gated_" + area[-6:].replace("-", "_"))
    spark.sql(f"CREATE DATABASE {zones.database} LOCATION '{area}/db'")
    snapshots.write(zones.landing, "1.csv", snapshots.FIRST)
    refinement.refine(spark, zones, standings_rules(3))
    before = rows(read_run(spark, zones.gold("league_table")))
    bad = [*snapshots.SECOND[:2], ["x", *snapshots.SECOND[2][1:]], snapshots.SECOND[3]]
    snapshots.write(zones.landing, "2.csv", bad)
    with pytest.raises(refinement.QualityFailure, match="rejected _rejected: 1, not 0"):
        refinement.refine(spark, zones, standings_rules(4))
    assert rows(read_run(spark, zones.gold("league_table"))) == before == rows(spark.table(f"{zones.database}.league_table"))
    assert [r[:3] for r in rows(read_quarantine(spark, zones.quarantine).select("source_file", "reason", "_rejected"))] == [
        ("2.csv", "line", ",".join(map(str, bad[2])))
    ]
    snapshots.write(zones.landing, "3.csv", [snapshots.SECOND[2]])
    reports, quality = refinement.refine(spark, zones, standings_rules(4))
    assert refinement.failed_checks(quality).count() == 0
    got = rows(reports["league_table"].select("ranking", "team", "wins"))
    assert got == [(1, "North End", 4), (2, "AFC  South", 2), (3, "Westham", 1), (4, "Easton", 0)]
    assert rows(spark.table(f"{zones.database}.league_table")) == rows(reports["league_table"])
    audit = {r.step: r for r in refinement.read_audit(spark, zones).collect()}
    assert (audit["bronze_ingest"].rows_in, audit["bronze_ingest"].rows_out, audit["bronze_ingest"].rejected) == (8, 7, 1)
    assert audit["silver_dedupe"].rows_out == 7


def test_a_file_with_swapped_columns_does_not_reach_the_table(spark, area):
    zones = refinement.Zones(f"{area}/landing", area, state_partitions=2)
    swapped = [[*r[:2], r[14], *r[3:14], r[2], r[15]] for r in snapshots.SECOND]
    snapshots.write(zones.landing, "1.csv", snapshots.FIRST)
    snapshots.write(zones.landing, "2.csv", swapped, "Pos,Team,Pts,W,D,L,GF,GA,W,D,L,GF,GA,GD,P,match_date")
    reports, quality = refinement.refine(spark, zones, standings_rules(3), gate=False)
    assert {(r.check_name, r.observed) for r in refinement.failed_checks(quality).collect()} == {("rejected", 4)}
    assert rows(reports["league_table"].select("matches_played")) == [(4,), (4,), (4,)]
