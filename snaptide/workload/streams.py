"""Streams over the driver's tables, each run to the end of its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import not_null, row_count, standings_rules
from ..operators.reshape import undot_columns
from ..plans import chains, zones as refinement
from ..plans.gold import player_facts
from ..schemas import HISTORY, PLAYERS, STANDINGS_DATE_FORMAT, TABLE_COLUMNS, TEAM_SUMMARY
from ..scratch import materialize, work_area
from ..session import stateful_session
from ..sinks.publish import append_files, read_history, read_run
from ..sources.files import read_table, stream_table, table_there
from ..sources.headers import by_header, stream_lines
from ..sources.nested import stream_nested_json
from ..streaming.changes import changes_only
from ..streaming.ingest import append_stream, append_stream_to_table, dedupe_stream
from ..streaming.landing import land, read_quarantine
from ..streaming.newest import newest_stream, read_newest
from ..streaming.progress import progress_table, read_progress
from ..streaming.upsert import read_state, upsert_stream
from .derived import SNAPSHOT_DAYS, STANDINGS_SQL, player_documents, standings_snapshots, team_summaries
from .files import _database, write_raw_snapshots
from .players import _FACTS_SQL
from .registry import query, table
from .snapshots import DELIVERY, _CONSISTENT_SQL, _LATEST_SQL, _NEWEST_ORDER, _SUMMARY_SQL, _TABLE, _deliveries, _silver


def _table_files(sf_dir: str, name: str) -> str:
    # A file stream lists a directory or a pattern; the pattern fits the table only.
    return f"{sf_dir}/{name}.parque[t]"


def _deliver(df: DataFrame, path: str, kind: str, deliveries: int = 3) -> int:
    """Write ``df`` as files, as many for each delivery as the session has shuffle partitions, and return that number."""
    each = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartition(each * deliveries)
    writer = spread.write.option("header", True) if kind == "csv" else spread.write
    writer.format(kind).save(path)
    return each


def _stream(spark: SparkSession, sf_dir: str, name: str, reader: SparkSession | None = None) -> DataFrame:
    return stream_table(reader or spark, _table_files(sf_dir, name), table(spark, sf_dir, name).schema)


@query("SELECT o_orderkey, o_custkey FROM orders")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table files appended by a run-once stream; the second run finds nothing new."""
    area = work_area(spark, "append")
    for _ in range(2):
        rows = _stream(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        append_stream(rows, f"{area}/orders", f"{area}/checkpoint", "append_orders")
    return read_table(spark, f"{area}/orders")


@query(
    f"""SELECT 'run_0' AS query_name, count(*) AS input_rows FROM orders WHERE o_orderdate < TIMESTAMP '{DELIVERY}'
UNION ALL SELECT 'run_1', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{DELIVERY}'
UNION ALL SELECT 'run_2', 0
UNION ALL SELECT 'table', count(*) FROM orders"""
)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each run of one stream takes: two deliveries, then nothing new; and the rows of the table."""
    area = work_area(spark, "restart")
    runs = []
    for run, delivery in enumerate([*_deliveries(spark, sf_dir), None]):
        if delivery is not None:
            append_files(delivery, f"{area}/landing")
        rows = stream_table(spark, f"{area}/landing", read_table(spark, f"{area}/landing").schema)
        runs.append(append_stream(rows, f"{area}/orders", f"{area}/checkpoint", f"run_{run}"))
    taken = progress_table(spark, *runs).groupBy("query_name").agg(F.sum("input_rows").alias("input_rows"))
    table_rows = read_table(spark, f"{area}/orders").agg(
        F.lit("table").alias("query_name"), F.count("*").alias("input_rows")
    )
    return taken.unionByName(table_rows)


@query("SELECT event_id, user_id, event_type FROM events")
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream appended to a catalog table."""
    name = f"{_database(spark)}.bronze"
    rows = _stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    append_stream_to_table(rows, name, work_area(spark, "checkpoint"), "events_to_table")
    return spark.table(name)


@query("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = work_area(spark, "dedup")
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    rows = _stream(spark, sf_dir, "orders", stateful_session(spark)).select(*columns)
    append_stream(dedupe_stream(rows, columns, collapse=True), f"{area}/orders", f"{area}/checkpoint", "dedup_orders")
    return read_table(spark, f"{area}/orders")


@query(f"{STANDINGS_SQL} SELECT ranking, team, wins, points, entity_id, snapshot_date FROM standings")
def stream_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated CSV snapshots into bronze: renamed, keyed, typed."""
    area = work_area(spark, "ingest")
    zones = refinement.Zones(f"{area}/landing", area)
    write_raw_snapshots(spark, sf_dir, zones.landing)
    refinement.to_bronze(spark, zones)
    bronze = read_table(spark, zones.bronze)
    wins = (F.col("win_home") + F.col("win_away")).alias("wins")
    return bronze.select("ranking", "team", wins, "points", "entity_id", "snapshot_date")


@query(
    """SELECT s.match_date, count(DISTINCT user_id) AS teams, count(*) FILTER (day(ts) <= s.last_day) AS played_total
FROM (SELECT user_id, ts FROM events WHERE event_type IN ('signup', 'click', 'error')),
  (VALUES (10, DATE '2024-01-10'), (20, DATE '2024-01-20'), (31, DATE '2024-01-31')) s(last_day, match_date)
GROUP BY s.match_date"""
)
def stream_rate_limited_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team summaries from CSV, a limited number of files per micro-batch, summed per date."""
    area = work_area(spark, "limited")
    columns = [f"`{f.name}`" for f in TEAM_SUMMARY]
    summaries = materialize(team_summaries(spark, sf_dir).select(*columns), "summaries")
    max_files = _deliver(summaries, f"{area}/landing", "csv")
    land(
        stream_lines(spark, f"{area}/landing", max_files),
        lambda lines: undot_columns(by_header(lines, TEAM_SUMMARY, "yyyy-MM-dd")),
        f"{area}/bronze",
        f"{area}/quarantine",
        f"{area}/checkpoint",
        "team_ingest",
    )
    bronze = read_table(spark, f"{area}/bronze")
    return bronze.groupBy("match_date").agg(
        F.count("*").alias("teams"), F.sum("played_total").alias("played_total")
    )


@query(f"{_FACTS_SQL} SELECT * FROM facts")
def stream_nested_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested player JSON as a stream, a limited number of files per micro-batch."""
    area = work_area(spark, "players")
    max_files = _deliver(materialize(player_documents(spark, sf_dir), "players"), f"{area}/landing", "json")
    players = stream_nested_json(spark, f"{area}/landing", PLAYERS, multi_line=False, max_files=max_files)
    append_stream(players, f"{area}/bronze", f"{area}/checkpoint", "player_ingest")
    return player_facts(read_table(spark, f"{area}/bronze"))


@query(
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders) WHERE n = 1"""
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered in three parts, upserted per micro-batch into the latest order per customer."""
    area = work_area(spark, "upsert")
    # Dates tie, so the sequence is the date followed by the key.
    sequence = F.struct("o_orderdate", "o_orderkey").alias("sequence")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", sequence
    )
    max_files = _deliver(orders, f"{area}/landing", "parquet")
    stream = stream_table(spark, f"{area}/landing", orders.schema, max_files)
    upsert_stream(stream, f"{area}/changes", f"{area}/checkpoint", "upsert_orders", ["o_custkey"], "sequence")
    state = read_state(spark, f"{area}/changes", ["o_custkey"], "sequence")
    return state.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


@query("SELECT 'progress_events' AS query_name, count(*) AS input_rows, true AS has_source FROM events", "progress_table")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of a stream as a table, summed over its micro-batches."""
    area = work_area(spark, "progress")
    rows = _stream(spark, sf_dir, "events").select("event_id", "user_id")
    done = append_stream(rows, f"{area}/events", f"{area}/checkpoint", "progress_events")
    return progress_table(spark, done).groupBy("query_name").agg(
        F.sum("input_rows").alias("input_rows"), F.bool_and(F.col("source").isNotNull()).alias("has_source")
    )


@query(
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders) WHERE n = 1"""
)
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order of each customer by streaming aggregation: the later delivery comes first, the stream is started for each."""
    area = work_area(spark, "latest")
    order = ["o_orderdate", "o_orderkey"]
    for delivery in reversed(_deliveries(spark, sf_dir)):
        rows = delivery.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
        append_files(rows, f"{area}/landing")
        stream = stream_table(stateful_session(spark), f"{area}/landing", rows.schema)
        newest_stream(stream, f"{area}/log", f"{area}/checkpoint", "latest_orders", ["o_custkey"], order)
    return read_newest(spark, f"{area}/log", ["o_custkey"], order)


@query(
    f"""{STANDINGS_SQL}, shown AS (SELECT *, lag({{'a': matches_played, 'b': wins, 'c': draws, 'd': losses, 'e': goals_for,
  'f': goals_against}}) OVER (PARTITION BY team ORDER BY snapshot_date) AS before FROM standings)
SELECT team, snapshot_date, matches_played, wins, draws, losses, goals_for, goals_against FROM shown
WHERE before IS NULL OR before <> {{'a': matches_played, 'b': wins, 'c': draws, 'd': losses, 'e': goals_for, 'f': goals_against}}"""
)
def stream_changes_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of the standings, a delivery for each date and each of them sent twice, without teams that had no event."""
    area = work_area(spark, "changes")
    columns = ["team", "snapshot_date", "matches_played", "wins", "draws", "losses", "goals_for", "goals_against"]
    rows = materialize(_silver(spark, sf_dir).select(*columns), "silver")
    for day in SNAPSHOT_DAYS.values():
        for _ in range(2):
            append_files(rows.where(F.col("snapshot_date") == F.lit(day).cast("date")), f"{area}/landing")
        stream = stream_table(stateful_session(spark), f"{area}/landing", rows.schema)
        changed = changes_only(stream, ["team"], "snapshot_date")
        append_stream(changed, f"{area}/changed", f"{area}/checkpoint", "changed_teams")
    return read_table(spark, f"{area}/changed")


def _many_files(spark: SparkSession, sf_dir: str, area: str) -> DataFrame:
    """Orders as a stream of over 100 micro-batches."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders.repartition(104).write.parquet(f"{area}/landing")
    return stream_table(spark, f"{area}/landing", orders.schema, max_files=1)


def _over() -> Column:
    return (F.count(F.when(F.col("input_rows") > 0, 1)) > 100).alias("over_a_hundred")


@query("SELECT count(*) AS taken, count(*) AS written, true AS over_a_hundred FROM orders")
def progress_many_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of a run of over 100 micro-batches, whole: the rows it took are the rows of the files."""
    area = work_area(spark, "many")
    stream = _many_files(spark, sf_dir, area)
    append_stream(stream, f"{area}/orders", f"{area}/checkpoint", "many", log=f"{area}/progress")
    progress = read_progress(spark, f"{area}/progress").agg(F.sum("input_rows").alias("taken"), _over())
    return progress.withColumn("written", F.lit(read_table(spark, f"{area}/orders").count()).cast("bigint"))


@query(
    """SELECT 'progress_many' AS query_name, count(*) AS taken, count(*) AS written, true AS over_a_hundred FROM orders
UNION ALL SELECT 'progress_few', count(*), count(*), false FROM orders"""
)
def progress_listener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of two streams into catalog tables, one of them of over 100 micro-batches, from one log."""
    area, db = work_area(spark, "listener"), _database(spark)
    few = _stream(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    written = []
    for name, stream in (("progress_many", _many_files(spark, sf_dir, area)), ("progress_few", few)):
        append_stream_to_table(stream, f"{db}.{name}", f"{area}/{name}", name, log=f"{area}/progress")
        written.append((name, spark.table(f"{db}.{name}").count()))
    taken = read_progress(spark, f"{area}/progress").groupBy("query_name").agg(F.sum("input_rows").alias("taken"), _over())
    return taken.join(spark.createDataFrame(written, "query_name string, written bigint"), "query_name")


@query(f"{_LATEST_SQL} SELECT * FROM latest")
def zones_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files through bronze, silver and gold by streams; the published league table."""
    area = work_area(spark, "zones")
    zones = refinement.Zones(f"{area}/landing", area)
    write_raw_snapshots(spark, sf_dir, zones.landing)
    teams = standings_snapshots(spark, sf_dir).agg(F.count_distinct("Team")).first()[0]
    # rules that fail stop the run; the leader of these invented results need not be ranked first
    rules = [r for r in standings_rules(teams) if r.check_name not in ("leader", "range")]
    reports, _ = refinement.refine(spark, zones, rules)
    return reports["league_table"]


@query(
    f"""{STANDINGS_SQL}, newest AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY snapshot_date DESC) AS n FROM standings)
SELECT 'league table' AS part, team, wins FROM newest WHERE n = 1
UNION ALL SELECT 'quarantine', team, NULL FROM standings WHERE snapshot_date = DATE '2024-01-10' AND wins % 2 = 1
UNION ALL SELECT 'published by the refused run', NULL, 0"""
)
def zones_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery with unreadable lines is refused; the next one publishes, and those lines are in the quarantine."""
    area = work_area(spark, "gate")
    zones = refinement.Zones(f"{area}/landing", area)
    raw = materialize(standings_snapshots(spark, sf_dir), "raw")
    teams = raw.agg(F.count_distinct("Team")).first()[0]
    first = F.col("match_date") == F.lit(SNAPSHOT_DAYS[10]).cast("date")
    odd = (F.col("W") + F.col("`W.1`")) % 2 == 1
    shown = []
    for delivery, place in ((raw.where(first), F.when(odd, F.lit("x")).otherwise(F.col("Pos").cast("string"))), (raw.where(~first), F.col("Pos"))):
        rows = delivery.withColumn("Pos", place)
        rows = rows.withColumn("match_date", F.date_format("match_date", STANDINGS_DATE_FORMAT))
        rows.write.mode("append").option("header", True).csv(zones.landing)
        try:
            refinement.refine(spark, zones, [row_count(teams)])
        except refinement.QualityFailure:
            shown.append(read_history(spark, zones.gold("league_table")).count() if table_there(spark, f"{zones.gold('league_table')}/history", HISTORY) else 0)
    league = read_run(spark, zones.gold("league_table")).select(F.lit("league table").alias("part"), "team", "wins")
    lines = read_quarantine(spark, zones.quarantine).select(F.split("_rejected", ",").alias("cells"))
    kept = lines.select(F.lit("quarantine").alias("part"), F.col("cells")[1].alias("team"), F.lit(None).cast("bigint").alias("wins"))
    refused = spark.createDataFrame([("published by the refused run", None, n) for n in shown], league.schema)
    return league.unionByName(kept).unionByName(refused)


@query(
    f"""{STANDINGS_SQL}, newest AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY snapshot_date DESC)
  AS n FROM standings) SELECT {_TABLE} FROM newest WHERE n = 1"""
)
def zones_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files through bronze into the upserted current state of each team."""
    area = work_area(spark, "current")
    zones = refinement.Zones(f"{area}/landing", area)
    write_raw_snapshots(spark, sf_dir, zones.landing)
    refinement.to_bronze(spark, zones)
    refinement.to_current(spark, zones)
    return refinement.read_current(spark, zones).select(*TABLE_COLUMNS)


@query(_SUMMARY_SQL.format(extra=_CONSISTENT_SQL))
def team_zones_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season summaries as CSV files through all zones; the published summary of each team."""
    area = work_area(spark, "teams")
    schema = T.StructType([T.StructField("user_id", T.LongType()), *TEAM_SUMMARY])
    columns = [f"`{f.name}`" for f in schema]
    team_summaries(spark, sf_dir).select(*columns).write.option("header", True).csv(f"{area}/landing")
    chain = chains.team_chain(f"{area}/landing", area, schema, ["user_id"], rules=not_null("match_date", "played_total"))
    return chains.run_chain(spark, chain)[0]["summary"]


@query(
    f"""{_FACTS_SQL} SELECT *, coalesce(goals, 0) + coalesce(assists, 0) AS contributions FROM facts
  ORDER BY contributions DESC, id LIMIT 20"""
)
def player_zones_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player documents as JSON files, delivered twice, through all zones; the published leaders."""
    area = work_area(spark, "players")
    chain = chains.player_chain(f"{area}/landing", area, multi_line=False, rules=not_null("id", "name"))
    for _ in range(2):
        player_documents(spark, sf_dir).write.mode("append").json(f"{area}/landing")
        reports, _ = chains.run_chain(spark, chain)
    return reports["top_contributions"]
