"""Latest state, standings, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.asof import as_of_dates, as_of_join
from ..operators.latest import as_of, latest
from ..operators.ranking import top_k as first_rows
from ..operators.reshape import undot_columns
from ..operators.upsert import upsert
from ..plans import gold
from ..plans.zones import bronze_columns, silver_columns
from ..scratch import materialize, work_area
from ..sinks.catalog import save_bucketed
from ..sinks.publish import publish, run_path
from ..streaming.upsert import compact, read_state
from .derived import STANDINGS_SQL, standings_snapshots, team_summaries
from .files import _database
from .registry import query, table

# The orders before and from this day are two deliveries of one source.
DELIVERY = "1998-07-01"

_ORDER_STATE = ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus"]


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(*_ORDER_STATE)
    cut = F.lit(DELIVERY).cast("timestamp_ntz")
    return orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)


def _state(delivery: DataFrame) -> DataFrame:
    """Newest order per customer as a stored table, which is what an upsert merges into."""
    return materialize(latest(delivery, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"]), "state")


_NEWEST_ORDER = "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)"
_TWO_DELIVERIES_SQL = f"""
WITH before AS (SELECT * FROM (SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders
       WHERE o_orderdate < TIMESTAMP '{DELIVERY}') WHERE n = 1),
  after AS (SELECT * FROM (SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders
       WHERE o_orderdate >= TIMESTAMP '{DELIVERY}') WHERE n = 1)
"""
_FLAG_SQL = """CASE WHEN b.o_custkey IS NOT NULL AND a.o_custkey IS NOT NULL THEN 'U'
  WHEN a.o_custkey IS NOT NULL THEN 'I' END AS update_flag"""


@query(
    """SELECT DISTINCT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1"""
)
def latest_keep_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest(orders, ["o_custkey"], ["o_orderdate"], ties="keep").distinct()


@query(
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders) WHERE n = 1"""
)
def latest_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest(orders, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"])


@query(
    f"""SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders
  WHERE o_orderdate <= TIMESTAMP '1998-06-30') WHERE n = 1"""
)
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    moment = F.lit("1998-06-30").cast("timestamp_ntz")
    return as_of(orders, moment, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"])


@query(
    """WITH days AS (SELECT DISTINCT last_day(o_orderdate) AS as_of FROM orders)
SELECT o_custkey, as_of::TIMESTAMP AS as_of, n.o_orderdate, n.o_orderkey, n.o_totalprice FROM (
  SELECT o_custkey, as_of, max({'o_orderdate': o_orderdate, 'o_orderkey': o_orderkey, 'o_totalprice': o_totalprice}) AS n
  FROM orders JOIN days ON o_orderdate <= as_of GROUP BY o_custkey, as_of)"""
)
def asof_all_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order of each customer as of the last day of every month, all months in one pass."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    # a row per month
    days = [r[0] for r in orders.where("o_orderdate is not null").select(F.last_day("o_orderdate")).distinct().collect()]
    return as_of_dates(orders, days, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    """SELECT event_id, user_id, ts, seen.event_id AS view_id, seen.ts AS viewed_at, seen.value AS view_value FROM (
  SELECT *, max(CASE WHEN event_type = 'view' THEN {'ts': ts, 'event_id': event_id, 'value': value} END)
    OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS seen FROM events) WHERE event_type = 'purchase'"""
)
def asof_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the last view of its user that is not after it."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    views = events.where(kind == "view").select(
        "user_id", F.col("ts").alias("viewed_at"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    purchases = events.where(kind == "purchase").select("event_id", "user_id", "ts")
    return as_of_join(purchases, views, ["user_id"], "ts", "viewed_at", ["view_id"])


@query(
    f"""{_TWO_DELIVERIES_SQL}
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderdate, b.o_orderdate) AS o_orderdate,
  coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
  coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, {_FLAG_SQL}
FROM before b FULL JOIN after a ON a.o_custkey = b.o_custkey"""
)
def upsert_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later delivery merged into the state after the earlier one."""
    before, after = _deliveries(spark, sf_dir)
    return upsert(_state(before), after, ["o_custkey"], sequence_by="o_orderdate", tiebreak=["o_orderkey"])


@query(
    f"""{_TWO_DELIVERIES_SQL}
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderdate, b.o_orderdate) AS o_orderdate,
  coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
  coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus
FROM before b FULL JOIN after a ON a.o_custkey = b.o_custkey"""
)
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later delivery merged into a table in buckets of its key, which is then saved in buckets again."""
    before, after = _deliveries(spark, sf_dir)
    name = f"{_database(spark)}.newest_orders"
    save_bucketed(_newest(before), name, ["o_custkey"])
    merged = upsert(spark.table(name), after, ["o_custkey"], sequence_by="o_orderdate", tiebreak=["o_orderkey"])
    save_bucketed(merged.drop("update_flag"), name, ["o_custkey"])
    return spark.table(name)


@query(
    f"""{_TWO_DELIVERIES_SQL}
SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, coalesce(b.o_orderdate, a.o_orderdate) AS o_orderdate,
  coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
  coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, {_FLAG_SQL}
FROM before b FULL JOIN after a ON a.o_custkey = b.o_custkey"""
)
def upsert_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matched row takes the listed columns only; an inserted row takes all."""
    before, after = _deliveries(spark, sf_dir)
    return upsert(_state(before), _state(after), ["o_custkey"], update_columns=["o_totalprice", "o_orderstatus"])


@query(
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders) WHERE n = 1"""
)
def upsert_older_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries in the wrong order give the same state: older rows do not overwrite newer ones."""
    before, after = _deliveries(spark, sf_dir)
    merged = upsert(_state(after), before, ["o_custkey"], sequence_by="o_orderdate", tiebreak=["o_orderkey"])
    return merged.drop("update_flag")


@query(
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderstatus, 0::BIGINT AS run_id,
  'I' AS update_flag FROM (SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders
  WHERE o_orderdate < TIMESTAMP '{DELIVERY}') WHERE n = 1"""
)
def asof_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State as of the first of two published runs."""
    path = work_area(spark, "changes")
    for run, delivery in enumerate(_deliveries(spark, sf_dir)):
        publish(latest(delivery, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"]), path, run)
    return read_state(spark, path, ["o_custkey"], "o_orderdate", run=0)


_MERGED_SQL = f"""{_TWO_DELIVERIES_SQL}
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice, {_FLAG_SQL}
FROM before b FULL JOIN after a ON a.o_custkey = b.o_custkey"""
_MERGED = ["o_custkey", "o_orderkey", "o_totalprice", "update_flag"]


def _newest(delivery: DataFrame) -> DataFrame:
    return latest(delivery, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"])


@query(_MERGED_SQL)
def state_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of a log in which a run between two others wrote its rows but never ended."""
    path = work_area(spark, "changes")
    before, after = map(_newest, _deliveries(spark, sf_dir))
    publish(before, path, 0)
    after.withColumn("o_totalprice", -F.col("o_totalprice")).write.parquet(run_path(path, 1, "unfinished"))
    publish(after, path, 2)
    return read_state(spark, path, ["o_custkey"], "o_orderdate").select(*_MERGED)


@query(_MERGED_SQL)
def state_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state, with the same flags, from a log that was folded into a base."""
    path = work_area(spark, "changes")
    for run, delivery in enumerate(_deliveries(spark, sf_dir)):
        publish(_newest(delivery), path, run)
    compact(spark, path, ["o_custkey"], "o_orderdate")
    schema = table(spark, sf_dir, "orders").select(*_ORDER_STATE).schema
    return read_state(spark, path, ["o_custkey"], "o_orderdate", schema=schema).select(*_MERGED)


# Three deliveries in the order they arrive: the last one is late.
_IN_TURN = (("1995-01-01", "1997-01-01"), ("1997-01-01", "2100-01-01"), ("1900-01-01", "1995-01-01"))


def _in_turn_sql() -> str:
    parts = [
        f"""SELECT {k} AS part, * FROM (SELECT *, row_number() OVER {_NEWEST_ORDER} AS n FROM orders
  WHERE o_orderdate >= TIMESTAMP '{low}' AND o_orderdate < TIMESTAMP '{high}') WHERE n = 1"""
        for k, (low, high) in enumerate(_IN_TURN)
    ]
    return f"""WITH p AS ({" UNION ALL ".join(parts)})
SELECT o_custkey, arg_min(o_orderkey, part) AS o_orderkey, arg_min(o_orderstatus, part) AS o_orderstatus,
  max(o_orderdate) AS o_orderdate, arg_max(o_totalprice, o_orderdate) AS o_totalprice FROM p GROUP BY o_custkey"""


@query(_in_turn_sql())
def upsert_partial_in_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries merged in turn: a newer row changes the price, a late one nothing, and all else stays as inserted."""
    orders = table(spark, sf_dir, "orders").select(*_ORDER_STATE)
    day = F.col("o_orderdate")
    state = orders.where(F.lit(False))
    for low, high in _IN_TURN:
        delivery = orders.where((day >= F.lit(low).cast("timestamp_ntz")) & (day < F.lit(high).cast("timestamp_ntz")))
        state = upsert(
            state, delivery, ["o_custkey"], ["o_totalprice"], sequence_by="o_orderdate", tiebreak=["o_orderkey"]
        )
        state = materialize(state.drop("update_flag"), "state")
    return state


@query(
    """WITH a AS (SELECT user_id, count(*) FILTER (event_type = 'signup') AS wins,
  count(*) FILTER (event_type = 'click') AS draws, count(*) FILTER (event_type = 'error') AS losses
  FROM events GROUP BY user_id)
SELECT user_id, wins + draws + losses AS matches_played, wins, draws, losses, 3 * wins + draws AS points,
  rank() OVER (ORDER BY 3 * wins + draws DESC, wins DESC) AS ranking FROM a"""
)
def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    kind = F.col("event_type")
    return gold.standings(
        events, "user_id", kind == "signup", kind == "click", kind == "error", [("points", "desc"), ("wins", "desc")]
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_columns(bronze_columns(standings_snapshots(spark, sf_dir)))


_TABLE = (
    "ranking, team, matches_played, wins, draws, losses, goals_for, goals_against, goal_difference, points"
)
_LATEST_SQL = f"""{STANDINGS_SQL}, latest AS (SELECT {_TABLE} FROM (SELECT *, row_number() OVER
  (PARTITION BY team ORDER BY matches_played DESC, snapshot_date DESC) AS n FROM standings) WHERE n = 1)
"""


@query(f"{STANDINGS_SQL} SELECT {_TABLE}, entity_id, snapshot_date FROM standings")
def rename_derive_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw standings renamed, keyed, home and away added up, in silver columns."""
    return _silver(spark, sf_dir)


@query(
    f"""{STANDINGS_SQL} SELECT DISTINCT {_TABLE} FROM (SELECT *, rank() OVER
  (PARTITION BY team ORDER BY matches_played DESC) AS r FROM standings) WHERE r = 1"""
)
def premier_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row of each team with ties kept, in the order of the ranking."""
    return gold.premier_table(materialize(_silver(spark, sf_dir), "silver"))


_LEAGUE_DAYS = ["2024-01-05", "2024-01-10", "2024-01-15", "2024-01-25", "2024-01-31", "2024-02-10"]


@query(
    f"""{STANDINGS_SQL}, days AS (SELECT unnest({_LEAGUE_DAYS})::DATE AS as_of)
SELECT as_of, {_TABLE} FROM (SELECT *, row_number() OVER (PARTITION BY team, as_of ORDER BY snapshot_date DESC) AS n
  FROM standings JOIN days ON snapshot_date <= as_of) WHERE n = 1"""
)
def league_tables_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The league table as of a list of dates, before, on, between and after the snapshots."""
    return gold.tables_as_of(_silver(spark, sf_dir), _LEAGUE_DAYS)


@query(f"{_LATEST_SQL} SELECT * FROM latest")
def premier_table_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per team."""
    return gold.premier_table(_silver(spark, sf_dir), ties="break")


@query(f"{_LATEST_SQL} SELECT team, wins FROM latest ORDER BY wins DESC, team LIMIT 10")
def leaderboard_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = gold.latest_table(_silver(spark, sf_dir), ties="break")
    return gold.leaderboard(gold.series(table_, "team", "wins"), "wins", k=10)


@query(f"{_LATEST_SQL} SELECT team, goals_for FROM latest ORDER BY goals_for DESC, team LIMIT 10")
def leaderboard_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = gold.latest_table(_silver(spark, sf_dir), ties="break")
    return gold.leaderboard(gold.series(table_, "team", "goals_for"), "goals_for", k=10)


@query(
    f"{_LATEST_SQL} SELECT DISTINCT team, points, goal_difference FROM latest ORDER BY points DESC, goal_difference DESC"
)
def table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct projection of the table by points, then goal difference."""
    view = gold.latest_table(_silver(spark, sf_dir), ties="break").select("team", "points", "goal_difference")
    return view.distinct().orderBy(F.desc("points"), F.desc("goal_difference"), "team")


_SUMMARY_SQL = """WITH r AS (SELECT user_id, day(ts) % 2 = 0 AS home, event_type FROM events
  WHERE event_type IN ('signup', 'click', 'error'))
SELECT user_id, DATE '2024-01-31' AS match_date,
  count(*) FILTER (home) AS played_home, count(*) FILTER (NOT home) AS played_away, count(*) AS played_total,
  count(*) FILTER (home AND event_type = 'signup') AS wins_home,
  count(*) FILTER (NOT home AND event_type = 'signup') AS wins_away,
  count(*) FILTER (event_type = 'signup') AS wins_total,
  count(*) FILTER (home AND event_type = 'click') AS draws_home,
  count(*) FILTER (NOT home AND event_type = 'click') AS draws_away,
  count(*) FILTER (event_type = 'click') AS draws_total,
  count(*) FILTER (home AND event_type = 'error') AS loses_home,
  count(*) FILTER (NOT home AND event_type = 'error') AS loses_away,
  count(*) FILTER (event_type = 'error') AS loses_total, {extra} FROM r GROUP BY user_id"""


_CONSISTENT_SQL = """count(*) FILTER (home) + count(*) FILTER (NOT home) = count(*)
  AND count(*) FILTER (event_type = 'signup') + count(*) FILTER (event_type = 'click')
    + count(*) FILTER (event_type = 'error') = count(*) AS is_consistent"""


@query(_SUMMARY_SQL.format(extra=_CONSISTENT_SQL))
def team_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last season summary of each team, checked against its own counters."""
    return gold.team_summary(undot_columns(team_summaries(spark, sf_dir)), ["user_id"])


_FIRST_WIN_SQL = "CASE WHEN bool_or(day(ts) <= 10 AND event_type = 'signup') THEN 'U' ELSE 'I' END AS update_flag"


@query(_SUMMARY_SQL.format(extra=_FIRST_WIN_SQL).replace("SELECT user_id, day(ts)", "SELECT user_id, ts, day(ts)"))
def upsert_team_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last season summaries merged into the first ones; a team without a win by then is new."""
    summaries = undot_columns(team_summaries(spark, sf_dir))
    day = F.col("match_date")
    first = summaries.where((day == F.lit("2024-01-10").cast("date")) & (F.col("wins_total") > 0))
    later = summaries.where(day > F.lit("2024-01-10").cast("date"))
    return upsert(first, later, ["user_id"], sequence_by="match_date")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return first_rows(orders, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 10)
