"""Snapshot-shaped inputs that Spark derives from the driver's tables.

``events`` is read as match results: a user is a team; signup, click and error
are a win, a draw and a loss; purchase and view are a goal for and against; an
even day is at home. The state of the season is taken on three days of the
month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.ranking import rank_rows
from ..operators.reshape import select_columns
from ..schemas import PLAYERS, PLAYER_PROFILE, STANDINGS_RAW, TEAM_COUNTERS, TEAM_SIDES
from ..scratch import materialize
from .registry import table

# --- fixed values: how results are read from events --------------------------
OUTCOMES = {"W": "signup", "D": "click", "L": "error", "GF": "purchase", "GA": "view"}
SNAPSHOT_DAYS = {10: "2024-01-10", 20: "2024-01-20", 31: "2024-01-31"}

STANDINGS_SQL = """
WITH counted AS (
  SELECT s.snapshot_date, user_id,
    count(*) FILTER (event_type = 'signup' AND day(ts) % 2 = 0) AS wh,
    count(*) FILTER (event_type = 'click' AND day(ts) % 2 = 0) AS dh,
    count(*) FILTER (event_type = 'error' AND day(ts) % 2 = 0) AS lh,
    count(*) FILTER (event_type = 'purchase' AND day(ts) % 2 = 0) AS gfh,
    count(*) FILTER (event_type = 'view' AND day(ts) % 2 = 0) AS gah,
    count(*) FILTER (event_type = 'signup' AND day(ts) % 2 = 1) AS wa,
    count(*) FILTER (event_type = 'click' AND day(ts) % 2 = 1) AS da,
    count(*) FILTER (event_type = 'error' AND day(ts) % 2 = 1) AS la,
    count(*) FILTER (event_type = 'purchase' AND day(ts) % 2 = 1) AS gfa,
    count(*) FILTER (event_type = 'view' AND day(ts) % 2 = 1) AS gaa
  FROM events JOIN (VALUES (10, DATE '2024-01-10'), (20, DATE '2024-01-20'), (31, DATE '2024-01-31'))
    s(last_day, snapshot_date) ON day(ts) <= s.last_day
  GROUP BY ALL),
totals AS (
  SELECT *, 'Team ' || user_id AS team, wh + wa AS wins, dh + da AS draws, lh + la AS losses,
    gfh + gfa AS goals_for, gah + gaa AS goals_against FROM counted),
standings AS (
  SELECT rank() OVER (PARTITION BY snapshot_date
           ORDER BY 3 * wins + draws DESC, goals_for - goals_against DESC, goals_for DESC) AS ranking,
    team, wins + draws + losses AS matches_played, wins, draws, losses, goals_for, goals_against,
    goals_for - goals_against AS goal_difference, 3 * wins + draws AS points,
    lower(replace(team, ' ', '')) || '_123' AS entity_id, snapshot_date,
    wh, dh, lh, gfh, gah, wa, da, la, gfa, gaa FROM totals)
"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of events per team, first snapshot that holds them, side and kind.

    The events are counted by these few groups first, so the many counters of
    a snapshot are then taken from some rows per team and not from its events.
    """
    day = F.dayofmonth("ts")
    first_snapshot = F.least(*[F.when(day <= last_day, last_day) for last_day in SNAPSHOT_DAYS])
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", first_snapshot.alias("since"), (day % 2 == 0).alias("at_home"), "event_type")
        .agg(F.count("*").alias("n"))
    )


def _counter(name: str, last_day: int, at_home: bool, kind: str) -> Column:
    side = "at_home" if at_home else "NOT at_home"
    hit = f"since <= {last_day} AND {side} AND event_type = '{kind}'"
    return F.expr(f"coalesce(sum(n) FILTER (WHERE {hit}), 0) AS `{name}_{last_day}`")


def standings_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three cumulative standings snapshots in the columns of the raw files.

    The three rows of a team come from its counters, not from copies of its
    events.
    """
    names = [f"{name}{suffix}" for suffix in ("", ".1") for name in OUTCOMES]
    counters = []
    for last_day in SNAPSHOT_DAYS:
        counters.append(F.expr(f"count(*) FILTER (WHERE since <= {last_day}) AS n_{last_day}"))
        for name in names:
            counters.append(_counter(name, last_day, not name.endswith(".1"), OUTCOMES[name.removesuffix(".1")]))
    wide = _results(spark, sf_dir).groupBy("user_id").agg(*counters)

    per_day = [
        f"struct(DATE '{date}' AS match_date, n_{last_day} AS n, "
        + ", ".join(f"`{name}_{last_day}` AS `{name}`" for name in names)
        + ")"
        for last_day, date in SNAPSHOT_DAYS.items()
    ]
    rows = (
        wide.selectExpr("user_id", f"inline(array({', '.join(per_day)}))")
        .where("n > 0")
        .selectExpr(
            "concat('Team ', user_id) AS Team",
            "W + `W.1` + D + `D.1` + L + `L.1` AS P",
            *[f"`{name}`" for name in names],
            "GF + `GF.1` - GA - `GA.1` AS GD",
            "3 * (W + `W.1`) + D + `D.1` AS Pts",
            "GF + `GF.1` AS __for",
            "match_date",
        )
    )
    ranked = rank_rows(
        materialize(rows, "snapshots"),
        [("Pts", "desc"), ("GD", "desc"), ("__for", "desc")],
        partition_by=["match_date"],
        name="Pos",
    )
    return select_columns(ranked, STANDINGS_RAW.names)


def team_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season summary of each user on each snapshot day: results at home, away and in total."""
    results = {"wins": "signup", "draws": "click", "loses": "error"}
    counters = [
        _counter(f"{name}_{side}", last_day, side == "home", outcome)
        for last_day in SNAPSHOT_DAYS
        for side in ("home", "away")
        for name, outcome in results.items()
    ]
    counted = _results(spark, sf_dir).where(F.col("event_type").isin(*results.values()))
    wide = counted.groupBy("user_id").agg(*counters)

    def value(counter: str, side: str, last_day: int) -> str:
        sides = ("home", "away") if side == "total" else (side,)
        counted = results if counter == "played" else (counter,)
        return " + ".join(f"{name}_{s}_{last_day}" for name in counted for s in sides)

    per_day = [
        "struct("
        + ", ".join(f"{value(c, s, last_day)} AS `{c}.{s}`" for c in TEAM_COUNTERS for s in TEAM_SIDES)
        + f", DATE '{date}' AS match_date)"
        for last_day, date in SNAPSHOT_DAYS.items()
    ]
    return wide.selectExpr("user_id", f"inline(array({', '.join(per_day)}))")


# --- fixed values: which columns stand for which field of a player ------------
PLAYER_FIELDS = {
    "id": "c_custkey",
    "name": "c_name",
    "age": "c_nationkey + 17",
    "birth.country": "c_nationkey",
    "0.team.name": "c_mktsegment",
    "0.games.position": "lower(c_mktsegment)",
    "0.goals.total": "goals",
    "0.goals.assists": "assists",
}


def player_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as players in the nested shape of the collected files.

    Finished orders are goals, open ones assists; the nation key stands for
    the age.
    """
    counted = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.expr("count(*) FILTER (WHERE o_orderstatus = 'F') AS goals"),
            F.expr("count(*) FILTER (WHERE o_orderstatus = 'O') AS assists"),
        )
    )
    players = table(spark, sf_dir, "customer").join(counted, F.col("c_custkey") == F.col("o_custkey"), "left")

    def value(field: T.StructField, path: str) -> str:
        here = f"{path}{field.name}"
        if isinstance(field.dataType, T.StructType):
            return f"named_struct({', '.join(f"'{f.name}', {value(f, here + '.')}" for f in field.dataType)})"
        return f"CAST({PLAYER_FIELDS.get(here, 'NULL')} AS {field.dataType.simpleString()})"

    return players.selectExpr(*[f"{value(field, '')} AS `{field.name}`" for field in PLAYERS])


def player_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw API payload per player: profile and statistics inside ``response``."""
    documents = player_documents(spark, sf_dir)
    item = F.struct(
        F.struct(*PLAYER_PROFILE.names).alias("player"), F.array(F.col("`0`")).alias("statistics")
    )
    return documents.select(
        F.col("id").alias("payload_id"), F.to_json(F.struct(F.array(item).alias("response"))).alias("payload")
    )


