"""Nested player documents and API payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.reshape import flatten, with_constant
from ..plans import gold
from ..schemas import PLAYERS, PLAYERS_PAYLOAD, TEAM_COUNTERS, TEAM_PAYLOAD, TEAM_SIDES
from ..scratch import work_area
from ..sources.drift import payload_drift, variant_players
from ..sources.files import REJECTED
from ..sources.nested import explode_payload, normalise_payload, payload_rejects, read_nested_json
from .derived import player_documents, player_payloads, team_summaries
from .registry import query, table

_FACTS_SQL = """WITH counted AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS goals,
    count(*) FILTER (o_orderstatus = 'O') AS assists FROM orders GROUP BY o_custkey),
  facts AS (SELECT c_custkey AS id, c_name AS name, (c_nationkey + 17)::BIGINT AS age, c_mktsegment AS team,
    lower(c_mktsegment) AS position, goals, assists FROM customer LEFT JOIN counted ON o_custkey = c_custkey)
"""


@query(f"{_FACTS_SQL} SELECT * FROM facts")
def json_nested_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents written as JSON, read with the declared schema, fields selected by path."""
    path = f"{work_area(spark, 'json')}/players"
    player_documents(spark, sf_dir).write.mode("overwrite").json(path)
    return gold.player_facts(read_nested_json(spark, path, PLAYERS, multi_line=False))


@query(f"{_FACTS_SQL} SELECT * FROM facts")
def payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payloads taken apart: profile beside statistics of the same response element."""
    players = explode_payload(player_payloads(spark, sf_dir), "payload", PLAYERS_PAYLOAD)
    return gold.player_facts(players)


@query(
    """WITH entries AS (SELECT o_custkey, o_orderpriority < '3' AS urgent, count(*) FILTER (o_orderstatus = 'F') AS goals,
    count(*) FILTER (o_orderstatus = 'O') AS assists FROM orders GROUP BY ALL)
SELECT c_custkey AS id, c_name AS name, sum(goals)::BIGINT AS goals, sum(assists)::BIGINT AS assists,
  count(o_custkey) AS entries FROM customer LEFT JOIN entries ON o_custkey = c_custkey GROUP BY c_custkey, c_name"""
)
def payload_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with a statistics entry for each of up to two clubs, all of them read and added up."""
    urgent = (F.col("o_orderpriority") < "3").alias("urgent")
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey", urgent).agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("total"), F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("assists")
    )
    # two entries at most
    entry = F.struct(F.struct("total", "assists").alias("goals"))
    clubs = counted.groupBy("o_custkey").agg(F.collect_list(entry).alias("statistics"))
    players = table(spark, sf_dir, "customer").join(clubs, F.col("c_custkey") == F.col("o_custkey"), "left")
    profile = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("player")
    body = F.struct(F.array(F.struct(profile, "statistics")).alias("response"))
    entries = explode_payload(players.select(F.to_json(body).alias("payload")), "payload", PLAYERS_PAYLOAD)
    facts = gold.player_facts(entries, "statistics_no")
    number = facts.groupBy("id").agg(F.count("statistics_no").alias("entries"))
    return gold.player_totals(facts).select("id", "name", "goals", "assists").join(number, "id")


def _segment_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload per customer of one segment or another, as ``source``: ids, names, orders as goals and fouls."""
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "customer").join(counted, F.col("c_custkey") == F.col("o_custkey"), "left")
    n = F.coalesce("n", F.lit(0))
    profile = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("player")
    entry = F.struct(F.struct(n.alias("total")).alias("goals"), F.struct((n * 2).alias("committed")).alias("fouls"))
    body = F.struct(F.array(F.struct(profile, F.array(entry).alias("statistics"))).alias("response"))
    return rows.select(F.col("c_mktsegment").alias("source"), F.to_json(body).alias("payload"))


def _drifted(payloads: DataFrame) -> DataFrame:
    """One segment spells a field otherwise, one names its goals anew, one sends the name as a number."""
    source = F.col("source")
    text = F.when(source == "BUILDING", F.replace("payload", F.lit("committed"), F.lit("commited")))
    text = text.when(source == "MACHINERY", F.replace("payload", F.lit('"total"'), F.lit('"scored by"')))
    text = text.when(source == "FURNITURE", F.regexp_replace("payload", '"name":"[^"]*"', '"name":12'))
    return payloads.withColumn("payload", text.otherwise(F.col("payload")))


@query(
    """SELECT * FROM (VALUES
  ('BUILDING', 'response[].statistics[].fouls.commited', 'unknown', NULL, 'bigint'),
  ('BUILDING', 'response[].statistics[].fouls.committed', 'vanished', 'bigint', NULL),
  ('MACHINERY', 'response[].statistics[].goals.scored by', 'unknown', NULL, 'bigint'),
  ('MACHINERY', 'response[].statistics[].goals.total', 'vanished', 'bigint', NULL),
  ('FURNITURE', 'response[].player.name', 'retyped', 'string', 'bigint')) t(source, path, drift, declared, found)
WHERE source IN (SELECT c_mktsegment FROM customer)""",
    "payload_drift",
)
def payload_drift_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the payloads of each segment differ from the schema."""
    declared = T.StructType.fromDDL(
        "response array<struct<player: struct<id: bigint, name: string>, "
        "statistics: array<struct<goals: struct<total: bigint>, fouls: struct<committed: bigint>>>>>"
    )
    return payload_drift(_drifted(_segment_payloads(spark, sf_dir)), "payload", declared, ["source"])


@query(
    """SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_name ELSE '12' END AS name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN count(o_custkey) END AS goals,
  2 * count(o_custkey) AS fouls FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_mktsegment"""
)
def payload_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payloads read: either spelling arrives, and a drifted field loses nothing but itself."""
    players = variant_players(_drifted(_segment_payloads(spark, sf_dir)), "payload")
    return players.select("id", "name", F.col("`0`.goals.total").alias("goals"), F.col("`0`.fouls.committed").alias("fouls"))


def _cut(whole: Column) -> Column:
    """JSON that ends too soon for customers in debt."""
    return F.when(F.col("c_acctbal") < 0, F.expr("substring(whole, 1, length(whole) - 3)")).otherwise(whole)


@query(
    """SELECT c_custkey AS id, CASE WHEN c_acctbal < -500 THEN 'no payload' ELSE 'unreadable' END AS reason FROM customer
WHERE c_acctbal < 0"""
)
def payload_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of customers in debt cut short or left out, and listed instead of dropped."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal", "c_name")
    player = F.struct(F.struct("id", F.col("c_name").alias("name")).alias("player"))
    rows = customers.withColumn("whole", F.to_json(F.struct(F.array(player).alias("response"))))
    payloads = rows.select("id", F.when(F.col("c_acctbal") >= -500, _cut(F.col("whole"))).alias("payload"))
    return payload_rejects(payloads, "payload", PLAYERS_PAYLOAD).select("id", "reason")


@query("SELECT count(*) FILTER (c_acctbal >= 0) AS read, count(*) FILTER (c_acctbal < 0) AS rejected FROM customer")
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of JSON of which some are cut short: read or kept as rejects, none lost."""
    path = f"{work_area(spark, 'json')}/players"
    whole = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    customers = table(spark, sf_dir, "customer").select("c_acctbal", whole.alias("whole"))
    customers.select(_cut(F.col("whole")).alias("value")).write.text(path)
    players = read_nested_json(spark, path, PLAYERS, multi_line=False, keep_rejects=True)
    return players.select("id", REJECTED).agg(
        F.count(F.when(F.col(REJECTED).isNull() & F.col("id").isNotNull(), 1)).alias("read"),
        F.count(REJECTED).alias("rejected"),
    )


@query(
    f"""{_FACTS_SQL} SELECT id, name, birth_country, team AS "0_team_name", goals AS "0_goals_total" FROM (
  SELECT facts.*, (age - 17)::INT::VARCHAR AS birth_country FROM facts)"""
)
def flatten_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nested field as a flat column; some of them shown."""
    flat = flatten(player_documents(spark, sf_dir))
    return flat.select("id", "name", "birth_country", "0_team_name", "0_goals_total")


@query(f"{_FACTS_SQL} SELECT * FROM facts WHERE goals > 0 ORDER BY age, goals DESC, id LIMIT 20")
def youngest_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.youngest_scorers(gold.player_facts(player_documents(spark, sf_dir)), 20)


@query(
    f"""{_FACTS_SQL} SELECT *, coalesce(goals, 0) + coalesce(assists, 0) AS contributions FROM facts
  ORDER BY contributions DESC, id LIMIT 20"""
)
def top_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_contributions(gold.player_facts(player_documents(spark, sf_dir)), 20)


@query(f"{_FACTS_SQL} SELECT * FROM facts WHERE assists IS NOT NULL ORDER BY assists DESC, id LIMIT 20")
def top_assists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_assists(gold.player_facts(player_documents(spark, sf_dir)), 20)


@query(
    """SELECT user_id, DATE '2024-01-31' AS match_date, count(*) AS played_total,
  count(*) FILTER (event_type = 'signup') AS wins_total, count(*) FILTER (event_type = 'click') AS draws_total,
  count(*) FILTER (event_type = 'error') AS loses_total FROM events
  WHERE event_type IN ('signup', 'click', 'error') GROUP BY user_id"""
)
def payload_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team payloads as flat counters with the date of the collection as a constant."""
    day = F.lit("2024-01-31").cast("date")
    summaries = team_summaries(spark, sf_dir).where(F.col("match_date") == day)
    fixtures = F.struct(
        *[F.struct(*[F.col(f"`{c}.{s}`").alias(s) for s in TEAM_SIDES]).alias(c) for c in TEAM_COUNTERS]
    )
    payloads = summaries.select(
        "user_id", F.to_json(F.struct(F.struct(fixtures.alias("fixtures")).alias("response"))).alias("payload")
    )
    flat = flatten(normalise_payload(payloads, "payload", TEAM_PAYLOAD, "response.fixtures"))
    dated = with_constant(flat, "match_date", day)
    return dated.select("user_id", "match_date", "played_total", "wins_total", "draws_total", "loses_total")
