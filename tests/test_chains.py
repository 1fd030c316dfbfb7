import json
import os

import pytest
from conftest import rows
from pyspark.sql import types as T

from snaptide.operators.quality import row_count
from snaptide.operators.reshape import undot_columns
from snaptide.plans import chains
from snaptide.plans.zones import QualityFailure
from snaptide.schemas import TEAM_SUMMARY
from snaptide.sinks.publish import read_run
from snaptide.streaming.landing import read_quarantine

SCHEMA = T.StructType([T.StructField("team", T.StringType()), *TEAM_SUMMARY])


def summary(team, day, home, away):
    counts = [[sum(home), sum(away)], *([h, a] for h, a in zip(home, away))]
    return ",".join([team, *(str(x) for h, a in counts for x in (h, a, h + a)), day])


def deliver(area, name, *lines):
    os.makedirs(f"{area}/landing", exist_ok=True)
    header = ",".join(f.name for f in SCHEMA)
    with open(f"{area}/landing/{name}.csv", "w") as file:
        file.write("\n".join([header, *lines]) + "\n")


def test_team_chain_from_files_to_the_published_summary(spark, area):
    chain = chains.team_chain(f"{area}/landing", area, SCHEMA, ["team"], rules=[row_count(2)])
    deliver(area, "1", summary("a", "2023-03-01", (1, 0, 0), (0, 1, 0)), summary("b", "2023-03-01", (0, 0, 1), (0, 0, 0)))
    reports, _ = chains.run_chain(spark, chain)
    assert rows(reports["summary"].select("team", "played_total", "is_consistent")) == [("a", 2, True), ("b", 1, True)]
    # a newer row, a late one and a copy
    deliver(area, "2", summary("a", "2023-04-01", (2, 0, 0), (0, 1, 0)), summary("b", "2023-02-01", (0, 0, 0), (0, 0, 0)))
    deliver(area, "3", summary("a", "2023-04-01", (2, 0, 0), (0, 1, 0)))
    reports, _ = chains.run_chain(spark, chain)
    assert rows(reports["summary"].select("team", "played_total")) == [("a", 3), ("b", 1)]
    assert spark.read.parquet(chain.path("silver")).count() == 4
    # a run with a line that cannot be read publishes nothing; the next one publishes its good rows, too
    deliver(area, "4", "oops", summary("b", "2023-05-01", (5, 0, 0), (0, 0, 0)))
    with pytest.raises(QualityFailure, match="rejected"):
        chains.run_chain(spark, chain)
    assert rows(read_run(spark, chain.path("gold/summary")).select("team", "played_total")) == [("a", 3), ("b", 1)]
    deliver(area, "5", summary("a", "2023-05-01", (6, 0, 0), (0, 0, 0)))
    reports, _ = chains.run_chain(spark, chain)
    assert rows(reports["summary"].select("team", "played_total")) == [("a", 6), ("b", 5)]
    assert rows(read_quarantine(spark, chain.path("quarantine")).select("source_file", "_rejected", "reason")) == [("4.csv", "oops", "line")]
    audit = {r.step: (r.rows_in, r.rows_out, r.rejected) for r in chains.chain_audit(spark, chain).collect()}
    assert audit["teams_bronze"] == (8, 7, 1)
    assert audit["teams_silver"] == (7, 6, None) and audit["teams_current"][0] == 6
    assert audit["current"] == (None, 6, 0) and audit["summary"] == (None, 6, None)


def test_player_chain_keeps_rejects_and_the_last_document(spark, area):
    def player(i, goals):
        statistics = {"team": {"name": "T"}, "goals": {"total": goals, "assists": 1}, "games": {"position": "x"}}
        return json.dumps({"id": i, "name": f"p{i}", "age": 20 + i, "0": statistics})

    os.makedirs(f"{area}/landing")
    for name, lines in (("1", [player(1, 3), player(2, 4)]), ("2", [player(1, 5), player(2, 4), '{"id": '])):
        with open(f"{area}/landing/{name}.json", "w") as file:
            file.write("\n".join(lines) + "\n")
    chain = chains.player_chain(f"{area}/landing", area, multi_line=False)
    reports, checks = chains.run_chain(spark, chain, gate=False)
    got = [(r.id, r.contributions) for r in reports["top_contributions"].collect()]
    assert sorted(got) == [(1, 6), (2, 5)]
    assert [tuple(r) for r in checks.select("check_name", "observed").collect()] == [("rejected", 1)]


def test_a_corrected_count_is_taken_and_a_copy_is_not_a_change(spark, area):
    os.makedirs(f"{area}/landing")
    chain = chains.player_chain(f"{area}/landing", area, multi_line=False)
    for name, goals in (("1", 5), ("2", 7), ("3", 7), ("4", 5)):
        with open(f"{area}/landing/{name}.json", "w") as file:
            file.write(json.dumps({"id": 1, "name": "p", "age": 20, "0": {"goals": {"total": goals, "assists": 1}}}) + "\n")
        reports, _ = chains.run_chain(spark, chain)
    assert [r.contributions for r in reports["top_contributions"].collect()] == [6]
    assert [r.goals for r in spark.read.parquet(chain.path("silver")).orderBy("collected").collect()] == [5, 7, 5]


def test_the_audit_counts_what_changed_and_not_what_came(spark, area):
    os.makedirs(f"{area}/landing")
    chain = chains.player_chain(f"{area}/landing", area, multi_line=False)
    for name, goals in (("1", 5), ("2", 5), ("3", 6)):
        with open(f"{area}/landing/{name}.json", "w") as file:
            for i in range(3):
                file.write(json.dumps({"id": i, "name": "p", "age": 20, "0": {"goals": {"total": goals + (i > 0), "assists": 1}}}) + "\n")
        chains.run_chain(spark, chain)
    audit = {r.step: (r.rows_in, r.rows_out) for r in chains.chain_audit(spark, chain).collect()}
    assert audit["players_silver"] == (9, 6)


def test_names_that_would_be_the_same_are_refused(spark):
    with pytest.raises(ValueError):
        undot_columns(spark.range(1).selectExpr("id AS `a.b`", "id AS a_b"))
