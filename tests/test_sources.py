import json
import os

import snapshots
from conftest import rows
from pyspark.sql import functions as F

from snaptide.plans.cleaning import clean_snapshots
from snaptide.plans.gold import player_facts
from snaptide.plans.zones import bronze_columns, silver_columns
from snaptide.plans.gold import player_facts, player_totals
from snaptide.schemas import (
    PLAYERS,
    PLAYERS_PAYLOAD,
    RAW_FILE_COLUMNS,
    STANDINGS_DATE_FORMAT,
    STANDINGS_RAW,
    TEAM_PAYLOAD,
)
from snaptide.operators.reshape import flatten
from snaptide.sources.files import read_snapshots, read_raw, with_source_file
from snaptide.sources.html import html_cells, html_table_rows, table_records, uneven_rows, unreadable_tables
from snaptide.sources.nested import explode_payload, normalise_payload, payload_rejects, read_nested_json


def test_duplicate_headers_bind_by_position_and_dates_parse(spark, area):
    snapshots.write(f"{area}/clean", "table_2023-Mar-12.csv", snapshots.FIRST)
    df = read_snapshots(spark, f"{area}/clean", STANDINGS_RAW, STANDINGS_DATE_FORMAT)
    silver = silver_columns(bronze_columns(df))
    north = silver.where("ranking = 1").first()
    assert north.team == "North End" and north.entity_id == "northend_123"
    assert (north.wins, north.draws, north.losses, north.goals_for, north.goals_against) == (3, 1, 0, 8, 3)
    assert (north.matches_played, north.goal_difference, north.points) == (4, 5, 10)
    assert str(north.snapshot_date) == "2023-03-12"
    assert silver.where("entity_id = 'afcsouth_123'").count() == 1


def test_malformed_lines_are_kept_for_counting(spark, area):
    bad = ["x", *snapshots.FIRST[1][1:]]
    snapshots.write(f"{area}/bad", "a.csv", [snapshots.FIRST[0], bad, [*snapshots.FIRST[2][:-1], "12/03/2023"]])
    df = read_snapshots(spark, f"{area}/bad", STANDINGS_RAW, STANDINGS_DATE_FORMAT, keep_rejects=True).cache()
    assert df.count() == 3
    assert df.where(F.col("_rejected").isNotNull()).count() == 2


def test_raw_directory_is_cleaned_in_one_job(spark, area):
    raw = f"{area}/raw"
    snapshots.write(raw, "1.csv", [snapshots.with_gaps(r) for r in snapshots.FIRST], snapshots.RAW_HEADER)
    hole = snapshots.with_gaps(snapshots.SECOND[0])
    hole[5] = ""
    snapshots.write(raw, "2.csv", [hole], snapshots.RAW_HEADER)
    clean = clean_snapshots(spark, raw, RAW_FILE_COLUMNS, STANDINGS_RAW, STANDINGS_DATE_FORMAT)
    assert clean.schema == STANDINGS_RAW
    assert clean.count() == 4
    row = clean.where("match_date = DATE '2023-03-16'").first()
    # The missing value stays missing; the ones after it do not move.
    assert row["D"] is None and row["W"] == 3 and row["L"] == 0 and row["Pts"] == 13


def test_source_file_is_kept(spark, area):
    snapshots.write(f"{area}/f", "one.csv", snapshots.FIRST)
    files = with_source_file(read_raw(spark, f"{area}/f", 16)).select("source_file").distinct()
    assert rows(files) == [("one.csv",)]


def player(identity, name, goals):
    return {
        "id": identity, "name": name, "firstname": None, "lastname": None, "age": 22,
        "birth": {"date": "2000-07-21", "place": None, "country": "Norway"},
        "nationality": "Norway", "height": "194 cm", "weight": "88 kg", "injured": False, "photo": None,
    }, {
        "team": {"id": 50, "name": "City", "logo": None},
        "games": {"appearences": 26, "number": None, "position": "Attacker", "rating": "7.5", "captain": False},
        "goals": {"total": goals, "conceded": 0, "assists": None, "saves": None},
        "fouls": {"drawn": 3, "committed": 7},
        "penalty": {"won": None, "commited": 2, "scored": 4},
    }


def test_indented_json_array(spark, area):
    people = []
    for args in ((1, "A", 28), (2, "B", 20)):
        profile, statistics = player(*args)
        people.append({**profile, "0": statistics})
    import os

    os.makedirs(f"{area}/json")
    with open(f"{area}/json/players.json", "w") as file:
        json.dump(people, file, indent=4)
    df = read_nested_json(spark, f"{area}/json", PLAYERS)
    assert rows(player_facts(df).select("id", "team", "goals", "assists")) == [(1, "City", 28, None), (2, "City", 20, None)]
    # Spelled as in the data.
    assert rows(df.select("`0`.fouls.committed", "`0`.penalty.commited").distinct()) == [(7, 2)]
    flat = flatten(df)
    assert "0_goals_total" in flat.columns and "birth_country" in flat.columns


def test_payload_with_several_players_and_missing_statistics(spark):
    profile, statistics = player(1, "A", 28)
    other, _ = player(2, "B", 0)
    payload = json.dumps(
        {"response": [{"player": profile, "statistics": [statistics, {}]}, {"player": other, "statistics": []}]}
    )
    df = spark.createDataFrame([(7, payload), (8, '{"response": []}'), (9, "no json")], "call int, body string")
    missing = spark.createDataFrame([(10, None)], "call int, body string")
    lost = payload_rejects(df.unionByName(missing), "body", PLAYERS_PAYLOAD)
    assert rows(lost.select("call", "reason")) == [(10, "no payload"), (9, "unreadable")]
    got = explode_payload(df, "body", PLAYERS_PAYLOAD)
    assert got.columns[:3] == ["call", "id", "name"]
    # every statistics entry is a row, and a player without any has one
    assert rows(got.select("call", "id", "`0`.goals.total", "statistics_no")) == [(7, 1, 28, 0), (7, 1, None, 1), (7, 2, None, None)]


def test_team_payload(spark):
    body = {"response": {"fixtures": {"played": {"home": 13, "away": 12, "total": 25}, "wins": {"home": 9}}}}
    df = spark.createDataFrame([("2023-03-08", json.dumps(body))], "match_date string, body string")
    flat = flatten(normalise_payload(df, "body", TEAM_PAYLOAD, "response.fixtures"))
    row = flat.first()
    assert (row.match_date, row.played_total, row.wins_home, row.wins_away) == ("2023-03-08", 25, 9, None)


PAGE = """<html><table class="other"><tr><td>no</td></tr></table>
<TABLE id='x' class="wide leaguetable"><thead><tr class="h"><th>Pos</th><th>Team</th></tr></thead>
<tr><td>1</td><td> <a href="/n">North
 End</a></td></tr><tr><td>2</td><td>South</td><td>9</td></tr></TABLE></html>"""


def test_html_table(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "page_id int, html string")
    found = html_table_rows(pages, ["page_id"])
    assert rows(found) == [
        (1, 0, 0, ["Pos", "Team"]), (1, 0, 1, ["1", "North End"]), (1, 0, 2, ["2", "South", "9"]),
    ]
    assert rows(table_records(found, ["Pos", "Team", "P"])) == [
        (1, 0, 1, "1", "North End", None, []), (1, 0, 2, "2", "South", "9", []),
    ]
    # no cell is lost
    assert rows(table_records(found, ["Pos"])) == [(1, 0, 1, "1", ["North End"]), (1, 0, 2, "2", ["South", "9"])]
    assert rows(uneven_rows(found, ["Pos", "Team"]).select("row_no")) == [(2,)]
    assert html_cells(pages, ["page_id"]).count() == 6


def test_tables_that_cannot_be_read_are_counted(spark):
    pages = spark.createDataFrame(
        [(1, PAGE), (2, "<table><tr><td>"), (3, "<table><tr><td><table></table></td></tr></table>")],
        "page_id int, html string",
    )
    assert rows(unreadable_tables(pages, ["page_id"])) == [(2, "o"), (3, "oocc")]


def test_a_page_of_megabytes_is_read_whole(spark):
    lines = 60_000
    body = "".join(f"<tr><td>{i}</td><td> a &amp; b </td></tr>\n" for i in range(lines))
    page = f'<table class="leaguetable"><tr><td>Pos</td></tr>{body}</table>'
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    records = table_records(html_table_rows(pages, ["page_id"]), ["pos", "team"])
    assert records.count() == lines
    assert records.agg(F.max(F.col("pos").cast("int"))).first()[0] == lines - 1
    assert unreadable_tables(pages, ["page_id"]).count() == 0
    assert html_cells(pages, ["page_id"]).count() == 2 * lines + 1


def test_comments_and_entities_of_a_page(spark):
    page = """<!-- <table class='leaguetable'><tr><td>old</td></tr></table> --><table class='leaguetable'><tr><td>Team</td></tr>
<tr><td>Brighton &amp; Hove</td></tr><tr><td>K&ouml;ln&nbsp;&#49;</td></tr></table><!-- <td>open"""
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    records = table_records(html_table_rows(pages, ["page_id"]), ["team"])
    assert [r.team for r in records.orderBy("row_no").collect()] == ["Brighton & Hove", "K\u00f6ln 1"]
    assert html_cells(pages, ["page_id"]).count() == 3
    assert unreadable_tables(pages, ["page_id"]).count() == 0
    assert html_table_rows(pages, ["page_id"], table_class="league.*").count() == 0


def test_broken_json_is_kept(spark, area):
    os.makedirs(f"{area}/json")
    with open(f"{area}/json/players.json", "w") as file:
        file.write('{"id": 1}\n{"id": \n')
    df = read_nested_json(spark, f"{area}/json", PLAYERS, multi_line=False, keep_rejects=True)
    assert rows(df.select("id", "_rejected")) == [(1, None), (None, '{"id": ')]


def test_goals_at_two_clubs_are_added_up(spark):
    profile, statistics = player(1, "A", 7)
    _, second = player(1, "A", 9)
    payload = json.dumps({"response": [{"player": profile, "statistics": [statistics, second]}]})
    facts = player_facts(explode_payload(spark.createDataFrame([(payload,)], "body string"), "body", PLAYERS_PAYLOAD), "statistics_no")
    assert rows(facts.select("goals", "statistics_no")) == [(7, 0), (9, 1)]
    assert rows(player_totals(facts).select("id", "goals")) == [(1, 16)]
