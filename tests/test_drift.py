import json

from conftest import rows
from pyspark.sql import types as T

from snaptide.schemas import PLAYERS_PAYLOAD
from snaptide.sources.drift import payload_drift, payload_shapes, shape_drift, variant_players
from snaptide.sources.nested import explode_payload

DECLARED = "a bigint, b struct<c: string, d: double>, l array<struct<x: bigint, y: boolean>>, t timestamp"


def frame(spark, *payloads):
    return spark.createDataFrame([(s, p if p is None or isinstance(p, str) else json.dumps(p)) for s, p in payloads], "s string, p string")


def test_differences_by_source(spark):
    df = frame(
        spark,
        ("same", {"a": 1, "b": {"c": "x", "d": 2}, "l": [{"x": 1}, {"y": True}], "t": "2024-01-01"}),
        ("null", {"a": None, "b": None, "l": [], "t": None}),
        ("more", {"a": 1, "b": {"c": "x", "d": 2.5, "e e": [1]}, "l": [{"x": 1, "y": True, "z": {"q": None}}], "t": "x", "OBJECT<": 1}),
        ("types", {"a": "1", "b": {"c": 5, "d": "x"}, "l": [{"x": True, "y": 0}], "t": 7}),
        ("two", {"a": 1, "b": {"c": "x"}, "t": ""}), ("two", {"b": {"d": 1}, "l": [{"x": 2, "y": False}]}), ("two", "{broken"),
        ("none", None), ("none", "{"),
    )
    got = {}
    for r in payload_drift(df, "p", T.StructType.fromDDL(DECLARED), ["s"]).collect():
        got.setdefault(r["s"], set()).add((r["path"], r["drift"]))
    assert got == {
        "null": {(p, "vanished") for p in ("b.c", "b.d", "l[].x", "l[].y")},
        "more": {("b.e e[]", "unknown"), ("l[].z.q", "unknown"), ("OBJECT<", "unknown")},
        "types": {(p, "retyped") for p in ("a", "b.c", "b.d", "l[].x", "l[].y", "t")},
    }
    shapes = {r["s"]: (r["shape"] is None, r["unreadable"]) for r in payload_shapes(df, "p", ["s"]).collect()}
    assert shapes["two"] == (False, 1) and shapes["none"][1] == 1


def test_names_in_quotes_are_no_types(spark):
    assert shape_drift("OBJECT<`OBJECT<x>`: BIGINT>", T.StructType.fromDDL("`OBJECT<x>` bigint")) == []


def test_players_of_a_sound_payload_are_those_of_the_declared_schema(spark):
    item = {
        "player": {"id": 1, "name": "A", "age": 30, "birth": {"date": "2000-01-01", "country": "X"}, "injured": False},
        "statistics": [{"goals": {"total": 3}, "games": {"rating": "7.1", "captain": True}}, {"fouls": {"committed": 2}}],
    }
    df = frame(spark, ("s", {"response": [item, {"player": {"id": 2}, "statistics": []}]}), ("t", {"response": []}), ("u", "{"))
    assert rows(variant_players(df, "p")) == rows(explode_payload(df, "p", PLAYERS_PAYLOAD))


def test_either_spelling_and_fields_of_a_wrong_type(spark):
    def player(i, **statistics):
        return {"player": {"id": i, "age": "old" if i == 3 else 20}, "statistics": [statistics, {"goals": {"total": 9}}]}

    body = {"response": [
        player(1, fouls={"committed": 4}, penalty={"commited": 1}),
        player(2, fouls={"commited": 5}, penalty={"committed": 2}),
        player(3, fouls={"committed": "many"}, goals={"total": 7}),
        player(4, fouls=None, goals=[1]),
    ]}
    got = variant_players(frame(spark, ("s", body)), "p")
    picked = got.selectExpr("id", "age", "statistics_no", "`0`.fouls.committed", "`0`.penalty.commited", "`0`.goals.total")
    assert rows(picked.where("statistics_no = 0")) == [(1, 20, 0, 4, 1, None), (2, 20, 0, 5, 2, None), (3, None, 0, None, None, 7), (4, 20, 0, None, None, None)]
    assert [r[0] for r in rows(picked.where("statistics_no = 1").select("total"))] == [9] * 4
