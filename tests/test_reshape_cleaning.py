import pytest
from conftest import rows
from pyspark.sql import functions as F

from snaptide.functions import (
    blank_to_null,
    collapse_separators,
    constant_key,
    entity_key,
    strip_tags,
    total_contributions,
)
from snaptide.operators import cleaning, dedupe, reshape


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_entity_key(spark):
    assert one(spark, entity_key(F.lit("AFC  Bourne\tmouth"))) == "afcbournemouth_123"
    assert one(spark, entity_key(F.lit(None).cast("string"))) is None
    assert one(spark, constant_key("club", "_123")) == "club_123"


def test_text_functions(spark):
    assert one(spark, collapse_separators(F.lit("1,,,a, ,b,,2"))) == "1,a,b,2"
    assert one(spark, blank_to_null(F.lit(" \t"))) is None
    assert one(spark, blank_to_null(F.lit(" x"))) == " x"
    assert one(spark, strip_tags(F.lit(" <b>West\n  Ham</b><br> 3 "))) == "West Ham 3"


def test_contributions_count_missing_as_none(spark):
    assert one(spark, total_contributions(F.lit(3), F.lit(None).cast("int"))) == 3


def test_rename_takes_dotted_names_and_rejects_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("W", "W.1")
    assert reshape.rename_columns(df, {"W.1": "win_away"}).columns == ["W", "win_away"]
    with pytest.raises(ValueError, match="no such"):
        reshape.rename_columns(df, {"D.1": "draw_away"})
    assert reshape.undot_columns(df).columns == ["W", "W_1"]


def test_totals_are_null_when_a_side_is(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "h int, a int")
    assert rows(reshape.add_totals(df, {"t": ("h", "a")}).select("t")) == [(3,), (None,)]


def test_flatten_goes_through_all_levels(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('0', named_struct('in', 5, 'x.y', 6), 'b', 'q') AS s")
    flat = reshape.flatten(df)
    assert flat.columns == ["id", "s_0_in", "s_0_x.y", "s_b"]
    assert rows(flat) == [(1, 5, 6, "q")]


def test_pivot_has_the_given_columns_only(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (1, "z", 9), (2, "b", 1)], "k int, p string, v int")
    got = reshape.pivot_sum(df, ["k"], "p", ["a", "b"], F.sum("v"))
    assert got.columns == ["k", "a", "b"]
    assert rows(got) == [(1, 5, None), (2, None, 1)]


def test_explode_map_and_append(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 'x') AS m UNION ALL SELECT 2, map()")
    assert rows(reshape.explode_map(df, "m")) == [(1, "a", "x")]
    more = spark.createDataFrame([(3, "n")], "k int, extra string")
    appended = reshape.append_rows(spark.createDataFrame([(1,)], "k int"), more)
    assert rows(appended) == [(1, None), (3, "n")]


def test_blank_columns_go_and_gaps_in_a_row_stay(spark):
    df = spark.createDataFrame(
        [("1", " ", "x", None, ""), ("2", None, None, None, "\t"), ("3", "", "z", None, " ")],
        "a string, gap string, b string, empty string, tab string",
    )
    assert rows(cleaning.drop_blank_columns(df)) == [("1", "x"), ("2", None), ("3", "z")]


def test_blank_columns_of_an_empty_table(spark):
    assert cleaning.drop_blank_columns(spark.createDataFrame([], "a int, b string")).columns == []


def test_compact_row_moves_values_left(spark):
    df = spark.createDataFrame([(1, None, "b", "c"), (2, "a", None, None)], "id int, x string, y string, z string")
    with pytest.raises(ValueError):
        cleaning.compact_row(df, ["x", "y", "z"], ["f1", "f2"])
    got = cleaning.compact_row(df, ["x", "y", "z"], ["f1", "f2", "f3"])
    assert rows(got) == [(1, "b", "c", None), (2, "a", None, None)]


def test_assign_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert cleaning.assign_names(df, ["x", "y", "pad"], drop=["pad"]).columns == ["x", "y"]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert rows(dedupe.duplicates(df)) == [(1, None, 2)]
    assert dedupe.drop_duplicates(df, ["a"]).count() == 2
    assert dedupe.drop_duplicates(df).count() == 2
    assert rows(dedupe.distinct_rows(df, ["b"])) == [("a",), (None,)]
