import datetime as dt
import os

import snapshots
from conftest import rows
from pyspark.sql import functions as F, types as T

from snaptide.schemas import STANDINGS_DATE_FORMAT, STANDINGS_RAW
from snaptide.sources.headers import by_header, file_headers, read_lines

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("day", T.DateType())])


def write(area, name, text):
    os.makedirs(f"{area}/in", exist_ok=True)
    with open(f"{area}/in/{name}.csv", "w", encoding="utf-8") as file:
        file.write(text)


def read(spark, area, schema=SCHEMA, date_format="yyyy-MM-dd"):
    return by_header(read_lines(spark, f"{area}/in"), schema, date_format)


def test_three_header_orders_and_what_fits_none(spark, area):
    write(area, "1", "a,b,day\n1,x,2023-01-02\n")
    write(area, "2", '\ufeff"day", b,a\n2023-01-03,"y, z",2\n\n')
    write(area, "3", "\nb,day,a\n,2023-01-04,3\nw,,\n")
    write(area, "4", "a,b,date\n4,x,2023-01-02\n5,x,2023-01-02\n")
    write(area, "5", "a,b\n6,x\n")
    write(area, "6", "")
    write(area, "7", "a,b,day")
    day = [dt.date(2023, 1, n) for n in (2, 3, 4)]
    found = read(spark, area)
    assert rows(found.where("reason IS NULL").select("a", "b", "day", "source_file")) == sorted(
        [(1, "x", day[0], "1.csv"), (2, "y, z", day[1], "2.csv"), (3, None, day[2], "3.csv"), (None, "w", None, "3.csv")], key=repr
    )
    assert rows(found.where("reason IS NOT NULL").select("source_file", "_rejected", "reason", "a")) == [
        ("4.csv", "4,x,2023-01-02", "header: unknown date; missing day", None),
        ("4.csv", "5,x,2023-01-02", "header: unknown date; missing day", None),
        ("5.csv", "6,x", "header: missing day", None),
    ]


def test_single_lines_that_do_not_parse(spark, area):
    write(area, "1", "a,b,day\n1,x,2023-01-02\nno,x,2023-01-02\n1,x,02.01.2023\n1,x\n1,x,2023-01-02,more\n")
    found = read(spark, area)
    assert found.where("reason IS NULL").count() == 1
    assert [r[0] for r in rows(found.where("reason = 'line'").select("_rejected"))] == ["1,x", "1,x,02.01.2023", "1,x,2023-01-02,more", "no,x,2023-01-02"]


def test_repeated_names_only_in_their_order(spark, area):
    snapshots.write(f"{area}/in", "1.csv", snapshots.FIRST)
    # points where the matches played should be: the names repeat, so no order can be told
    swapped = [[*r[:2], r[14], *r[3:14], r[2], r[15]] for r in snapshots.SECOND]
    snapshots.write(f"{area}/in", "2.csv", swapped, "Pos,Team,Pts,W,D,L,GF,GA,W,D,L,GF,GA,GD,P,match_date")
    named = ",".join(STANDINGS_RAW.names)
    snapshots.write(f"{area}/in", "3.csv", [r[::-1] for r in snapshots.FIRST], ",".join(named.split(",")[::-1]))
    found = read(spark, area, STANDINGS_RAW, STANDINGS_DATE_FORMAT)
    good = found.where("reason IS NULL")
    assert rows(good.groupBy("source_file").count()) == [("1.csv", 3), ("3.csv", 3)]
    assert good.drop("source_file").distinct().count() == 3
    assert rows(good.where("Team = 'Easton'").select("Pos", "`L.1`", "Pts").distinct()) == [(3, 2, 0)]
    assert rows(found.where("reason IS NOT NULL").select("reason").distinct()) == [("header: repeated names in another order",)]


def test_a_header_is_found_in_each_file_of_many_parts(spark, area):
    for name in "ab":
        write(area, name, "b,a,day\n" + "".join(f"{name},{i},2023-01-02\n" for i in range(3000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        lines = read_lines(spark, f"{area}/in")
        assert lines.rdd.getNumPartitions() > 10
        found = by_header(lines, SCHEMA, "yyyy-MM-dd")
        assert rows(found.groupBy("b").agg(F.count("*"), F.sum("a"), F.count("reason"))) == [("a", 3000, 4498500, 0), ("b", 3000, 4498500, 0)]
        heads = file_headers(lines.withColumn("position", F.monotonically_increasing_id()), SCHEMA)
        assert rows(heads.select("header")) == [("b,a,day",)] * 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
