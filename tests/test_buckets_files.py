import glob
import os

from conftest import rows
from pyspark.sql import functions as F

from snaptide.operators.upsert import upsert
from snaptide.sinks.catalog import save_bucketed
from snaptide.sinks.publish import append_files, publish, read_run


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def database(spark, area):
    name = "buckets_" + os.path.basename(area).replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{area}/db'")
    return name


def test_a_bucketed_target_is_not_shuffled(spark, area):
    target = spark.range(5000).select("id", F.lit("old").alias("v"))
    batch = spark.range(2500, 7500).select("id", F.lit("new").alias("v"))
    name = f"{database(spark, area)}.t"
    save_bucketed(target, name, ["id"])
    batch.write.parquet(f"{area}/batch")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        merged = upsert(spark.table(name), spark.read.parquet(f"{area}/batch"), ["id"])
        text = plan(merged)
        # below every shuffle lies a scan of the batch
        lines = text.split("\n")
        shuffles = [i for i, line in enumerate(lines) if "Exchange" in line and "ReusedExchange" not in line]
        below = [next(line for line in lines[i:] if "FileScan" in line) for i in shuffles]
        assert below and not any("spark_catalog" in line for line in below), text
        save_bucketed(merged.drop("update_flag"), name, ["id"])
        again = plan(upsert(spark.table(name), spark.read.parquet(f"{area}/batch"), ["id"]))
        assert "Bucketed: true" in again
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows(spark.table(name).groupBy("v").count()) == [("new", 5000), ("old", 2500)]
    files = glob.glob(f"{area}/db/**/*.parquet", recursive=True)
    assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def sizes(path):
    return [os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]


def test_many_small_parts_become_one_file(spark, area):
    df = spark.range(1000).repartition(60)
    publish(df, f"{area}/run", 1)
    append_files(df, f"{area}/appended")
    assert len(sizes(f"{area}/run/data")) == 1 and len(sizes(f"{area}/appended")) == 1
    assert rows(read_run(spark, f"{area}/run")) == rows(df) == rows(spark.read.parquet(f"{area}/appended"))


def test_one_large_part_becomes_even_files(spark, area):
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        append_files(df, f"{area}/out")
    finally:
        spark.conf.set(size, before)
    found = sizes(f"{area}/out")
    assert len(found) > 3 and max(found) < 3 * (sum(found) / len(found))
    assert spark.read.parquet(f"{area}/out").count() == 200_000
