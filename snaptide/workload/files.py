"""Files, versioned runs and catalog tables, written from the driver's tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import named
from ..operators.quality import column_exists, row_count, run_suite, table_exists
from ..plans.audit import append_audit, newest_first
from ..plans.cleaning import clean_snapshots
from ..schemas import RAW_FILE_COLUMNS, STANDINGS_DATE_FORMAT, STANDINGS_RAW
from ..scratch import persisted, work_area
from ..sinks import catalog, publish as sink
from ..sources.files import read_raw, read_snapshots, with_source_file
from ..sources.headers import by_header, read_lines
from ..sources.tables import table_cells, table_grid
from .derived import STANDINGS_SQL, standings_snapshots
from .registry import query, table


def _database(spark: SparkSession) -> str:
    name = f"snaptide_{uuid.uuid4().hex[:12]}"
    catalog.ensure_database(spark, name, work_area(spark, "db"))
    return name


@query("SELECT DISTINCT c_custkey, c_name, c_nationkey FROM customer")
def catalog_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed table created, filled by name, saved again and read from the catalog."""
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name")
    db = _database(spark)
    schema = customers.select("c_custkey", "c_name", "c_nationkey").schema
    catalog.ensure_table(spark, f"{db}.customers", schema)
    catalog.insert_by_name(customers, f"{db}.customers")
    catalog.save_table(spark.table(f"{db}.customers"), f"{db}.saved")
    return spark.table(f"{db}.saved")


@query("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def ctas_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _database(spark)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    catalog.save_table(orders, f"{db}.orders")
    catalog.create_distinct_table(spark, f"{db}.orders_distinct", f"{db}.orders")
    return spark.table(f"{db}.orders_distinct")


@query(
    """SELECT 'table_exists' AS check_name, 1::BIGINT AS observed UNION ALL SELECT 'column_exists', 1
UNION ALL SELECT 'row_count', count(*) FROM supplier"""
)
def existence_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a saved table and a column of it are there, and its row count."""
    db = _database(spark)
    catalog.save_table(table(spark, sf_dir, "supplier"), f"{db}.suppliers")
    saved = spark.table(f"{db}.suppliers")
    checks = table_exists(spark, f"{db}.suppliers").unionAll(column_exists(saved, "s_name"))
    return checks.unionAll(run_suite(saved, [row_count()])).select("check_name", "observed")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with header and JSON records, read back and joined on the key."""
    customers = table(spark, sf_dir, "customer")
    area = work_area(spark, "export")
    sink.export_csv(customers.select("c_custkey", "c_name", "c_nationkey"), f"{area}/csv")
    sink.export_json(customers.select("c_custkey", "c_acctbal", "c_mktsegment"), f"{area}/json")
    names = read_snapshots(spark, f"{area}/csv", customers.select("c_custkey", "c_name", "c_nationkey").schema, "yyyy-MM-dd")
    amounts = spark.read.schema(customers.select("c_custkey", "c_acctbal", "c_mktsegment").schema).json(f"{area}/json")
    return names.join(amounts, "c_custkey")


@query(
    """SELECT o_orderkey, o_custkey, NULL::VARCHAR AS o_orderpriority FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-07-01'
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'"""
)
def append_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries appended to one table; the later one has a column more."""
    orders = table(spark, sf_dir, "orders")
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    path = f"{work_area(spark, 'append')}/orders"
    sink.append_files(orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey"), path)
    later = orders.where(F.col("o_orderdate") >= cut)
    sink.append_files(later.select("o_orderkey", "o_custkey", "o_orderpriority"), path)
    return sink.read_merged(spark, path)


@query("SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer")
def publish_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one table; the last one is read. The second run is published twice."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    path = work_area(spark, "publish")
    sink.publish(customers, path, 1)
    raised = customers.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    sink.publish(raised, path, 2)
    sink.publish(raised, path, 2)
    return sink.read_run(spark, path)


@query(
    """SELECT 'WRITE' AS operation, 1::BIGINT AS version, 'etl' AS "userId", count(*) AS "numOutputRows", true AS has_bytes
  FROM orders
UNION ALL SELECT 'APPEND', 2, 'etl', count(*), true FROM customer"""
)
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of two published runs in an audit table; the second call adds only what is new."""
    path = work_area(spark, "audited")
    name = f"{_database(spark)}.audit_log"
    sink.publish(table(spark, sf_dir, "orders").select("o_orderkey"), path, 1, user_id="etl")
    append_audit(spark, sink.read_history(spark, path), name)
    sink.publish(table(spark, sf_dir, "customer").select("c_custkey"), path, 2, "APPEND", user_id="etl")
    audit = append_audit(spark, sink.read_history(spark, path), name)
    return audit.select(
        "operation", "version", "userId", "numOutputRows", (F.col("numOutputBytes") > 0).alias("has_bytes")
    )


@query(
    """SELECT 'WRITE' AS operation, 2::BIGINT AS version, count(*) AS "numOutputRows" FROM customer
UNION ALL SELECT 'WRITE', 1, count(*) FROM orders"""
)
def versions_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table as a view by version."""
    path = work_area(spark, "audited")
    name = f"{_database(spark)}.audit_log"
    for run, source in enumerate(("orders", "customer"), 1):
        sink.publish(table(spark, sf_dir, source), path, run)
    audit = append_audit(spark, sink.read_history(spark, path), name)
    return newest_first(audit.select("operation", "version", "numOutputRows"))


@query("SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey")
def temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table under a name of this session, asked in SQL."""
    name = f"customers_{uuid.uuid4().hex[:12]}"
    catalog.register_view(table(spark, sf_dir, "customer"), name)
    return spark.sql(f"SELECT c_nationkey, count(*) AS customers FROM {name} GROUP BY c_nationkey")


@query("SELECT s_suppkey, s_name FROM supplier")
def catalog_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table saved, dropped by a reset, and made again from nothing."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    name = f"{_database(spark)}.suppliers"
    catalog.save_table(suppliers.unionByName(suppliers), name)
    catalog.reset(spark, [name], confirm=True)
    if spark.catalog.tableExists(name):
        raise RuntimeError(f"{name} is still there")
    catalog.save_table(suppliers, name)
    return spark.table(name)


@query(
    """SELECT l_returnflag AS value, count(*) AS rows FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT l_linestatus, count(*) FROM lineitem GROUP BY l_linestatus"""
)
def persisted_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs written from one cached input."""
    path = f"{work_area(spark, 'outputs')}/counts"
    with persisted(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")) as lines:
        for column in ("l_returnflag", "l_linestatus"):
            sink.append_files(lines.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows")), path)
    return spark.read.parquet(path)


_RAW_SQL = f"""{STANDINGS_SQL} SELECT ranking AS "Pos", team AS "Team", matches_played AS "P", wh AS "W",
  dh AS "D", lh AS "L", gfh AS "GF", gah AS "GA", wa AS "W.1", da AS "D.1",
  la AS "L.1", gfa AS "GF.1", gaa AS "GA.1", goal_difference AS "GD", points AS "Pts",
  snapshot_date AS match_date FROM standings"""


def write_raw_snapshots(spark: SparkSession, sf_dir: str, path: str, gaps: bool = False) -> None:
    """Standings snapshots as CSV with ``yyyy-MMM-dd`` dates, with blank separator columns if ``gaps``."""
    rows = standings_snapshots(spark, sf_dir).withColumn(
        "match_date", F.date_format("match_date", STANDINGS_DATE_FORMAT)
    )
    columns = []
    for name in rows.columns:
        if gaps and name in ("W", "W.1", "GD"):
            columns.append(F.lit(" ").alias(f"gap before {name}"))
        columns.append(named(name))
    rows.select(*columns).write.option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).mode("overwrite").option("header", True).csv(path)


@query(_RAW_SQL)
def csv_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated CSV snapshots read with their declared schema and date format."""
    path = f"{work_area(spark, 'csv')}/snapshots"
    write_raw_snapshots(spark, sf_dir, path)
    return read_snapshots(spark, path, STANDINGS_RAW, STANDINGS_DATE_FORMAT)


_NESTED_SQL = """WITH kinds AS (SELECT o_custkey, o_orderstatus AS status, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS k FROM orders GROUP BY o_custkey, o_orderstatus)
SELECT c_custkey, 0 AS table_no, NULL::INT AS parent_no, 1 AS depth, 0 AS row_no, c_name || '|' || c_name AS cells
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL SELECT o_custkey, 0, NULL, 1, (2 * k - 1)::INT, status || '|' || n FROM kinds
UNION ALL SELECT o_custkey, 0, NULL, 1, (2 * k)::INT, status || '|keys & more' FROM kinds
UNION ALL SELECT o_custkey, k::INT, 0, 2, 0, low || '|' || high FROM kinds"""


@query(_NESTED_SQL)
def html_nested_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per customer: a table of the orders by status with spanning cells, in them tables of the first and last order."""
    kinds = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
    )
    row = F.format_string(
        '<tr><td rowspan="2">%s<td><!-- <td> -->%d</tr><tr><td>keys <table class=in><tr><th>%d</th><th>%d</th></tr></table> &amp; more</tr>',
        "o_orderstatus", "n", "low", "high",
    )
    rows = kinds.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderstatus", row.alias("row")))).alias("rows"))
    customers = table(spark, sf_dir, "customer").join(rows, F.col("c_custkey") == F.col("o_custkey"))
    body = F.array_join(F.transform("rows", lambda r: r["row"]), "\n")
    html = F.concat(F.lit('<h1>x</h1><TABLE class="out"><tr><th colspan=2>'), "c_name", F.lit("</th></tr>"), body, F.lit("</TABLE>"))
    grid = table_grid(table_cells(customers.select("c_custkey", html.alias("html")), ["c_custkey"]), ["c_custkey"])
    return grid.withColumn("cells", F.array_join("cells", "|", "-"))


_TURNED = ("day", "o_custkey", "o_totalprice", "o_orderkey")


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE AS day, NULL::VARCHAR AS reason FROM orders
  WHERE o_orderstatus <> 'P'
UNION ALL SELECT NULL, NULL, NULL, NULL, 'header: unknown price; missing o_totalprice' FROM orders WHERE o_orderstatus = 'P'"""
)
def csv_header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files of three headers: that of the schema, another order of it, and one with a name it does not have."""
    day = F.date_format("o_orderdate", "dd.MM.yyyy").alias("day")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", day, "o_orderstatus")
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
         T.StructField("o_totalprice", T.DoubleType()), T.StructField("day", T.DateType())]
    )
    area = work_area(spark, "drift")

    def deliver(status: str, columns: list) -> None:
        rows = orders.where(F.col("o_orderstatus") == status).select(*columns)
        rows.write.mode("append").option("header", True).csv(f"{area}/landing")

    deliver("F", schema.names)
    deliver("O", list(_TURNED))
    deliver("P", ["o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), "day"])
    return by_header(read_lines(spark, f"{area}/landing"), schema, "dd.MM.yyyy").select(*schema.names, "reason")


@query(_RAW_SQL)
def snapshot_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with blank separator columns cleaned, named by position and typed."""
    path = f"{work_area(spark, 'raw')}/snapshots"
    write_raw_snapshots(spark, sf_dir, path, gaps=True)
    return clean_snapshots(spark, path, RAW_FILE_COLUMNS, STANDINGS_RAW, STANDINGS_DATE_FORMAT)


@query("SELECT s_suppkey::VARCHAR AS c0, s_name AS c1, true AS has_file FROM supplier")
def copy_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of CSV files copied as text columns, the file of each row kept."""
    area = work_area(spark, "copy")
    sink.export_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), f"{area}/from")
    copied = with_source_file(read_raw(spark, f"{area}/from", 2))
    sink.export_csv(copied, f"{area}/to")
    rows = read_raw(spark, f"{area}/to", 3)
    return rows.select("c0", "c1", F.col("c2").endswith(".csv").alias("has_file"))
