"""Audit log of published runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.reshape import explode_map, pivot_sum
from ..schemas import AUDIT, AUDIT_METRICS, HISTORY
from ..sinks.catalog import ensure_table, insert_by_name
from ..sinks.publish import read_history
from ..sources.files import read_table
from ..streaming.landing import read_quarantine
from ..streaming.progress import read_progress

AUDIT_KEYS = [name for name in HISTORY.names if name != "operationMetrics"]


def audit_rows(
    history: DataFrame, metrics: Sequence[str] = AUDIT_METRICS, keys: Sequence[str] = AUDIT_KEYS
) -> DataFrame:
    """History with one column per metric.

    Metric values are text of any size: what is not a whole number becomes
    NULL, and 64 bits hold byte counts.
    """
    entries = explode_map(history.select(*keys, "operationMetrics"), "operationMetrics", "metric", "amount")
    measure = F.sum(F.col("amount").try_cast("bigint"))
    return pivot_sum(entries, keys, "metric", metrics, measure)


def append_audit(spark: SparkSession, history: DataFrame, table: str) -> DataFrame:
    """Add the versions that the audit table lacks, and return the table."""
    ensure_table(spark, table, AUDIT)
    known = spark.table(table).select("version").distinct()
    insert_by_name(audit_rows(history.join(known, "version", "left_anti")), table)
    return spark.table(table)


def newest_first(audit: DataFrame) -> DataFrame:
    """The audit table as a view, last version first; sorted for reading, not for a write."""
    return audit.orderBy(F.desc("version"))


def audit_steps(
    spark: SparkSession,
    progress: str,
    logs: Mapping[str, str],
    landings: Mapping[str, tuple[str, str]],
    written: Mapping[str, str] | None = None,
) -> DataFrame:
    """``step``, ``rows_in``, ``rows_out`` and ``rejected`` over all runs of a chain.

    ``landings`` are the bronze and the quarantine of a step, counted from their footers. Other streams are known by
    their progress: a deduplication lets through the rows that changed its state. What others let through is counted from the
    footers of the table they have ``written``. ``logs`` are published tables, which have their own history.
    """
    steps = read_progress(spark, progress).where(~F.col("query_name").isin(*landings)).groupBy(
        F.col("query_name").alias("step")
    ).agg(F.sum("input_rows").alias("rows_in"), F.sum("updated_rows").alias("rows_out"), F.lit(None).cast("bigint").alias("rejected"))
    for step, path in (written or {}).items():
        # a row
        let_through = read_table(spark, path, T.StructType([])).agg(F.count("*").alias("let_through"))
        rows_out = F.when(F.col("step") == step, F.col("let_through")).otherwise(F.col("rows_out"))
        steps = steps.join(F.broadcast(let_through)).withColumn("rows_out", rows_out).drop("let_through")
    for step, (bronze, quarantine) in landings.items():
        good = read_table(spark, bronze, T.StructType([])).agg(F.count("*").alias("good"))
        bad = read_quarantine(spark, quarantine).agg(F.count("*").alias("rejected"))
        # a row each
        steps = steps.unionByName(
            good.join(F.broadcast(bad)).select(
                F.lit(step).alias("step"), (F.col("good") + F.col("rejected")).alias("rows_in"), F.col("good").alias("rows_out"), "rejected"
            )
        )
    for step, path in logs.items():
        metric = F.col("operationMetrics")
        written = read_history(spark, path).agg(
            F.lit(None).cast("bigint").alias("rows_in"),
            F.sum(metric["numOutputRows"].cast("bigint")).alias("rows_out"),
            F.sum(metric["numRejectedRows"].cast("bigint")).alias("rejected"),
        )
        steps = steps.unionByName(written.select(F.lit(step).alias("step"), "*"))
    return steps
