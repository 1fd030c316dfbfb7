"""Raw files to conformed table to reports: bronze, silver, gold."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.keys import KEY_SUFFIX, entity_key
from ..operators.quality import Rule, no_rejects, run_suite
from ..operators.reshape import add_totals, rename_columns, select_columns
from ..schemas import (
    SILVER_COLUMNS,
    STANDINGS_DATE_FORMAT,
    STANDINGS_RAW,
    STANDINGS_RENAMES,
    STANDINGS_TOTALS,
)
from ..scratch import materialize
from ..session import stateful_session
from ..sinks.catalog import ensure_database, save_table
from ..sinks.publish import next_run, publish, read_run
from ..sources.files import REJECTED, read_table, stream_table
from ..sources.headers import REASON, by_header, stream_lines
from ..streaming.ingest import append_stream, dedupe_stream
from ..streaming.landing import Landed, land, read_quarantine, with_batch
from ..streaming.upsert import read_state, upsert_stream
from .audit import audit_steps
from .gold import latest_table, leaderboard


@dataclass(frozen=True)
class Zones:
    """Where a refinement reads and writes."""

    landing: str
    root: str
    date_format: str = STANDINGS_DATE_FORMAT
    key_suffix: str = KEY_SUFFIX
    max_files: int | None = None
    state_partitions: int | None = None
    # (time column, delay) bounds the state of silver; without it every row is remembered
    watermark: tuple[str, str] | None = None
    # drop copies within an Arrow batch first: for input in which one row has very many copies
    collapse: bool = False
    # managed tables of the reports are kept here, too
    database: str | None = None

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    @property
    def current(self) -> str:
        return f"{self.root}/current"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def bronze_columns(raw: DataFrame, suffix: str = KEY_SUFFIX) -> DataFrame:
    """Readable names at once (``W.1`` would be read as a field) and the entity key."""
    renamed = raw.transform(rename_columns, STANDINGS_RENAMES)
    return renamed.withColumn("entity_id", entity_key("team", suffix))


def silver_columns(bronze: DataFrame) -> DataFrame:
    """Home and away added up, in the columns of the conformed table."""
    return bronze.transform(add_totals, STANDINGS_TOTALS).transform(select_columns, SILVER_COLUMNS)


def landed(lines: DataFrame, zones: Zones) -> DataFrame:
    """Lines of snapshot files as rows of bronze, matched by the header of each file; rejects keep their text and reason."""
    return bronze_columns(by_header(lines, STANDINGS_RAW, zones.date_format), zones.key_suffix)


def to_bronze(spark: SparkSession, zones: Zones) -> Landed:
    """New snapshot files, typed and keyed, into bronze; what cannot be read goes to the quarantine."""
    return land(
        stream_lines(spark, zones.landing, zones.max_files),
        lambda lines: landed(lines, zones),
        zones.bronze,
        zones.quarantine,
        zones.checkpoint("bronze"),
        "bronze_ingest",
        log=zones.progress,
    )


def bronze_schema(spark: SparkSession, zones: Zones) -> StructType:
    """Columns of bronze, which are known before there is any file."""
    lines = spark.createDataFrame([], "value string, file string, start long")
    return with_batch(landed(lines, zones).drop(REJECTED, REASON).schema)


def read_bronze(spark: SparkSession, zones: Zones) -> DataFrame:
    return read_table(spark, zones.bronze, bronze_schema(spark, zones))


def read_silver(spark: SparkSession, zones: Zones) -> DataFrame:
    return read_table(spark, zones.silver, silver_columns(read_bronze(spark, zones)).schema)


def _bronze_stream(spark: SparkSession, zones: Zones) -> DataFrame:
    return stream_table(spark, zones.bronze, bronze_schema(spark, zones), zones.max_files)


def to_silver(spark: SparkSession, zones: Zones):
    """New bronze rows, conformed and deduplicated, appended to silver."""
    session = stateful_session(spark, zones.state_partitions)
    rows = dedupe_stream(
        silver_columns(_bronze_stream(session, zones)), SILVER_COLUMNS, zones.watermark, zones.collapse
    )
    return append_stream(rows, zones.silver, zones.checkpoint("silver"), "silver_dedupe", log=zones.progress)


def to_current(spark: SparkSession, zones: Zones):
    """New bronze rows upserted into the current state of each team."""
    return upsert_stream(
        silver_columns(_bronze_stream(spark, zones)),
        zones.current,
        zones.checkpoint("current"),
        "silver_upsert",
        keys=["entity_id"],
        sequence_by="snapshot_date",
        log=zones.progress,
    )


def read_current(spark: SparkSession, zones: Zones) -> DataFrame:
    schema = silver_columns(read_bronze(spark, zones)).schema
    return read_state(spark, zones.current, ["entity_id"], "snapshot_date", schema=schema)


def gold_candidate(spark: SparkSession, zones: Zones, ties: str = "break") -> DataFrame:
    """The league table from silver, written where no reader looks, to be judged before it is published."""
    return materialize(latest_table(read_silver(spark, zones), ties), "candidate")


def publish_gold(
    spark: SparkSession, zones: Zones, table: DataFrame, run_id: int | None = None
) -> dict[str, DataFrame]:
    """Publish a league table as a run, and as a managed table if the zones have a database; its views.

    Nothing is sorted before it is written, since no reader gets that order; the views sort. A
    reader sees the former run until the new one is complete.
    """
    path = zones.gold("league_table")
    publish(table, path, next_run(spark, path) if run_id is None else run_id, writer=uuid.uuid4().hex)
    table = read_run(spark, path)
    if zones.database is not None:
        ensure_database(spark, zones.database)
        save_table(table, f"{zones.database}.league_table")
    return {
        "league_table": table,
        "most_wins": leaderboard(table, "wins"),
        "most_goals": leaderboard(table, "goals_for"),
    }


def to_gold(spark: SparkSession, zones: Zones, ties: str = "break", run_id: int | None = None) -> dict[str, DataFrame]:
    """The league table from silver, published as a run, and its views."""
    return publish_gold(spark, zones, gold_candidate(spark, zones, ties), run_id)


class QualityFailure(RuntimeError):
    """A rule of the suite failed, and nothing was published; ``report`` holds all rules."""

    def __init__(self, report: DataFrame, failed: list):
        super().__init__("; ".join(f"{r.check_name} {r.column_name}: {r.observed}, not {r.expected}" for r in failed))
        self.report, self.failed = report, failed


def judged(report: DataFrame, gate: bool) -> DataFrame:
    """The quality report; with ``gate`` a failed rule raises ``QualityFailure``."""
    # a row per rule
    report = materialize(report, "quality")
    failed = failed_checks(report).collect()
    if gate and failed:
        raise QualityFailure(report, failed)
    return report


def rejects_report(spark: SparkSession, quarantine: str, run: Landed) -> DataFrame:
    """The rule that this run has put nothing into the quarantine."""
    return run_suite(read_quarantine(spark, quarantine, run.batches), [no_rejects(REJECTED)])


def refine(
    spark: SparkSession, zones: Zones, rules: list[Rule], ties: str = "break", gate: bool = True
) -> tuple[dict[str, DataFrame], DataFrame]:
    """One run through all zones: reports and quality report. Any failure stops the run.

    Lines that cannot be read go to the quarantine and no further. The quality report holds the rules on the
    new league table and the number of lines this run has put into the quarantine. It is made before anything is
    published: with ``gate`` a failed rule raises ``QualityFailure`` and readers keep the former run. The good rows
    of that run stay in silver, so the next run publishes them. Every step leaves its rows in the audit (``read_audit``).
    """
    bronze = to_bronze(spark, zones)
    to_silver(spark, zones)
    to_current(spark, zones)
    candidate = gold_candidate(spark, zones, ties)
    report = judged(run_suite(candidate, rules).unionAll(rejects_report(spark, zones.quarantine, bronze)), gate)
    return publish_gold(spark, zones, candidate), report


def read_audit(spark: SparkSession, zones: Zones) -> DataFrame:
    """Rows taken, written and rejected by each step of all runs: bronze, silver, current and gold."""
    logs = {"current": zones.current, "gold": zones.gold("league_table")}
    return audit_steps(spark, zones.progress, logs, {"bronze_ingest": (zones.bronze, zones.quarantine)})


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))
