"""Bronze, silver and gold for any family of collected files: team summaries, player documents.

A chain names how its files are read, how a bronze row becomes a silver row, what a row is
about, and which reports are made; ``run_chain`` does the rest, as ``zones.refine`` does for standings.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.names import named
from ..operators.quality import Rule, run_suite
from ..operators.reshape import undot_columns
from ..schemas import PLAYERS
from ..scratch import materialize
from ..session import stateful_session
from ..sinks.catalog import ensure_database, save_table
from ..sinks.publish import next_run, publish, read_run
from ..sources.files import REJECTED, stream_table
from ..sources.headers import FILE, REASON, by_header, stream_lines
from ..sources.nested import stream_nested_json
from ..streaming.changes import changes_only
from ..streaming.ingest import append_stream, dedupe_stream
from ..streaming.landing import BATCH, land, with_batch
from ..streaming.upsert import read_state, upsert_stream
from . import gold
from .audit import audit_steps
from .zones import judged, rejects_report

# When the file of a document was written, and its name.
COLLECTED = "collected"

Report = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Chain:
    """``read`` gives the stream of the landing folder, ``bronze`` the rows of a micro-batch of it (see ``land``).

    ``conform`` makes silver rows of bronze ones; ``reports`` are made from the current state of each key, the row with the
    greatest ``sequence_by``. With ``changes`` silver holds only rows that differ from the one before
    them, else each different row once.
    """

    name: str
    root: str
    read: Callable[[SparkSession], DataFrame]
    bronze: Callable[[DataFrame], DataFrame]
    conform: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    reports: Mapping[str, Report]
    sequence_by: str
    rules: Sequence[Rule] = ()
    max_files: int | None = None
    changes: bool = False
    # managed tables of the reports are kept here, too
    database: str | None = None

    def path(self, zone: str) -> str:
        return f"{self.root}/{self.name}/{zone}"


def team_chain(
    landing: str, root: str, schema: StructType, keys: Sequence[str], date: str = "match_date", rules: Sequence[Rule] = ()
) -> Chain:
    """Season summaries as dated CSV files; the last one of each team, checked against its counters."""
    return Chain(
        "teams",
        root,
        lambda spark: stream_lines(spark, landing),
        lambda lines: undot_columns(by_header(lines, schema, "yyyy-MM-dd")),
        lambda bronze: bronze.drop(FILE, BATCH),
        keys,
        {"summary": lambda state: gold.team_summary(state, keys, date)},
        date,
        rules,
    )


def _documents(batch: DataFrame) -> DataFrame:
    """Documents with their file, when it was ``collected``, and what is wrong with those that are none."""
    # text of even width, so that it sorts by time
    collected = F.concat_ws(" ", F.date_format(F.col("__file.file_modification_time"), "yyyy-MM-dd HH:mm:ss.SSS"), "__file.file_name")
    return batch.select(
        *[named(c) for c in batch.columns if c not in ("__file", REJECTED)],
        collected.alias(COLLECTED),
        F.col("__file.file_name").alias(FILE),
        REJECTED,
        F.when(F.col(REJECTED).isNotNull(), F.lit("record")).alias(REASON),
    )


def player_chain(landing: str, root: str, k: int = 20, multi_line: bool = True, rules: Sequence[Rule] = ()) -> Chain:
    """Nested player documents; the scorers, contributions and assists of the last document of each player.

    Documents carry no date. The one in the later file counts, also if a counter in it is lower, since a count may be corrected.
    """

    def read(spark: SparkSession) -> DataFrame:
        documents = stream_nested_json(spark, landing, PLAYERS, multi_line, max_files=None, keep_rejects=True)
        return documents.select("*", F.struct("_metadata.file_name", "_metadata.file_modification_time").alias("__file"))

    return Chain(
        "players",
        root,
        read,
        _documents,
        lambda bronze: gold.player_facts(bronze, COLLECTED),
        ["id"],
        {
            "youngest_scorers": lambda facts: gold.youngest_scorers(facts.drop(COLLECTED), k),
            "top_contributions": lambda facts: gold.top_contributions(facts.drop(COLLECTED), k),
            "top_assists": lambda facts: gold.top_assists(facts.drop(COLLECTED), k),
        },
        COLLECTED,
        rules,
        changes=True,
    )


def run_chain(spark: SparkSession, chain: Chain, gate: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """New files through all zones: published reports and the quality report.

    What cannot be read goes to the quarantine. The rules are checked on the reports' state, and that this run has put
    nothing into the quarantine, before anything is published: with ``gate`` a failed rule raises and readers keep the former run.
    """
    log, raw = chain.path("progress"), chain.read(spark)
    bronze_path, quarantine = chain.path("bronze"), chain.path("quarantine")
    run = land(raw, chain.bronze, bronze_path, quarantine, chain.path("checkpoints/bronze"), f"{chain.name}_bronze", log=log)
    landed = chain.bronze(spark.createDataFrame([], raw.schema)).drop(REJECTED, REASON).schema

    session = stateful_session(spark)
    rows = chain.conform(stream_table(session, bronze_path, with_batch(landed), chain.max_files))
    if chain.changes:
        silver = changes_only(rows, chain.keys, chain.sequence_by)
    else:
        silver = dedupe_stream(rows, rows.columns)
    append_stream(silver, chain.path("silver"), chain.path("checkpoints/silver"), f"{chain.name}_silver", log=log)

    upsert_stream(
        stream_table(spark, chain.path("silver"), rows.schema, chain.max_files),
        chain.path("current"),
        chain.path("checkpoints/current"),
        f"{chain.name}_current",
        chain.keys,
        chain.sequence_by,
        log=log,
    )
    state = read_state(spark, chain.path("current"), chain.keys, chain.sequence_by, schema=rows.schema)
    # each report and the rules read it
    state = materialize(state.select(*map(named, rows.columns)), "state")
    checks = rejects_report(spark, quarantine, run)
    if chain.rules:
        checks = checks.unionAll(run_suite(state, list(chain.rules)))
    checks = judged(checks, gate)
    reports = {}
    for name, report in chain.reports.items():
        path = chain.path(f"gold/{name}")
        publish(report(state), path, next_run(spark, path), writer=uuid.uuid4().hex)
        reports[name] = read_run(spark, path)
        if chain.database is not None:
            ensure_database(spark, chain.database)
            save_table(reports[name], f"{chain.database}.{name}")
    return reports, checks


def chain_audit(spark: SparkSession, chain: Chain) -> DataFrame:
    """Rows taken, written and rejected by each step of all runs: bronze, silver, current and every report."""
    logs = {"current": chain.path("current"), **{name: chain.path(f"gold/{name}") for name in chain.reports}}
    landings = {f"{chain.name}_bronze": (chain.path("bronze"), chain.path("quarantine"))}
    written = {f"{chain.name}_silver": chain.path("silver")} if chain.changes else {}
    return audit_steps(spark, chain.path("progress"), logs, landings, written)
