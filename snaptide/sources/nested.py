"""Nested JSON files and raw API payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import named
from .files import REJECTED, with_rejects


def _json_options(multi_line: bool, keep_rejects: bool) -> dict[str, str]:
    options = {"multiLine": str(multi_line).lower()}
    return options | {"columnNameOfCorruptRecord": REJECTED} if keep_rejects else options


def read_nested_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, keep_rejects: bool = False
) -> DataFrame:
    """JSON with a declared nested schema.

    Collected files are indented arrays over many lines, which need
    ``multi_line``; such a file is one task. Files with one object per line
    (``multi_line=False``) are split. With ``keep_rejects`` the text of a record that does not parse is
    kept in ``_rejected``; without, it is a row of NULLs.
    """
    reader = spark.read.schema(with_rejects(schema, keep_rejects))
    return reader.options(**_json_options(multi_line, keep_rejects)).json(path)


def stream_nested_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = True,
    max_files: int | None = 2,
    keep_rejects: bool = False,
) -> DataFrame:
    reader = spark.readStream.schema(with_rejects(schema, keep_rejects))
    reader = reader.options(**_json_options(multi_line, keep_rejects))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def payload_rejects(payloads: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Payloads that ``explode_payload`` gets nothing from, with the ``reason``; an empty response is none of them."""
    empty = F.col(column).isNull() | (F.trim(F.col(column)) == "")
    lost = F.from_json(F.col(column), schema)["response"].isNull()
    parsed = F.get_json_object(column, "$").isNotNull()
    reason = F.when(empty, "no payload").when(~parsed, "unreadable").when(lost, "no response")
    return payloads.withColumn("reason", reason).where(F.col("reason").isNotNull())


def explode_payload(payloads: DataFrame, column: str, schema: T.StructType, number: str = "statistics_no") -> DataFrame:
    """Players of raw payloads: profile columns beside one statistics struct, ``"0"``, and which one it is.

    One row per statistics entry of each element of ``response``: a player with two clubs has two. One without any has a
    row without statistics. Profile and statistics are taken from the same element, so nothing is matched by position.
    """
    others = [named(c) for c in payloads.columns if c != column]
    items = payloads.select(
        *others, F.explode(F.from_json(F.col(column), schema)["response"]).alias("__item")
    )
    entries = items.select(*others, "__item", F.posexplode_outer("__item.statistics").alias(number, "__entry"))
    return entries.select(*others, F.col("__item.player.*"), F.col("__entry").alias("0"), number)


def normalise_payload(
    payloads: DataFrame, column: str, schema: T.StructType, path: str
) -> DataFrame:
    """Struct at ``path`` of a JSON payload, kept beside the other columns for ``flatten``."""
    others = [named(c) for c in payloads.columns if c != column]
    parsed = payloads.select(*others, F.from_json(F.col(column), schema).alias("__payload"))
    return parsed.select(*[named(c) for c in payloads.columns if c != column], F.col(f"__payload.{path}.*"))
