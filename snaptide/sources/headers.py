"""CSV lines matched to a schema by the header of their own file.

A reader that skips headers binds by position, so a file whose columns have another order fills the
wrong ones without a word. Here the first line of every file is read as its header. Names that are unique
may come in any order; repeated names (home and away) only in the order of the schema. The lines of a
file whose header fits neither way are kept with the reason, as are single lines that do not parse.

Works on lines: a quoted field must not hold a line break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .files import REJECTED

FILE, REASON = "source_file", "reason"


def _located(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def read_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Lines of all files of a directory, with their ``file`` and the ``start`` of their part of it."""
    return _located(spark.read.option("pathGlobFilter", glob).text(path))


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None, glob: str = "*.csv") -> DataFrame:
    """The lines of new files as a stream; a micro-batch holds whole files."""
    reader = spark.readStream.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _located(reader.text(path))


def _fields(header: Column) -> Column:
    """Names of a header line, without quotes and a byte order mark."""
    plain = F.regexp_replace(header, "^\ufeff", "")
    return F.transform(F.split(plain, ",", -1), lambda name: F.trim(F.regexp_replace(F.trim(name), '^"|"$', "")))


def _numbered(names: Column) -> Column:
    """The second ``W`` becomes ``W.1``, as the schema names it."""

    def number(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, 1, i), lambda other: other == name))
        return F.when(before == 0, name).otherwise(F.concat(name, F.lit("."), before.cast("string")))

    return F.transform(names, number)


def file_headers(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per file: ``file``, where its ``header`` line is (``at``), the ``places`` of the schema's columns, or a ``reason``."""
    wanted = F.array(*[F.lit(n) for n in schema.names])
    filled = lines.where(F.trim("value") != "")
    first = filled.groupBy("file").agg(F.min(F.struct("start", "position", "value")).alias("at"))
    names = first.withColumn("names", _fields(F.col("at.value"))).withColumn("numbered", _numbered(F.col("names")))
    as_named = F.transform(wanted, lambda name: F.array_position("names", name).cast("int") - 1)
    unique = F.size(F.array_distinct("names")) == F.size("names")
    same = F.array_sort("names") == F.array_sort(wanted)
    unknown = F.array_except("numbered", wanted)
    missing = F.array_except(wanted, "numbered")
    listed = F.concat_ws(
        "; ",
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown "), F.array_join(unknown, ", "))),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))),
        F.when((F.size(unknown) == 0) & (F.size(missing) == 0), F.lit("repeated names in another order")),
    )
    in_order = F.col("numbered") == wanted
    places = F.when(in_order, F.array(*[F.lit(i) for i in range(len(schema))])).when(unique & same, as_named)
    return names.select(
        "file",
        F.struct("at.start", "at.position").alias("at"),
        F.col("at.value").alias("header"),
        places.alias("places"),
        F.when(places.isNull(), F.concat(F.lit("header: "), listed)).alias(REASON),
    )


def _typed(text: Column, kind: T.DataType, date_format: str) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(text, F.lit(date_format)).cast("date")
    return text.try_cast(kind)


def by_header(lines: DataFrame, schema: T.StructType, date_format: str) -> DataFrame:
    """Every line but the headers: the columns of ``schema``, ``source_file``, and for what cannot be read ``_rejected``, its text, and the ``reason``.

    Values of a rejected line are NULL. Blank lines and files without any line give no row.
    """
    placed = lines.withColumn("position", F.monotonically_increasing_id())
    heads = file_headers(placed, schema)
    rows = placed.where(F.trim("value") != "").join(heads, "file")
    rows = rows.where(F.struct("start", "position") != F.col("at"))
    slots = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))] + [T.StructField("bad", T.StringType())])
    parsed = F.from_csv("value", slots.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"columnNameOfCorruptRecord": "bad"})
    rows = rows.withColumn("parsed", parsed)
    rows = rows.withColumn("fields", F.array(*[F.col(f"parsed.c{i}") for i in range(len(schema))]))
    texts = [F.get("fields", F.get("places", F.lit(i))) for i in range(len(schema))]
    values = [_typed(t, f.dataType, date_format) for t, f in zip(texts, schema, strict=True)]
    unread = F.col("parsed.bad").isNotNull()
    for text, value in zip(texts, values, strict=True):
        unread = unread | (text.isNotNull() & value.isNull())
    rows = rows.withColumn(REASON, F.coalesce(F.col(REASON), F.when(unread, F.lit("line"))))
    good = F.col(REASON).isNull()
    name = F.element_at(F.split("file", "/"), -1)
    return rows.select(
        *[F.when(good, v).alias(f.name) for v, f in zip(values, schema, strict=True)],
        name.alias(FILE),
        F.when(~good, F.col("value")).alias(REJECTED),
        REASON,
    )
