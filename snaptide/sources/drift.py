"""Payloads whose shape drifts: read as VARIANT, compared with the declared schema source by source."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import named
from ..schemas import PLAYER_PROFILE, PLAYER_STATISTICS, SPELLINGS

_SHAPE = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "drift", "declared", "found")])


def payload_shapes(payloads: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """One row per source: the ``shape`` of all its payloads together (NULL if none can be read) and how many are ``unreadable``.

    The shape is merged in the tasks that read the payloads, so a source of any size sends one row per task.
    """
    value = F.try_parse_json(named(column))
    lost = named(column).isNotNull() & value.isNull()
    shape = F.schema_of_variant_agg(value)
    return payloads.groupBy(*map(named, by)).agg(
        F.when(shape != "VOID", shape).alias("shape"), F.count(F.when(lost, 1)).alias("unreadable")
    )


def _data_type(shape: str) -> T.DataType:
    """The type a shape describes; objects are structs, names in back quotes are left alone."""
    text = re.sub(r"`[^`]*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], shape)
    return T.DataType.fromDDL(text)


def _leaves(kind: T.DataType, path: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Paths of what holds a value; ``[]`` stands for the elements of a list."""
    if isinstance(kind, T.ArrayType):
        yield from _leaves(kind.elementType, f"{path}[]")
    elif isinstance(kind, T.StructType):
        for f in kind:
            yield from _leaves(f.dataType, f"{path}.{f.name}" if path else f.name)
    else:
        yield path, kind


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    return "text" if isinstance(kind, (T.StringType, T.DateType, T.TimestampType)) else kind.simpleString()


def shape_drift(shape: str, declared: T.DataType) -> list[tuple[str, str, str | None, str | None]]:
    """How a shape differs: paths that are ``unknown`` to the schema, ``vanished`` from the payloads, or ``retyped``.

    A value that is null in all payloads is there if the schema has it; where a whole object is null, its
    paths have vanished.
    """
    want, found = dict(_leaves(declared)), dict(_leaves(_data_type(shape)))
    out = []
    for path, kind in found.items():
        empty = isinstance(kind, T.NullType)
        if path not in want:
            if not (empty and any(p.startswith((f"{path}.", f"{path}[]")) for p in want)):
                out.append((path, "unknown", None, kind.simpleString()))
        elif not empty and _family(kind) != _family(want[path]):
            out.append((path, "retyped", want[path].simpleString(), kind.simpleString()))
    out += [(path, "vanished", kind.simpleString(), None) for path, kind in want.items() if path not in found]
    return out


def payload_drift(payloads: DataFrame, column: str, declared: T.DataType, by: Sequence[str]) -> DataFrame:
    """``path``, ``drift`` (unknown, vanished, retyped), ``declared`` and ``found`` type of every difference of each source.

    The driver gets the different shapes, not the payloads or the sources. A source without a readable payload has no row.
    """
    spark = payloads.sparkSession
    shapes = payload_shapes(payloads, column, by)
    # a row per different shape
    different = [r[0] for r in shapes.select("shape").where("shape is not null").distinct().collect()]
    rows = [(shape, *row) for shape in different for row in shape_drift(shape, declared)]
    drift = spark.createDataFrame(rows, T.StructType([T.StructField("shape", T.StringType()), *_SHAPE]))
    return shapes.join(drift, "shape").select(*map(named, by), *_SHAPE.names)


def _path(names: Sequence[str]) -> str:
    return "$" + "".join(f'["{name}"]' for name in names)


def variant_struct(value: Column, schema: T.StructType, spellings: Mapping[str, Sequence[str]] | None = None) -> Column:
    """The fields of a VARIANT as a struct; a field that is missing or of another type is NULL and spoils no other.

    ``spellings`` maps the dotted path of a field to other paths it may be at.
    """
    spellings = spellings or {}

    def field(f: T.StructField, above: tuple[str, ...]) -> Column:
        here = (*above, f.name)
        if isinstance(f.dataType, T.StructType):
            whole = F.try_variant_get(value, _path(here), "variant")
            there = whole.isNotNull() & ~F.is_variant_null(whole)
            return F.when(there, F.struct(*[field(inner, here).alias(inner.name) for inner in f.dataType]))
        places = [here, *(tuple(p.split(".")) for p in spellings.get(".".join(here), ()))]
        return F.coalesce(*[F.try_variant_get(value, _path(p), f.dataType.simpleString()) for p in places])

    return F.struct(*[field(f, ()).alias(f.name) for f in schema])


def variant_players(
    payloads: DataFrame, column: str, spellings: Mapping[str, Sequence[str]] = SPELLINGS, number: str = "statistics_no"
) -> DataFrame:
    """Players of raw payloads, as ``explode_payload`` gives them, whatever else the payloads hold.

    One row per statistics entry, all of them; names are read in either spelling, and a field of a wrong type is NULL
    where a declared schema would lose the whole record.
    """
    others = [named(c) for c in payloads.columns if c != column]
    parsed = payloads.select(*others, F.try_parse_json(named(column)).alias("__payload"))
    items = parsed.select(*others, F.explode(F.try_variant_get("__payload", "$.response", "array<variant>")).alias("__item"))
    statistics = F.try_variant_get("__item", "$.statistics", "array<variant>")
    player = F.try_variant_get("__item", "$.player", "variant")
    entries = items.select(*others, player.alias("__player"), F.posexplode_outer(statistics).alias(number, "__entry"))
    profile = variant_struct(F.col("__player"), PLAYER_PROFILE).alias("__profile")
    entry = F.when(F.col("__entry").isNotNull(), variant_struct(F.col("__entry"), PLAYER_STATISTICS, spellings)).alias("0")
    return entries.select(*others, profile, entry, number).select(*others, "__profile.*", "`0`", number)
