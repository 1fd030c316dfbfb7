"""Near duplicates among embeddings by hashing to the E8 lattice.

In each of ``TABLES`` tables a vector of unit length is projected to twice eight dimensions
and both halves are decoded to their nearest points of the E8 lattice. The pair of points is
its cell. It also enters the neighbouring cells that it lies nearest to, so two
vectors on either side of a border still meet. Vectors with one label that share a cell are verified by
cosine in double precision.

At a cosine of 0.98 two vectors share a cell of one table with probability 0.855, and none of
nine with 3e-8; nearer vectors are missed less. That holds for vectors of any length: what eight dimensions of a
projection keep of a distance shrinks with the square root of the length, and so does the lattice; shorter vectors than
eight are turned in eight dimensions, where all of the distance stays.

Equal vectors are one point with a count. A cell that holds many different points is
compared in blocks, so no task gets a whole large cell, and links are counted where they
are found, not written out as pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialize
from .components import components
from .words import bounded, mix

COSINE = 0.98
TABLES = 9
# Distance that is one step of the lattice, for vectors of 64 components.
SCALE = 0.25
# Points of a cell that one task compares with as many others.
BLOCK = 1024
# Rows that travel to one task.
TASK_ROWS = 8192
_PROBES = 4

_MEMBER = "node long, many long, unit binary, cells binary"


def _decode_d8(y: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates and an even sum."""
    near = np.rint(y)
    left = y - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(left[odd]).argmax(axis=1)
    near[odd, worst] += np.where(left[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8: whole coordinates with an even sum, or all of them moved by a half."""
    whole = _decode_d8(y)
    half = _decode_d8(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def neighbour(y: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The lattice point met first when going on from ``point`` through ``y``."""
    way = y - point
    length = np.maximum(np.linalg.norm(way, axis=1, keepdims=True), 1e-12)
    return decode_e8(point + way / length)


def scale_of(size: int) -> float:
    """Size of the lattice for vectors of ``size`` components."""
    return SCALE * float(np.sqrt(64 / max(size, 8)))


def cells(units: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Keys of the cells of each vector, ``_PROBES`` for each table."""
    size = units.shape[1]
    scale = scale_of(size)
    out = np.empty((len(units), TABLES * _PROBES), np.uint64)
    for t in range(TABLES):
        random = np.random.RandomState(7000 + t)
        halves = []
        for half in range(2):
            # unit vectors at right angles; of a turn in eight dimensions a shorter vector needs the first ones
            basis = np.linalg.qr(random.randn(max(size, 8), 8))[0][:size]
            y = units @ basis / scale + random.rand(8)
            home = decode_e8(y)
            halves.append([_key(home, half), _key(neighbour(y, home), half)])
        for p, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
            key = mix(halves[0][i] * np.uint64(3) + halves[1][j] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t))
            out[:, t * _PROBES + p] = mix(key + labels.astype(np.int64).view(np.uint64) + np.uint64(size << 32))
    return out


def _key(points: np.ndarray, half: int) -> np.ndarray:
    whole = (2 * points).astype(np.int64).view(np.uint64)
    key = np.full(len(points), np.uint64(half))
    for k in range(8):
        key = mix(key * np.uint64(0x100000001B3) + whole[:, k])
    return key


def classes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """One row per row of ``vectors``: ``id``, ``n_links``, ``component`` and ``kept``.

    Two vectors link if their labels are equal and not null, their lengths are equal and their cosine is at
    least ``COSINE``. Vectors that are null, empty or zero, or hold a null, infinite or undefined component, link with
    nothing. Rows that repeat an id, label and vector are one vector; a null id links with nothing. Ids are whole
    numbers; labels may be of any type. Other columns are not read.
    """
    vector = F.col(vector_column)
    rows = bounded(vectors).select(
        F.col(id_column).cast("long").alias("id"),
        _label(vectors, label_column).alias("label"),
        vector.cast("array<double>").alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    full = F.size("vector") > 0
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & full & ~odd
    usable = rows.where(good).where(F.exists("vector", lambda x: x != 0.0))
    copies = ["label", "vector"]
    # a zero of either sign is the same component
    plain = usable.select("id", "label", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    points = plain.dropDuplicates().groupBy(*copies).agg(F.min("id").alias("node"), F.count("*").alias("many"))
    # an id may stand for several vectors, so points are named by their place in a hash order as well
    points = materialize(points.withColumn("point", F.xxhash64("label", "vector")), "points")
    members = points.mapInArrow(_place, f"point long, {_MEMBER}")
    members = materialize(members, "members")
    links, edges = _compare(members)
    roots = components(edges)
    label = points.select("point", "node").join(roots.withColumnRenamed("node", "point"), "point", "left")
    label = label.select("point", "node", F.coalesce("root", "point").alias("root"))
    label = materialize(label, "labels")
    smallest = label.groupBy("root").agg(F.min("node").alias("component"))
    known = label.join(smallest, "root").select("point", "component").join(links, "point", "left")
    known = points.select("point", "many").join(known, "point")
    known = known.select("point", "component", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"))
    point = F.xxhash64("label", F.transform("vector", lambda x: x + F.lit(0.0)))
    named = rows.select("id", F.when(good, point).alias("point")).join(known, "point", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return named.select(
        "id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _label(vectors: DataFrame, column: str) -> Column:
    """A label as a number: itself, or a 64-bit hash of one that is none."""
    kind = vectors.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def _place(batches):
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.asarray(lists.value_lengths())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        labels = batch.column("label").to_numpy()
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            x = flat[starts[at][:, None] + np.arange(size)]
            # scaled first, so that no square overflows or vanishes
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            keys = cells(x, labels[at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("point").take(pa.array(at)),
                    batch.column("node").take(pa.array(at)),
                    batch.column("many").take(pa.array(at)),
                    pa.array([r.tobytes() for r in x], pa.binary()),
                    pa.array([r.tobytes() for r in keys], pa.binary()),
                ],
                ["point", "node", "many", "unit", "cells"],
            )


def _compare(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of each point, counted, and edges that join what is linked."""
    keyed = members.select("point", "cells").mapInArrow(_spread, "point long, cell long, probe int")
    # a vector enters a cell once
    keyed = keyed.groupBy("point", "cell").agg(F.min("probe").alias("probe"))
    sizes = keyed.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(keyed.join(sizes, "cell"), "shared")
    # a cell of several blocks is compared block by block, so a row travels once for each block
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    parts = max(1, -(-(shared.agg(F.sum(blocks)).first()[0] or 0) // TASK_ROWS))
    own = F.pmod(F.xxhash64("point", F.lit("block")), blocks).cast("int")
    cut = shared.select("point", "cell", "probe", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    cut = cut.select(
        "point", "cell", "probe", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    task = F.pmod(F.xxhash64("cell", "low", "high"), F.lit(parts)).cast("int")
    dealt = cut.join(members.drop("node"), "point").withColumn("task", task)
    found = dealt.groupBy("task").applyInPandas(_cell_links, "point long, links long, root long")
    found = materialize(found, "found")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    return links, found.select(F.col("point").alias("a"), F.col("root").alias("b"))


def _spread(batches):
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.int64)
        count = TABLES * _PROBES
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch.column("point").to_numpy(), count)),
                pa.array(keys),
                pa.array(np.tile(np.arange(count, dtype=np.int32), batch.num_rows)),
            ],
            ["point", "cell", "probe"],
        )


def _cell_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links within each cell, or each pair of its blocks, of a task."""
    rows = rows.sort_values(["cell", "low", "high", "own", "point"], ignore_index=True)
    key = rows[["cell", "low", "high"]].to_numpy()
    cuts = [*np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))), len(rows)]
    units = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), -1) if _even(rows["unit"]) else None
    own, points = rows["own"].to_numpy(), rows["point"].to_numpy()
    many, out = rows["many"].to_numpy(), []
    for a, b in zip(cuts, cuts[1:], strict=False):
        low, high = key[a][1], key[a][2]
        left = np.flatnonzero(own[a:b] == low) + a
        right = np.flatnonzero(own[a:b] == high) + a
        if units is not None:
            x, y = units[left], units[right]
        else:
            x, y = (np.stack([np.frombuffer(rows["unit"][i], np.float64) for i in side]) for side in (left, right))
        near = x @ y.T >= COSINE
        if low == high:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i, j = left[i], right[j]
        first = _first_meeting(rows["cells"], i, j, key[a][0])
        links = np.zeros(b - a, np.int64)
        np.add.at(links, i[first] - a, many[j[first]])
        np.add.at(links, j[first] - a, many[i[first]])
        root = _join(points[a:b], i - a, j - a)
        used = np.flatnonzero((links > 0) | (root != points[a:b]))
        out.append((points[a:b][used], links[used], root[used]))
    columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else [()] * 3)]
    return pd.DataFrame(dict(zip(("point", "links", "root"), columns, strict=True)))


def _even(blobs: pd.Series) -> bool:
    return blobs.str.len().nunique() == 1


def _first_meeting(blobs: pd.Series, i: np.ndarray, j: np.ndarray, cell: int) -> np.ndarray:
    """True for pairs that share no cell before this one, in the order of tables and then of keys."""
    used, code = np.unique(np.concatenate([i, j]), return_inverse=True)
    keys = np.frombuffer(b"".join(blobs[k] for k in used), np.int64).reshape(len(used), TABLES, _PROBES)
    ci, cj = code[: len(i)], code[len(i) :]
    result = np.zeros(len(i), bool)
    live = np.arange(len(i))
    for t in range(TABLES):
        if not len(live):
            break
        x, y = keys[ci[live], t], keys[cj[live], t]
        lowest = np.full(len(live), np.iinfo(np.int64).max)
        met = np.zeros(len(live), bool)
        for p in range(_PROBES):
            for q in range(_PROBES):
                same = x[:, p] == y[:, q]
                met |= same
                lowest = np.where(same, np.minimum(lowest, x[:, p]), lowest)
        result[live[met & (lowest == cell)]] = True
        live = live[~met]
    return result


def _join(points: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest point reachable over the pairs."""
    root = points.copy()
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            return root
        root = new
