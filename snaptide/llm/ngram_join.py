"""N-gram Jaccard join by a tree of count vectors.

A text is the set of its distinct five-word shingles. Shingles are hashed into
``GROUPS`` groups, and the group counts are a point. For two points the sum of the coordinate minima bounds
the overlap of the sets from above; for a point and a box, the minima with the
upper corner of the box bound the overlap with every point inside.

A tree of such points alone prunes little: the distance that a similarity of 0.75
allows is as large as the distance of unrelated texts of equal length, so every leaf would
meet every other. The root therefore deals the points into cells of texts that share a
signature (``ROWS`` minima of the shingle hashes under ``BANDS`` orders of their own). Two
linked texts share no cell with probability below ``(1 - 0.75 ** ROWS) ** BANDS``, about 6e-8 at
the very threshold and far less above it. Then

1. texts with the same set become one point,
2. each point is compared with the first point of the cell it shares most signatures with; the links
   found form groups,
3. in each cell that holds points of several groups, the points are packed into leaves by size and group,
   each point descends to the leaves whose box allows a link, and meets the points of other groups there,

and every pair that survives the bounds is verified on the whole sets. A group of
thousands of near copies costs one comparison a text, not one a pair; a cell with many points is
searched in blocks, so no task gets a whole large cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from . import marks
from .components import components
from .words import Words, bounded, mix, rolling, run_starts, slices

SHINGLE = 5
# Linked: NUMERATOR * union <= DENOMINATOR * intersection.
NUMERATOR, DENOMINATOR = 75, 100
GROUPS = 256
ROWS, BANDS = 4, 44
# Points of a leaf, of a block of a cell, and about as many rows for one task.
LEAF, BLOCK, TASK_ROWS = 16, 512, 16_384
# Pairs that a task holds before it drops repeated ones.
HELD_PAIRS = 500_000
# A coordinate at this limit bounds nothing.
FULL = 255

_POINT = "id long, n long, set_a long, set_b long, bands array<long>, point binary"


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, one row after the other, and the bounds of the rows."""
    words = Words(column, lower=True)
    hashes = words.hashes()
    inside = run_starts(words.first, SHINGLE, len(hashes))
    values = rolling(hashes, SHINGLE, SHINGLE)[inside]
    upto = np.concatenate([[0], np.cumsum(np.maximum(words.counts - SHINGLE + 1, 0))])
    parts = []
    for row in range(words.rows):
        count = words.counts[row]
        if count >= SHINGLE:
            parts.append(np.unique(values[upto[row] : upto[row + 1]]))
        elif count:
            # the whole sequence, whose length is part of its hash
            own = hashes[words.first[row] : words.first[row + 1]]
            parts.append(rolling(own, count, 100 + count))
        else:
            parts.append(np.zeros(0, np.uint64))
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds


def _orders() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64))
    shift, scale = seeds[::2].astype(np.uint32), seeds[1::2].astype(np.uint32) | np.uint32(1)
    return shift, scale


def _points(batches):
    shift, scale = _orders()
    for part in slices(batches, "body"):
        values, bounds = _sets(part.column("body"))
        n = np.diff(bounds)
        full = np.flatnonzero(n)
        lows = bounds[:-1][full]
        count = len(full)
        signed = np.zeros((2, part.num_rows), np.int64)
        bands = np.zeros((count, BANDS), np.uint64)
        point = np.zeros((count, GROUPS), np.int64)
        if count:
            for k in (0, 1):
                signed[k, full] = _signed(values, lows, k)
            short = (values >> np.uint64(32)).astype(np.uint32)
            for k in range(ROWS * BANDS):
                # a low product of its own order for each k: multiplication by an odd number permutes 32 bits
                low = np.minimum.reduceat((short ^ shift[k]) * scale[k], lows)
                bands[:, k // ROWS] = bands[:, k // ROWS] * np.uint64(0x9E3779B97F4A7C15) + low
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
            at = np.repeat(np.arange(count), n[full]) * GROUPS + (values & np.uint64(GROUPS - 1)).astype(np.int64)
            point = np.bincount(at, minlength=count * GROUPS).reshape(count, GROUPS)
        point = np.minimum(point, FULL).astype(np.uint8)
        points = np.full(part.num_rows, None, object)
        points[full] = [p.tobytes() for p in point]
        place = np.zeros(part.num_rows + 1, np.int64)
        place[1:][full] = 1
        place = np.cumsum(place).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array(n),
                pa.array(signed[0]),
                pa.array(signed[1]),
                pa.ListArray.from_arrays(pa.array(place * BANDS, pa.int32()), pa.array(bands.view(np.int64).ravel())),
                pa.array(points, pa.binary()),
            ],
            ["id", "n", "set_a", "set_b", "bands", "point"],
        )


def _bound(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Most shingles that points, or a point and a box, can share."""
    both = np.minimum(left, right)
    sums = both.sum(axis=-1, dtype=np.int64)
    return np.where((both == FULL).any(axis=-1), np.int64(1) << 40, sums)


def _allowed(bound: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``n`` and ``m`` that share ``bound`` shingles are linked."""
    return (NUMERATOR + DENOMINATOR) * bound >= NUMERATOR * (n + m)


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component`` (smallest id reachable by links) of each row of ``docs``.

    Words are runs of characters other than space and 0x09 to 0x0D, with A-Z as a-z. A text of fewer than
    five words has its whole sequence as its one shingle. Null and blank texts have none and are linked with nothing. Rows that
    repeat an id are rows of one document: they get the smallest component of any of them. A null id is
    linked with nothing and stands for itself (a null component). Ids are whole numbers. Other columns are not read.
    """
    texts = bounded(docs).select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("body"))
    points = materialize(texts.mapInArrow(_points, _POINT), "points")
    # one node per set: a group of copies is reduced map-side to its smallest id
    filled = points.where("n > 0 and id is not null").groupBy("set_a", "set_b", "n")
    nodes = filled.agg(F.min(F.struct("id", "bands", "point")).alias("low"))
    nodes = nodes.select(F.col("set_a").alias("node"), F.col("low.id").alias("rep"), "n", "low.bands", "low.point")
    nodes = materialize(nodes, "nodes")
    roots = components(_links(texts, nodes))
    named = nodes.select("node", "rep").join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(smallest, "root").select(F.col("node").alias("set_a"), "component")
    found = points.select("id", "n", F.when(F.col("n") > 0, F.col("set_a")).alias("set_a")).join(named, "set_a", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select("id", F.col("n").alias("n_shingles"), component.alias("component"))


def _links(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    keyed = keyed.select("node", (F.col("key") + F.col("band")).alias("key"))
    cells = keyed.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("size")).where("size > 1")
    shared = materialize(keyed.join(cells, "key"), "shared")

    # each point against the point that opens the cell it shares most signatures with
    ranked = shared.where("node <> first").groupBy("node", "first").agg(F.count("*").alias("times"))
    best = ranked.groupBy("node").agg(F.max(F.struct("times", "first")).alias("best"))
    # the first of a cell is its smallest node
    best = best.select(F.col("best.first").alias("a"), F.col("node").alias("b"))
    tried = materialize(_narrow(best, nodes), "tried")
    links = materialize(_verify(texts, nodes, tried), "links")

    # then against the points of other groups, cell by cell: first the likeliest partner of each point, which
    # joins most of what belongs together, then every partner that is left in another group
    for likeliest in (True, False):
        pairs = _meetings(shared, nodes, components(links), likeliest)
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        links = materialize(links.unionByName(_verify(texts, nodes, pairs)), "links")
        tried = materialize(tried.unionByName(pairs), "tried")
    return links


def _meetings(shared: DataFrame, nodes: DataFrame, groups: DataFrame, likeliest: bool) -> DataFrame:
    """Pairs of points of different groups that share a cell and whose bounds allow a link."""
    label = groups.select("node", F.col("root").alias("label"))
    labelled = shared.join(label, "node", "left").select("key", "size", "node", F.coalesce("label", "node").alias("label"))
    labelled = materialize(labelled, "labelled")
    counts = labelled.groupBy("key", "label", "size").agg(F.count("*").alias("many"))
    mixed = counts.groupBy("key", "size").agg(F.max(F.struct("many", "label")).alias("most")).where("most.many < size")
    mixed = materialize(labelled.drop("size").join(mixed, "key"), "mixed")
    # a cell of several blocks is searched block by block; points of its largest group, which have blocks of their
    # own after those of the others, meet only the others
    large = F.col("size") > BLOCK
    most = F.when(large, F.ceil(F.col("most.many") / F.lit(BLOCK))).otherwise(0).cast("int")
    others = F.when(large, F.ceil((F.col("size") - F.col("most.many")) / F.lit(BLOCK))).otherwise(1).cast("int")
    inner = large & (F.col("label") == F.col("most.label"))
    place = F.xxhash64("node", F.lit("block"))
    own = F.when(inner, others + F.pmod(place, F.greatest(most, F.lit(1)))).otherwise(F.pmod(place, others)).cast("int")
    meets = F.when(inner, others).otherwise(others + most)
    # a row travels once for each block it meets
    parts = max(1, -(-(mixed.agg(F.sum(meets)).first()[0] or 0) // TASK_ROWS))
    dealt = mixed.select("key", "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), meets - 1)).alias("other"))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other")
    task = F.pmod(F.xxhash64("key", "low", "high"), F.lit(parts)).cast("int")
    dealt = dealt.join(nodes.select("node", "n", "point"), "node").withColumn("task", task)
    return dealt.groupBy("task").applyInPandas(lambda rows: _search(rows, likeliest), "a long, b long").distinct()


def _search(rows: pd.DataFrame, likeliest: bool) -> pd.DataFrame:
    """Pairs in each cell, or each pair of its blocks; with ``likeliest`` the one of each point that shares most by its bound."""
    rows = rows.sort_values(["key", "low", "high", "own", "n", "label", "node"], ignore_index=True)
    key = rows[["key", "low", "high"]].to_numpy()
    cuts = [*np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))), len(rows)]
    points = np.frombuffer(b"".join(rows["point"]), np.uint8).reshape(-1, GROUPS)
    n, label, own = rows["n"].to_numpy(), rows["label"].to_numpy(), rows["own"].to_numpy()
    node = rows["node"].to_numpy()
    found, held = [], 0
    for low, high in zip(cuts, cuts[1:], strict=False):
        left = np.flatnonzero(own[low:high] == key[low][1]) + low
        right = np.flatnonzero(own[low:high] == key[low][2]) + low
        for i, j, bound in _descend(points, n, label, left, right):
            found.append((np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), bound / (n[i] + n[j])))
            held += len(i)
        if held > HELD_PAIRS:
            # cells of one task repeat pairs
            kept, held = _distinct(found, likeliest), 0
            found = [(kept["a"].to_numpy(), kept["b"].to_numpy(), kept["share"].to_numpy())]
    return _distinct(found, likeliest)[["a", "b"]]


def _distinct(found: list, likeliest: bool) -> pd.DataFrame:
    columns = zip(*found, strict=True) if found else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)])
    pairs = pd.DataFrame(dict(zip(("a", "b", "share"), map(np.concatenate, columns), strict=True)))
    pairs = pairs.drop_duplicates(["a", "b"])
    return _likeliest(pairs) if likeliest else pairs


def _likeliest(pairs: pd.DataFrame) -> pd.DataFrame:
    """The first pair of each end, by the share of what both hold."""
    ends = pd.concat([pairs.assign(end=pairs["a"]), pairs.assign(end=pairs["b"])])
    ends = ends.sort_values(["end", "share", "a", "b"], ascending=[True, False, True, True])
    return ends.drop_duplicates("end")[["a", "b", "share"]].drop_duplicates()


def _descend(points, n, label, left, right):
    """Each point of ``left`` against the leaves of ``right``, then against the points of the leaves that are left."""
    starts = np.arange(0, len(right), LEAF)
    if not len(left) or not len(starts):
        return
    corners = np.maximum.reduceat(points[right], starts, axis=0)
    least = np.minimum.reduceat(n[right], starts)
    most = np.maximum.reduceat(n[right], starts)
    for leaf, start in enumerate(starts):
        # a leaf holds points of about one size: the sizes, then the box, turn most away
        near = left[(DENOMINATOR * most[leaf] >= NUMERATOR * n[left]) & (DENOMINATOR * n[left] >= NUMERATOR * least[leaf])]
        near = near[_allowed(_bound(points[near], corners[leaf]), n[near], least[leaf])]
        inside = right[start : start + LEAF]
        i, j = np.repeat(near, len(inside)), np.tile(inside, len(near))
        good = (i != j) & (label[i] != label[j])
        good &= DENOMINATOR * np.minimum(n[i], n[j]) >= NUMERATOR * np.maximum(n[i], n[j])
        i, j = i[good], j[good]
        bound = _bound(points[i], points[j])
        good = _allowed(bound, n[i], n[j])
        if good.any():
            yield i[good], j[good], bound[good]


def _narrow(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sizes and points allow a link."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    joined = pairs.join(left, "a").join(right, "b")
    joined = joined.where(F.lit(DENOMINATOR) * F.least("na", "nb") >= F.lit(NUMERATOR) * F.greatest("na", "nb"))
    return joined.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_bounded_pairs, "a long, b long")


def _bounded_pairs(batches):
    for batch in batches:
        pa_, pb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS) for c in ("pa", "pb"))
        good = _allowed(_bound(pa_, pb), batch.column("na").to_numpy(), batch.column("nb").to_numpy())
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _verify(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose whole sets are linked."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ends = materialize(nodes.select("node", "rep").join(ends, "node", "left_semi"), "ends")
    # texts that are not marked are in no pair
    marked = marks.where(texts.where("id is not null"), marks.bit("id"), marks.table(ends, marks.bit("rep")))
    sets = marked.mapInArrow(_shingled, "id long, node long, shingles binary").drop("id")
    sets = sets.join(ends.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = materialize(sets, "shingles")
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    joined = joined.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(_linked, "a long, b long")


def _shingled(batches):
    for part in slices(batches, "body"):
        values, bounds = _sets(part.column("body"))
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            nodes = _signed(values, bounds[:-1][full], 0)
            blobs = [values[bounds[r] : bounds[r + 1]].tobytes() for r in full]
            columns = [part.column("id").take(pa.array(full)), pa.array(nodes), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "node", "shingles"])


def _signed(values: np.ndarray, lows: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each whole set."""
    return mix(np.add.reduceat(mix(values + np.uint64(0x51ED27 * (k + 1))), lows)).view(np.int64)


def _linked(batches):
    for batch in batches:
        good = []
        for a, b in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int((y[at] == x).sum())
            good.append(DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of its group; rows without an id all stay.

    Of rows that repeat an id one stays: the one with the smallest text (a null text first), and of those that share it, too, the first by a
    hash of all columns. Ids are whole numbers.
    """
    found = materialize(classes(docs, id_column, text_column), "classes").where("id is not null")
    lost = found.where("component < id").select("id")
    twice = found.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    asked = materialize(lost.unionByName(twice).distinct(), "asked")
    # texts that are not marked stay where they are
    known = marks.table(asked, marks.bit("id"))
    place = marks.bit(F.col(id_column).cast("long"))
    bounded(docs)
    plain = marks.where(docs, place, known, False)
    others = marks.where(docs, place, known)
    gone = lost.distinct().select(F.col("id").alias(id_column))
    named = others.where(F.col(id_column).isNotNull()).join(gone, id_column, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    # limited per id before the shuffle as well, so a hot id sends one row per task
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not f.dataType.simpleString().count("map<")])
    order = Window.partitionBy(F.col(id_column)).orderBy(F.col(text_column).asc_nulls_first(), whole)
    place = F.row_number().over(order)
    one = named.withColumn("row of its id", place).where(F.col("`row of its id`") == 1).drop("row of its id")
    kept = plain.unionByName(one)
    return kept.unionByName(others.where(F.col(id_column).isNull()))
