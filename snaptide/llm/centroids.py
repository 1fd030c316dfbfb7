"""Clusters of integer vectors by equal-average equal-variance nearest-neighbour search.

Lloyd's rounds on whole numbers: every vector goes to its nearest centroid, every centroid
to the floored mean of its vectors. The search keeps the centroids sorted by the sum of their
components (their mean) and goes outward from the sum of the vector. With ``n`` components, sums ``s`` and
spreads ``v = sqrt(n * sum(x * x) - s * s)``,

    n * distance >= (s_x - s_c) ** 2 + (v_x - v_c) ** 2

so once the first square alone is beyond ``n`` times the best distance, all centroids further out are rejected,
and one whose two squares are is passed over. What is left is computed in whole numbers.

A round is one pass over the vectors. Each task adds up its vectors per cluster, so what is shuffled and what the
driver reads has one row per cluster and component, whatever the number of vectors. Vectors of small numbers are
handled in 64-bit arrays, others with numbers of any size by the same code.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .words import bounded

# Sums travel in pieces of so many bits, so that they add up in Spark without a limit.
_LIMB = 40
_LONGEST = (1 << 63) - 1


def whole(x: np.ndarray, most: int) -> np.ndarray:
    """Whole numbers held as doubles, in 64 bits if none is beyond ``most``, else of any size."""
    if not x.size or np.abs(x).max() <= most:
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots, rounded down; those of 64-bit numbers may be off by one."""
    if squares.dtype == object:
        return np.array([math.isqrt(v) for v in squares], object)
    return np.sqrt(squares.astype(np.float64)).astype(np.int64)


@dataclass
class Search:
    """Centroids in the order of their means."""

    points: list[list[int]]
    # distances that had to be computed
    computed: int = field(default=0, compare=False)

    def __post_init__(self):
        self.size = len(self.points[0])
        # so that no product of the search leaves 64 bits
        self.most = math.isqrt((1 << 62) // self.size**2) // 2
        self.order = sorted(range(len(self.points)), key=lambda c: (sum(self.points[c]), c))
        self._tables = {}

    def _table(self, kind):
        if kind not in self._tables:
            points = np.array([self.points[c] for c in self.order], kind).reshape(-1, self.size)
            sums = points.sum(axis=1)
            spreads = _root(self.size * (points * points).sum(axis=1) - sums * sums)
            self._tables[kind] = points, sums, spreads, np.array(self.order)
        return self._tables[kind]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row and the squared distance; of equally near ones the smallest number."""
        if any(abs(v) > self.most for p in self.points for v in p):
            x = x.astype(object)
        points, sums, spreads, numbers = self._table(x.dtype.type if x.dtype != object else object)
        n, last = self.size, len(numbers) - 1
        own = x.sum(axis=1)
        spread = _root(n * (x * x).sum(axis=1) - own * own)
        right = np.searchsorted(sums, own)
        left = right - 1
        best = np.full(len(x), -1)
        distance = np.zeros(len(x), x.dtype)
        live = np.arange(len(x))
        while len(live):
            below, above = left[live], right[live]
            down = own[live] - sums[np.maximum(below, 0)]
            up = sums[np.minimum(above, last)] - own[live]
            lower = (above > last) | ((below >= 0) & (down <= up))
            gap = np.where(lower, down, up)
            known = best[live] >= 0
            beyond = known & (gap * gap > n * distance[live]).astype(bool)
            go = ~(beyond | ((below < 0) & (above > last)))
            live, gap, known, lower = live[go], gap[go], known[go], lower[go]
            at = np.where(lower, below[go], above[go])
            left[live] -= lower
            right[live] += ~lower
            # the roots are rounded, so the difference may be two less
            apart = np.maximum(np.abs(spread[live] - spreads[at]) - 2, 0)
            near = ~known | (gap * gap + apart * apart <= n * distance[live]).astype(bool)
            rows, at = live[near], at[near]
            self.computed += len(rows)
            found = ((x[rows] - points[at]) ** 2).sum(axis=1)
            first = best[rows] < 0
            tie = (found == distance[rows]).astype(bool) & (numbers[at] < best[rows])
            better = first | (found < distance[rows]).astype(bool) | tie
            distance[rows[better]] = found[better]
            best[rows[better]] = numbers[at[better]]
        return best, distance


def quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of lists of one length without a null or non-finite component, and ``floor(scale * x)`` of theirs as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(flat.reshape(len(column), -1) * scale)
    good = np.flatnonzero(np.isfinite(x).all(axis=1))
    return good, x[good]


class _Quantise:
    def __init__(self, scale: int):
        self.scale = scale

    def __call__(self, batches):
        for batch in batches:
            if batch.num_rows:
                good, x = quantised(batch.column("x"), self.scale)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(good)), _lists(x)], ["id", "x"]
                )


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))


def _matrix(batch: pa.RecordBatch, search: Search) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return whole(flat.reshape(batch.num_rows, search.size), search.most)


class _Sums:
    """Rows of each cluster (component -1) and sums of their components, over a whole task."""

    def __init__(self, search: Search):
        self.search = search

    def __call__(self, batches):
        totals: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, self.search)
            cluster, _ = self.search.nearest(x)
            order = np.argsort(cluster, kind="stable")
            present, starts, counts = np.unique(cluster[order], return_index=True, return_counts=True)
            sums = np.add.reduceat(x[order], starts, axis=0)
            for c, count, row in zip(present.tolist(), counts.tolist(), sums.tolist(), strict=True):
                old = totals.get(c, [0] * (self.search.size + 1))
                totals[c] = [a + b for a, b in zip(old, [count, *row], strict=True)]
        rows = [(c, i - 1, limb, v) for c, row in totals.items() for i, t in enumerate(row) for limb, v in _limbs(t)]
        columns = zip(*rows, strict=True) if rows else [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["cluster", "component", "limb", "total"]
        )


def _limbs(value: int):
    """``value`` as signed pieces of ``_LIMB`` bits."""
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while True:
        yield limb, sign * (value & ((1 << _LIMB) - 1))
        value >>= _LIMB
        limb += 1
        if not value:
            return


class _Assign:
    def __init__(self, search: Search):
        self.search = search

    def __call__(self, batches):
        for batch in batches:
            if batch.num_rows:
                cluster, distance = self.search.nearest(_matrix(batch, self.search))
                if distance.dtype == object:
                    distance = np.array([min(d, _LONGEST) for d in distance], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    ["id", "cluster", "distance"],
                )


def moved(points: DataFrame, search: Search) -> list[list[int]]:
    """The floored mean of the vectors of each centroid; a centroid without any stays."""
    kind = "cluster int, component int, limb int, total long"
    sums = points.select("x").mapInArrow(_Sums(search), kind).groupBy("cluster", "component", "limb")
    # a row per cluster, component and piece
    rows = sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals: dict[tuple[int, int], int] = {}
    for cluster, component, limb, total in rows:
        totals[cluster, component] = totals.get((cluster, component), 0) + (int(total) << (_LIMB * limb))
    return [
        [totals[c, i] // totals[c, -1] for i in range(search.size)] if totals.get((c, -1)) else point
        for c, point in enumerate(search.points)
    ]


def centred(points: DataFrame, k: int, rounds: int, seed: int) -> list[list[int]]:
    """Centroids of ``points`` (``id`` and ``x``, whole numbers held as doubles) after the rounds; see ``cluster``."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = points.orderBy(rank.asc_nulls_last(), "x").limit(k).select("x").collect()
    centres = [[int(v) for v in row[0]] for row in first]
    for _ in range(rounds if centres else 0):
        after = moved(points, Search(centres))
        if after == centres:
            break
        centres = after
    return centres


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    components: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` of every vector that is kept, and the centroids.

    Kept are vectors of ``components`` components of which none is null, infinite or undefined (``scale`` times
    it must be finite too); their components become ``floor(scale * x)``. The first centroids are the ``k`` vectors whose
    ``seed:id`` has the smallest SHA-256, of rows with one id the smaller vector first; fewer vectors
    give fewer centroids, none an empty table. Rounds end early once no centroid moves, since
    the others would not move any either. Repeated rows are rows of their own; a null id is kept and comes last in the
    order of the hash. A distance or a sum of them beyond 64 bits is the largest long. Other columns are not read.
    """
    listed = bounded(vectors).select(F.col(id_column).alias("id"), F.col(vector_column).alias("x"))
    listed = listed.where(F.size("x") == components)
    kind = f"id {listed.schema['id'].dataType.simpleString()}"
    points = materialize(listed.mapInArrow(_Quantise(scale), f"{kind}, x array<double>"), "vectors")
    centres = centred(points, k, rounds, seed)
    spark = vectors.sparkSession
    if not centres:
        empty = f"{kind}, cluster int, distance long, cluster_inertia long, inertia long"
        return spark.createDataFrame([], empty), []
    search = Search(centres)
    found = materialize(points.mapInArrow(_Assign(search), f"{kind}, cluster int, distance long"), "assigned")
    # a row per cluster
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole_sum = min(_LONGEST, sum(int(t) for _, t in sums))
    inertia = spark.createDataFrame(
        [(c, min(_LONGEST, int(t)), whole_sum) for c, t in sums], "cluster int, cluster_inertia long, inertia long"
    )
    return found.join(F.broadcast(inertia), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia"
    ), search.points


def digests(spark, centroids: list[list[int]]) -> DataFrame:
    """``cluster`` and ``centroid_sha256``, the SHA-256 of its components joined by commas: a row per centroid."""
    rows = [(c, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for c, p in enumerate(centroids)]
    return spark.createDataFrame(rows, "cluster int, centroid_sha256 string")
