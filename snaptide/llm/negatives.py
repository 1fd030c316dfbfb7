"""Hard negatives by Fagin's threshold algorithm.

An anchor's score with a candidate is the inner product of their whole-numbered vectors. Candidates lie in blocks. A block
has one list of its candidates per dimension, sorted by that component. An anchor reads all lists
at once, from the top where its own component is positive and from the bottom where it is
negative; a candidate met for the first time is scored on all its components. What the lists have reached gives a
threshold that no candidate still unmet can exceed. The search of a window of scores ends once the
threshold lies strictly below its k-th score (so that ties are met), or, while it has fewer, below the window.

Two searches follow each other: the positives, the first rows of the anchor's own label, and then the
negatives, the first rows of other labels in the window that each positive's score opens.

Blocks are dealt by label, so positives are sought only where their label lies, and a hot label has many
blocks. A task gets some anchors (a chunk) and some blocks (a lane), both of bounded size; it goes on from block to block with the scores it has
found, and hands on the best of each window. Nothing passes the driver but the numbers of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .centroids import whole
from .words import bounded

POSITIVES = 5
NEGATIVES = 10
# A negative has at least and at most so many hundredths of the positive's score.
LOWEST, HIGHEST = 30, 90

BLOCK_ROWS = 4096
# Anchors and blocks that one task holds; there are at least ``LANES`` lanes if there are so many blocks.
CHUNK_ROWS = 2048
LANE_BLOCKS = 48
LANES = 16
# Tasks that the cells are dealt to, at most; beyond, a task runs several cells, one after the other.
MOST_TASKS = 20_000

_LONGEST = (1 << 63) - 1
_PACK = "labels array<string>, size int, width int, kind string, ids binary, codes binary, x binary, windows binary"
_BEST = "anchor long, window long, id long, score long"


def usable(
    vectors: DataFrame, scale: int = 256, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding"
) -> DataFrame:
    """Rows that take part: ``id``, ``label`` as text and ``x``, the components ``floor(scale * x)`` as doubles."""
    rows = bounded(vectors).select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).alias("x"),
    )
    rows = rows.where("id is not null and label is not null and x is not null")
    whole_rows = rows.mapInArrow(_Whole(scale), "id long, label string, x array<double>")
    # rows of one id stand for one vector, the smaller one of them
    one = whole_rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row"))
    return materialize(one.select("id", "row.label", "row.x"), "vectors")


class _Whole:
    def __init__(self, scale: int):
        self.scale = scale

    def __call__(self, batches):
        for batch in batches:
            lists = batch.column("x")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(flat * self.scale)
            sizes = np.asarray(lists.value_lengths()).astype(np.int64)
            ends = np.cumsum(sizes)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            good = odd[ends] == odd[ends - sizes]
            values = pa.array(flat[np.repeat(good, sizes)])
            offsets = np.concatenate([[0], np.cumsum(sizes[good])]).astype(np.int32)
            at = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("label").take(at), pa.ListArray.from_arrays(pa.array(offsets), values)],
                ["id", "label", "x"],
            )


def _packed(rows: DataFrame, count: int, size: int, label: str) -> DataFrame:
    """Rows of like length and label side by side in packs of at most ``size``, numbered by ``number``."""
    if "windows" not in rows.columns:
        rows = rows.withColumn("windows", F.lit(None).cast("array<long>"))
    key = ["width", "label", F.xxhash64("id"), "id"]
    dealt = rows.withColumn("width", F.size("x")).repartitionByRange(max(1, -(-count // size)), *key)
    packs = dealt.select("id", "label", "x", "width", "windows").mapInArrow(_Pack(size), _PACK)
    return materialize(packs.withColumn("number", F.monotonically_increasing_id()), label)


class _Pack:
    def __init__(self, size: int):
        self.size = size

    def __call__(self, batches):
        held: dict[int, list] = {}
        for batch in batches:
            lists = batch.column("x")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = batch.column("width").to_numpy()
            ends = np.cumsum(sizes)
            for width in np.unique(sizes).tolist():
                for i in np.flatnonzero(sizes == width).tolist():
                    windows = batch.column("windows")[i].as_py()
                    rows = held.setdefault(width, [])
                    x = flat[ends[i] - width : ends[i]]
                    rows.append((batch.column("id")[i].as_py(), batch.column("label")[i].as_py(), x, windows or []))
                    if len(rows) == self.size:
                        yield self._pack(width, held.pop(width))
        for width, rows in held.items():
            yield self._pack(width, rows)

    def _pack(self, width: int, rows: list) -> pa.RecordBatch:
        ids, labels, x, windows = zip(*rows, strict=True)
        names, codes = np.unique(np.array(labels, object), return_inverse=True)
        x = np.concatenate(x) if width else np.zeros(0)
        kind = "<i2" if not x.size or np.abs(x).max() < 1 << 15 else "<f8"
        most = max(map(len, windows))
        scores = np.array([[len(w), *w, *[0] * (most - len(w))] for w in windows], "<i8")
        columns = [
            pa.array([names.tolist()], pa.list_(pa.string())),
            pa.array([len(rows)], pa.int32()),
            pa.array([width], pa.int32()),
            pa.array([kind], pa.string()),
            *(pa.array([a.tobytes()], pa.binary()) for a in (np.array(ids, "<i8"), codes.astype("<i4"), x.astype(kind), scores)),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _PACK.split(", ")])


class Pack:
    """Rows of a pack: ``ids``, ``labels`` as places in ``names``, vectors ``x`` and the scores that open windows."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, "<i8")
        self.names = list(row.labels)
        self.labels = np.frombuffer(row.codes, "<i4")
        self.width = row.width
        x = np.frombuffer(row.x, row.kind).reshape(row.size, row.width).astype(np.float64)
        self.most = float(np.abs(x).max()) if x.size else 0.0
        self.x = x
        scores = np.frombuffer(row.windows, "<i8").reshape(row.size, -1)
        self.scores = [s[1 : 1 + s[0]].tolist() for s in scores]


class Lists:
    """The candidates of a block, sorted by each of their components."""

    def __init__(self, pack: Pack):
        self.pack = pack
        small = pack.x.astype(np.int16) if pack.most < 1 << 15 else pack.x
        order = np.argsort(small, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T.astype(np.int32))
        self.sorted = np.take_along_axis(pack.x, order, 0).T

    def vectors(self, other: float) -> np.ndarray:
        """Vectors as doubles where products with numbers up to ``other`` and their sums are exact, else as whole numbers."""
        exact = max(1, self.pack.width) * max(1.0, self.pack.most) * max(1.0, other) < 1 << 53
        return self.pack.x if exact else whole(self.pack.x, -1)


class Best:
    """The first ``k`` candidates with a score in a window: higher scores first, then smaller ids."""

    __slots__ = ("low", "high", "k", "scores", "ids")

    def __init__(self, low, high, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray):
        least = self.least()
        fit = scores >= least
        if self.high is not None:
            fit &= scores <= self.high
        if not fit.any():
            return
        scores = np.concatenate([self.scores, scores[fit]])
        ids = np.concatenate([self.ids, ids[fit]])
        first = np.lexsort((ids, ~scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]

    def least(self) -> int:
        """The smallest score that may still come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def done(self, threshold) -> bool:
        """Whether no candidate with a score up to ``threshold`` can come in."""
        return threshold < self.least() or (self.high is not None and self.high < self.low)


def search(lists: Lists, vectors: np.ndarray, anchor: np.ndarray, allowed: np.ndarray, windows: list[Best]) -> int:
    """Threshold algorithm: put the block's allowed candidates into the windows of an anchor; how many were scored."""
    n = len(allowed)
    exact = vectors.dtype == object
    a = anchor.astype(vectors.dtype) if not exact else np.array([int(v) for v in anchor], object)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    met = ~allowed
    ids = lists.pack.ids
    depth, step, scored = 0, max(8, n // 128), 0
    windows = [w for w in windows if not w.done(_LONGEST)]
    while windows and depth < n:
        to = min(n, depth + step)
        before = met.copy()
        met[lists.order[up, n - to : n - depth]] = True
        met[lists.order[down, depth:to]] = True
        if not len(up) and not len(down):
            # all scores are zero: there is no list to read
            met[:] = True
        new = np.flatnonzero(met & ~before)
        if len(new):
            found = vectors[new] @ a
            found = _clipped(found) if exact else found.astype(np.int64)
            scored += len(new)
            for window in windows:
                window.add(found, ids[new])
        if met.all():
            break
        top, bottom = lists.sorted[up, n - to], lists.sorted[down, to - 1]
        if exact:
            threshold = sum(int(x) * y for x, y in zip(top, a[up], strict=True))
            threshold += sum(int(x) * y for x, y in zip(bottom, a[down], strict=True))
            threshold = max(-_LONGEST, min(_LONGEST, threshold))
        else:
            threshold = int(top @ a[up] + bottom @ a[down])
        windows = [w for w in windows if not w.done(threshold)]
        depth, step = to, step * 2
    return scored


def _clipped(scores: np.ndarray) -> np.ndarray:
    return np.array([max(-_LONGEST, min(_LONGEST, int(s))) for s in scores], np.int64)


class _Seek:
    """A cell: the anchors of a chunk through the blocks of a lane, for positives or for negatives."""

    def __init__(self, same: bool, k: int, lowest: int, highest: int):
        self.same, self.k, self.lowest, self.highest = same, k, lowest, highest

    def windows(self, scores: list[int]) -> list[Best]:
        if self.same:
            return [Best(-_LONGEST, None, self.k)]
        return [Best(-(-self.lowest * s // 100), self.highest * s // 100, self.k) for s in scores]

    def __call__(self, chunks: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        packs = [Pack(row) for row in chunks.itertuples()]
        windows = [[self.windows(s) for s in pack.scores] for pack in packs]
        # in the order of their numbers, so that a task that runs again does the same
        for row in blocks.sort_values("number").itertuples():
            lists = Lists(Pack(row))
            for pack, own in zip(packs, windows, strict=True):
                if pack.width == lists.pack.width:
                    self._block(lists, pack, own)
        rows = [
            (anchor, score, best.ids, best.scores)
            for pack, own in zip(packs, windows, strict=True)
            for anchor, scores, bests in zip(pack.ids.tolist(), pack.scores, own, strict=True)
            for score, best in zip(scores or [0], bests, strict=True)
            if len(best.ids)
        ]
        sizes = [len(r[2]) for r in rows]
        return pd.DataFrame(
            {
                "anchor": np.repeat(np.array([r[0] for r in rows], np.int64), sizes),
                "window": np.repeat(np.array([r[1] for r in rows], np.int64), sizes),
                "id": np.concatenate([r[2] for r in rows] or [np.zeros(0, np.int64)]),
                "score": np.concatenate([r[3] for r in rows] or [np.zeros(0, np.int64)]),
            }
        )

    def _block(self, lists: Lists, pack: Pack, windows: list[list[Best]]):
        vectors = lists.vectors(pack.most)
        place = {name: i for i, name in enumerate(lists.pack.names)}
        of_label = [lists.pack.labels == place.get(name, -1) for name in pack.names]
        for i, own in enumerate(windows):
            allowed = of_label[pack.labels[i]]
            if self.same:
                allowed = allowed & (lists.pack.ids != pack.ids[i])
            else:
                allowed = ~allowed
            if own and allowed.any():
                search(lists, vectors, pack.x[i], allowed, own)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor's window, with their ``rank``."""
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _cells(chunks: DataFrame, blocks: DataFrame, parts: int, seek: _Seek) -> DataFrame:
    """Run the cells: each chunk goes to every lane of its blocks.

    They are few rows and much work, so they are dealt to ``parts`` tasks and not merged by their bytes.
    """
    places = blocks.select(F.col("chunk").alias("chunk"), F.col("lane").alias("lane")).distinct()
    asked = places.join(chunks, "chunk").repartition(parts, "chunk", "lane")
    cells = asked.groupBy("chunk", "lane").cogroup(blocks.repartition(parts, "chunk", "lane").groupBy("chunk", "lane"))
    # a plain function of two frames: of an object Spark would count itself as an argument
    return materialize(cells.applyInPandas(lambda own, others: seek(own, others), _BEST), "best")


def _tasks(anchors: int, lanes: int) -> int:
    return max(1, min(MOST_TASKS, -(-anchors // CHUNK_ROWS) * lanes))


def positives(anchors: DataFrame, blocks: DataFrame, lanes: int, k: int = POSITIVES) -> DataFrame:
    """The first ``k`` other rows of each anchor's label: ``anchor``, ``id``, ``score`` and ``rank``."""
    count = anchors.count()
    chunks = _packed(anchors, count, CHUNK_ROWS, "chunks").withColumnRenamed("number", "chunk")
    where = blocks.select("number", "width", F.explode("labels").alias("label"))
    asked = chunks.select("chunk", "width", F.explode("labels").alias("label"))
    # chunks and blocks that have a label in common
    pairs = asked.join(where, ["width", "label"]).select("chunk", "number").distinct()
    own = pairs.join(blocks, "number")
    found = _cells(chunks, own, _tasks(count, lanes), _Seek(True, k, 0, 0))
    return materialize(_best(found, k).drop("window"), "positives")


def mine(
    vectors: DataFrame,
    is_anchor,
    positives_each: int = POSITIVES,
    negatives_each: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """Hard negatives of the anchors among ``usable`` rows: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``is_anchor`` is a condition on ``id``. An anchor's positives are its first ``positives_each`` other rows of
    its label. For each of them come the first ``negatives_each`` rows of other labels whose score is from ``lowest`` to
    ``highest`` hundredths of the positive's. Higher scores are first, then smaller ids. Where
    there are fewer, all are given; an anchor without positives, and a positive without negatives, has no row.

    Rows with a null id, label or vector, or a null, infinite or undefined component, take no part (nor does one that is not
    finite once scaled). Rows that repeat an id are one row, that with the smallest label (as text) and then vector. Vectors of
    another length than the anchor's are not compared with it; empty ones score zero. Scores are
    exact; one beyond 64 bits counts as the longest number with its sign. An empty table gives none. Other columns are not read.
    """
    blocks = _packed(vectors, vectors.count(), BLOCK_ROWS, "blocks")
    count = blocks.count()
    lanes = max(1, min(LANES, count), -(-count // LANE_BLOCKS))
    # blocks of one label lie side by side, so they are dealt out in turn
    lane = F.pmod(F.xxhash64("number"), F.lit(lanes)).cast("int")
    blocks = blocks.withColumn("lane", lane)
    anchors = vectors.where(is_anchor)
    near = positives(anchors, blocks, lanes, positives_each)
    opened = near.groupBy("anchor").agg(F.collect_set("score").alias("windows"))
    asked = anchors.join(opened, anchors["id"] == opened["anchor"]).drop("anchor")
    asked = materialize(asked, "asked")
    number = asked.count()
    chunks = _packed(asked, number, CHUNK_ROWS, "windows").withColumnRenamed("number", "chunk")
    every = chunks.select("chunk", "width")
    # every chunk meets the blocks of its length, lane by lane
    own = blocks.join(every, "width")
    found = _cells(chunks, own, _tasks(number, lanes), _Seek(False, negatives_each, lowest, highest))
    hard = _best(found, negatives_each)
    # positives of one score open one window
    pairs = near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("window")).join(hard, ["anchor", "window"])
    return pairs.select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("window").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
