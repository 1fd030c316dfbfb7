"""Removal of repeated passages by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``BLOCK`` words. A run of
``2 * BLOCK - 1`` words holds one of them whole, wherever it lies, so two
documents that share such a run share a block of one with a rolling window of the other. All rolling
windows probe all blocks by hash; hits are then extended: the longer windows around them are compared
over all documents, and consecutive repeated windows are the maximal exact repeats.

Hashes travel as packed columns, one row per chunk of documents and bucket of hashes, with the
place of a word counted through its chunk; the answers return to the chunk.
A passage that a third of all documents hold is reduced within each chunk first: equal windows send one of them, which
stands for the chunk, and its answer is given to the others where they are. So a bucket gets a hash once from each chunk.

Anchors meet by five bytes of a hash; windows are the same if two hashes of 64 bits each agree, made from
two different hashes of every word, so that no words are lost to a false match at any size of a corpus.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from . import marks
from .words import Words, bounded, mix, rolling, run_starts, slices

WINDOW = 13
CHUNK_WORDS = 1_000_000
# Words whose windows meet in one bucket.
BUCKET_WORDS = 1_500_000

_ROW = "bucket int, chunk long, kind int, data binary"
_KEY = ["id", "text_key"]
_PROBE, _HIT, _TABLE, _SAME = 0, 1, 2, 3
# Seed of the second hash of words and windows.
_SECOND = 0x5EED
_FLAG = np.uint32(1 << 31)
# Bytes of a probe's hash that travel; a false meeting is found out when the hit is extended.
_ANCHOR_BYTES = 5


def removals(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``text_key`` (xxhash64 of the text) and ``starts`` of the repeated windows of documents that have any.

    A window is repeated if its words also occur in a document with a smaller id. ``starts``
    are little-endian 32-bit word numbers. Texts under a null id, null texts and texts of fewer words repeat nothing and are not
    repeated; documents that share an id do not count for each other. Ids are whole numbers.
    """
    if window < 1:
        raise ValueError("a window has a word at least")
    texts = _keyed(docs, id_column, text_column).where("id is not null")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // (5 * BUCKET_WORDS)))
    block = (window + 1) // 2
    met = texts.mapInArrow(_Anchors(block, buckets), _ROW).groupBy("bucket").applyInPandas(_meet, _ROW)
    anchors = materialize(met.groupBy("chunk").applyInPandas(_expand, "id long, text_key long, places binary"), "anchors")
    near = _marked(texts, anchors).join(anchors, _KEY)
    told = near.mapInArrow(_Windows(window, block, buckets), _ROW).groupBy("bucket").applyInPandas(_smallest, _ROW)
    found = told.groupBy("chunk").applyInPandas(_expand, "id long, text_key long, places binary")
    # rows that repeat an id and a text have the same answer
    return materialize(found.dropDuplicates(_KEY).withColumnRenamed("places", "starts"), "repeats")


def without_repeats(
    docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space).

    Words are runs of characters other than space and 0x09 to 0x0D. A word goes if a repeated window covers it. A null or
    blank text has no words and keeps the empty text. Other columns are not read.
    """
    found = removals(docs, window, id_column, text_column)
    texts = _keyed(docs, id_column, text_column)
    kind = "id long, n_words long, n_removed long, kept binary"
    plain = _marked(texts, found, False).select("id", "body", F.lit(None).cast("binary").alias("starts"))
    held = _marked(texts, found).join(found, _KEY, "left").select("id", "body", "starts")
    done = plain.mapInArrow(_Cut(window), kind).unionByName(held.mapInArrow(_Cut(window), kind))
    return done.withColumn("kept", F.expr("cast(kept as string)"))


def digest(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and SHA-256 of ``without_repeats``."""
    done = without_repeats(docs, window, id_column, text_column)
    return done.select(
        F.col("id").alias(id_column), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column)
    return bounded(docs).select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("body"))


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, byte by byte, so that equal high bytes lie together and compress."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def _values(data: memoryview, count: int, width: int, kind) -> np.ndarray:
    out = np.zeros((count, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, count * width).reshape(width, count).T
    return out.reshape(-1).view(kind)


class _Chunks:
    """Arrow step that gathers the windows of about ``CHUNK_WORDS`` words and settles them together."""

    def __call__(self, batches):
        self.number = 0
        self._start()
        for part in slices(batches, "body"):
            words = Words(part.column("body"))
            if len(words.starts):
                self._take(part, words)
            if self.at >= CHUNK_WORDS:
                yield self._flush()
        if self.at:
            yield self._flush()

    def _start(self):
        self.at, self.hashes, self.places, self.rows = 0, [], [], []
        self.ids, self.keys, self.firsts = [], [], []

    def _take(self, part, words):
        self.ids.append(part.column("id").to_numpy())
        self.keys.append(part.column("text_key").to_numpy())
        self.firsts.append(words.first[:-1] + self.at)
        base = sum(len(x) for x in self.ids[:-1])
        for hashes, places, rows in self._windows(part, words):
            self.hashes.append(hashes)
            self.places.append((places + self.at).astype(np.uint32))
            self.rows.append((rows + base).astype(np.uint32))
        self.at += len(words.starts)

    def _flush(self):
        context = TaskContext.get()
        chunk = (context.partitionId() << 24) | self.number
        ids, keys, firsts = map(np.concatenate, (self.ids, self.keys, self.firsts))
        empty = np.zeros(0, np.uint32)
        hashes = np.concatenate(self.hashes) if self.hashes else np.zeros((0, 2), np.uint64)
        places = np.concatenate(self.places) if self.places else empty
        rows = np.concatenate(self.rows) if self.rows else empty
        out = self._settle(hashes, places, rows, ids)
        table = np.concatenate([ids.astype(np.int64), keys.astype(np.int64), firsts.astype(np.int64)])
        # what is settled here goes on without meeting others, dealt like the rest
        out.append((-1 - chunk % self.buckets, _TABLE, table.tobytes()))
        self.number += 1
        self._start()
        buckets, kinds, data = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(buckets, pa.int32()),
                pa.array([chunk] * len(out), pa.int64()),
                pa.array(kinds, pa.int32()),
                pa.array(data, pa.binary()),
            ],
            ["bucket", "chunk", "kind", "data"],
        )

    def _deal(self, hashes, columns):
        """Packed rows for each bucket; ``columns`` are (values, bytes that travel) with the hash first."""
        bucket = (mix(hashes) % np.uint64(self.buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[b] : cuts[b + 1]]
            yield int(b), _PROBE, b"".join(_planes(np.ascontiguousarray(v[own]), w) for v, w in columns)

    def _same(self, first, places):
        """Windows that have the answer of the ``first`` of them, which was sent."""
        pairs = np.concatenate([first.astype(np.uint32), places.astype(np.uint32)])
        return (-1 - self.number % self.buckets, _SAME, pairs.tobytes())

    def _hit(self, places):
        return (-1 - self.number % self.buckets, _HIT, places.astype(np.uint32).tobytes())


def _twice(words: Words, hashes: np.ndarray, window: int) -> np.ndarray:
    """Two hashes of every run of ``window`` words, a row each, from two hashes of the words."""
    other = words.hashes(_SECOND)
    return np.stack([rolling(hashes, window, window), rolling(other, window, _SECOND)], axis=1)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class _Anchors(_Chunks):
    """Rolling windows of block length; those at multiples of it are the reference blocks."""

    def __init__(self, block: int, buckets: int):
        self.block, self.buckets = block, buckets

    def _windows(self, part, words):
        hashes = words.hashes()
        inside = run_starts(words.first, self.block, len(hashes))
        places = np.flatnonzero(inside)
        values = rolling(hashes, self.block, self.block)[places]
        yield values & np.uint64((1 << 8 * _ANCHOR_BYTES) - 1), places, words.row_of_word()[places]

    def _settle(self, hashes, places, rows, ids):
        if not len(rows):
            return []
        order = np.argsort(hashes, kind="stable")
        hashes, places, rows = hashes[order], places[order], rows[order]
        firsts = np.concatenate([np.asarray(f) for f in self.firsts])
        block = (places.astype(np.int64) - firsts[rows]) % self.block == 0
        # one window of each document
        low = _runs(hashes, rows)
        block = np.logical_or.reduceat(block, low)
        hashes, places = hashes[low], places[low]
        run = _runs(hashes)
        many = np.diff(np.append(run, len(hashes)))
        known = np.logical_or.reduceat(block, run)
        settled = np.repeat((many > 1) & known, many)
        # a run sends its first window, as a block if one of them is; without a block its others wait for the answer
        sending = places[run] | np.where(known, _FLAG, np.uint32(0))
        out = list(self._deal(hashes[run], [(hashes[run], _ANCHOR_BYTES), (sending, 4)]))
        waiting = np.repeat(~known, many)
        waiting[run] = False
        first = np.repeat(places[run], many)
        return [*out, self._hit(places[settled]), self._same(first[waiting], places[waiting])]


class _Windows(_Chunks):
    """Windows around the anchors of a document."""

    def __init__(self, window: int, block: int, buckets: int):
        self.window, self.block, self.buckets = window, block, buckets

    def _windows(self, part, words):
        hashes = words.hashes()
        if len(hashes) < self.window:
            return
        anchors = rolling(hashes, self.block, self.block)
        values = _twice(words, hashes, self.window)
        inside = run_starts(words.first, self.window, len(hashes))
        near = np.zeros(len(hashes) + 1, np.int64)
        for row, blob in enumerate(part.column("places")):
            low, high = words.first[row], words.first[row + 1] - self.block + 1
            known = anchors[low + np.frombuffer(blob.as_buffer(), np.uint32).astype(np.int64)]
            # a document sends one of its equal windows for all
            at = low + np.flatnonzero(np.isin(anchors[low:high], known))
            np.add.at(near, np.maximum(at - (self.window - self.block), low), 1)
            np.add.at(near, at + 1, -1)
        places = np.flatnonzero(inside & (np.cumsum(near)[: len(inside)] > 0))
        yield values[places], places, words.row_of_word()[places]

    def _settle(self, hashes, places, rows, ids):
        if not len(rows):
            return []
        owner = ids[rows].astype(np.int64)
        order = np.lexsort((owner, hashes[:, 1], hashes[:, 0]))
        hashes, places, owner = hashes[order], places[order], owner[order]
        run = _runs(hashes[:, 0], hashes[:, 1])
        many = np.diff(np.append(run, len(hashes)))
        late = owner > np.repeat(owner[run], many)
        # the window of the smallest id stands for the chunk; equal windows under that id have its answer
        one, two = (np.ascontiguousarray(hashes[run, k]) for k in (0, 1))
        out = list(self._deal(one, [(one, 8), (two, 8), (places[run], 4), (owner[run], 8)]))
        twins = ~late
        twins[run] = False
        first = np.repeat(places[run], many)
        return [*out, self._hit(places[late]), self._same(first[twins], places[twins])]


def _back(rows: pd.DataFrame, probes: pd.DataFrame, chunk: np.ndarray, places: np.ndarray) -> pd.DataFrame:
    """Hits, a row for each chunk, and what only passes through."""
    order = np.argsort(chunk, kind="stable")
    chunk, places = chunk[order], places[order]
    run = _runs(chunk)
    cuts = [*run, len(chunk)]
    numbers = probes["chunk"].to_numpy()
    hits = pd.DataFrame(
        {
            "bucket": np.zeros(len(run), np.int32),
            "chunk": numbers[chunk[run]] if len(run) else np.zeros(0, np.int64),
            "kind": np.full(len(run), _HIT, np.int32),
            "data": [places[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)],
        }
    )
    return pd.concat([rows[rows["kind"] != _PROBE], hits]) if len(hits) else rows[rows["kind"] != _PROBE]


def _unpack(probes: pd.DataFrame, columns: list) -> tuple:
    out, owners = [[] for _ in columns], []
    width = sum(w for w, _ in columns)
    for i, data in enumerate(probes["data"]):
        count, at, view = len(data) // width, 0, memoryview(data)
        for k, (w, kind) in enumerate(columns):
            out[k].append(_values(view[at : at + count * w], count, w, kind))
            at += count * w
        owners.append(np.full(count, i, np.int32))
    return (*map(np.concatenate, out), np.concatenate(owners))


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Windows of several documents of which one is a block."""
    probes = rows[rows["kind"] == _PROBE]
    if not len(probes):
        return rows
    hashes, places, chunk = _unpack(probes, [(_ANCHOR_BYTES, np.uint64), (4, np.uint32)])
    order = np.argsort(hashes, kind="stable")
    hashes, places, chunk = hashes[order], places[order], chunk[order]
    run = _runs(hashes)
    many = np.diff(np.append(run, len(hashes)))
    block = np.logical_or.reduceat(places & _FLAG > 0, run)
    hit = np.repeat((many > 1) & block, many)
    return _back(rows, probes, chunk[hit], (places & ~_FLAG)[hit])


def _smallest(rows: pd.DataFrame) -> pd.DataFrame:
    """Windows that a document with a smaller id has too."""
    probes = rows[rows["kind"] == _PROBE]
    if not len(probes):
        return rows
    hashes, second, places, owner, chunk = _unpack(probes, [(8, np.uint64), (8, np.uint64), (4, np.uint32), (8, np.int64)])
    order = np.lexsort((owner, second, hashes))
    hashes, second, places, owner, chunk = (c[order] for c in (hashes, second, places, owner, chunk))
    run = _runs(hashes, second)
    many = np.diff(np.append(run, len(hashes)))
    late = owner > np.repeat(owner[run], many)
    return _back(rows, probes, chunk[late], places[late])


def _expand(rows: pd.DataFrame) -> pd.DataFrame:
    """Hits of a chunk as places in its documents."""
    table = np.frombuffer(rows.loc[rows["kind"] == _TABLE, "data"].iloc[0], np.int64)
    ids, keys, firsts = table.reshape(3, -1)
    hits = [np.frombuffer(d, np.uint32) for d in rows.loc[rows["kind"] == _HIT, "data"]]
    places = np.unique(np.concatenate(hits)).astype(np.int64) if hits else np.zeros(0, np.int64)
    for data in rows.loc[rows["kind"] == _SAME, "data"]:
        first, others = np.frombuffer(data, np.uint32).reshape(2, -1)
        # none of the others stands for more of them
        places = np.union1d(places, others[np.isin(first, places)].astype(np.int64))
    row = np.searchsorted(firsts, places, "right") - 1
    run = _runs(row)
    cuts = [*run, len(places)]
    own = row[run]
    blobs = [(places[a:b] - firsts[r]).astype(np.uint32).tobytes() for a, b, r in zip(cuts, cuts[1:], own, strict=False)]
    return pd.DataFrame({"id": ids[own], "text_key": keys[own], "places": blobs})


def _marked(texts: DataFrame, found: DataFrame, wanted: bool = True) -> DataFrame:
    """Rows of ``texts`` that may be in ``found``, or those that are surely not."""
    return marks.where(texts, marks.bit(*_KEY), marks.table(found, marks.bit(*_KEY)), wanted)


class _Cut:
    def __init__(self, window: int):
        self.window = window

    def __call__(self, batches):
        for part in slices(batches, "body"):
            counts, gone, kept = [], [], []
            bodies = part.column("body")
            starts = part.column("starts")
            spread = None
            for row in range(part.num_rows):
                text = bodies[row]
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                stay = words
                if starts[row].is_valid and len(words) >= self.window:
                    if spread is None:
                        spread = Words(bodies)
                        values = _twice(spread, spread.hashes(), self.window)
                    low = spread.first[row]
                    own = values[low : low + len(words) - self.window + 1]
                    at = np.frombuffer(starts[row].as_buffer(), np.uint32).astype(np.int64)
                    # equal windows of one document share a number
                    number = np.unique(own, axis=0, return_inverse=True)[1].reshape(-1)
                    hit = np.flatnonzero(np.isin(number, number[at]))
                    change = np.zeros(len(words) + 1, np.int64)
                    change[hit] += 1
                    change[hit + self.window] -= 1
                    covered = np.cumsum(change[:-1]) > 0
                    stay = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                counts.append(len(words))
                gone.append(len(words) - len(stay))
                kept.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                ["id", "n_words", "n_removed", "kept"],
            )
