"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of its words; a document is hit where it contains a
window exactly. The words of a window, read as shingles, are a set that a hit must
contain whole, so one necessary shingle per window suffices as its prefix. The rarest
one is taken, by counts over all documents. Documents are joined to windows on that
shingle alone; its position in the window gives the only place where the window can
start, which is bounded by both ends of the document; and the window is then compared
whole at that place.

The benchmark is handled in blocks of bounded size. Each block counts its shingles in one pass over
the texts, whatever other blocks there are, and then probes in one; ``STEPS`` probes run in one stage,
and more of them go on from what those before have written. Documents are never shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .words import ALNUM, Words, bounded, rolling, run_starts, slices

WINDOW = 10
SHINGLE = 3
# Bytes of benchmark text in a block.
BLOCK_BYTES = 8 << 20
# Blocks that are probed in one stage, each by a Python worker of its own.
STEPS = 4

_EMPTY = b""


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``spans`` (from, to of hit words), ``items``, and columns of ``keep``.

    Words are runs of ASCII letters, digits and characters beyond ASCII; A-Z count as
    a-z. A window is ``window`` consecutive words of an item; an item with fewer words is
    one window. Null and empty texts have no words and no hits; items without words, or with a null
    id, never occur. Repeated documents give repeated rows; an item id that stands for several texts stands for the
    windows of all of them. Other columns, of any name, are carried only if ``keep`` names them.
    """
    texts = bounded(docs).select(F.col(text_column).alias("body"))
    state = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("body"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(_EMPTY).alias("hits"),
        F.lit("[]").alias("items"),
        *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)),
    )
    schema = state.schema
    for number, items in _blocks(benchmark, item_column, item_text_column):
        index = _Index(items, window, shingle)
        index.rank(_counts(texts, index))
        if number and number % STEPS == 0:
            state = materialize(state, "probed")
        state = state.mapInArrow(_Probe(index, number), schema)
    spans = F.from_json(F.expr("cast(hits as string)"), "array<array<int>>")
    return state.select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce(spans, F.array().cast("array<array<int>>")).alias("spans"),
        F.from_json("items", "array<string>").alias("items"),
        *(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)),
    )


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and hash of what ``decontaminate`` found, one row per row."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    ids = F.array_sort("items")
    return found.select(
        id_column,
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[tuple[int, list]]:
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text_column).alias("body"))
    items = items.where("item is not null and body is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * total // BLOCK_BYTES))
    for number in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == number)
        yield number, sorted((r["item"], r["body"]) for r in own.collect())


class _Index:
    """Windows of a block of items and the shingle by which each is looked up."""

    def __init__(self, items: list, window: int, shingle: int):
        self.names = [name for name, _ in items]
        words = Words(pa.array([body for _, body in items], pa.string()), ALNUM, lower=True)
        hashes = words.hashes()
        self.groups = []
        counts = words.counts
        lengths = np.minimum(counts, window)
        for length in sorted(set(lengths.tolist()) - {0}):
            starts, owner = [], []
            for row in np.flatnonzero(lengths == length):
                own = np.arange(words.first[row], words.first[row + 1] - length + 1)
                starts.append(own)
                owner.append(np.full(len(own), row))
            starts, owner = np.concatenate(starts), np.concatenate(owner)
            size = min(shingle, length)
            parts = rolling(hashes, size, size)
            each = np.stack([parts[starts + k] for k in range(length - size + 1)], axis=1)
            whole = rolling(hashes, length, 1000 + length)[starts]
            text = [words.bytes_of(s, s + length) for s in starts]
            self.groups.append({"length": length, "size": size, "each": each, "whole": whole, "owner": owner, "text": text})
        self.sizes = sorted({g["size"] for g in self.groups})
        self.tokens = {
            size: np.unique(np.concatenate([g["each"].ravel() for g in self.groups if g["size"] == size]))
            for size in self.sizes
        }

    def rank(self, counts: dict[int, np.ndarray]) -> None:
        """Choose the rarest shingle of each window, the first of equals, and sort windows by it."""
        for g in self.groups:
            tokens = self.tokens[g["size"]]
            seen = counts[g["size"]][np.searchsorted(tokens, g["each"])]
            g["offset"] = np.argmin(seen, axis=1)
            g["prefix"] = np.take_along_axis(g["each"], g["offset"][:, None], 1)[:, 0]
            order = np.argsort(g["prefix"], kind="stable")
            for name in ("offset", "prefix", "whole", "owner"):
                g[name] = g[name][order]
            g["text"] = [g["text"][i] for i in order]
            g["keys"], g["low"], g["many"] = np.unique(g["prefix"], return_index=True, return_counts=True)
            del g["each"]


class _Member:
    """Which of many hashes are in a small sorted set: a bit table first, then a search of the few that pass."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[(keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` and in ``keys`` of what both hold."""
        near = np.flatnonzero(self.table[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        if not len(near) or not len(self.keys):
            return near[:0], near[:0]
        at = np.minimum(np.searchsorted(self.keys, hashes[near]), len(self.keys) - 1)
        good = self.keys[at] == hashes[near]
        return near[good], at[good]


def _counts(texts: DataFrame, index: _Index) -> dict[int, np.ndarray]:
    """Occurrences of the block's shingles in all documents; the answer has a row for each shingle of the block."""
    tokens = index.tokens

    def count(batches):
        members = {size: _Member(keys) for size, keys in tokens.items()}
        totals = {size: np.zeros(len(keys), np.int64) for size, keys in tokens.items()}
        for part in slices(batches, "body"):
            words = Words(part.column("body"), ALNUM, lower=True)
            hashes = words.hashes()
            for size, member in members.items():
                if len(hashes) < size:
                    continue
                where, at = member.find(rolling(hashes, size, size))
                inside = run_starts(words.first, size, len(hashes))[where]
                totals[size] += np.bincount(at[inside], minlength=len(member.keys))
        for size, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), size), pa.int32()), pa.array(seen, pa.int32()), pa.array(total[seen])],
                ["size", "place", "n"],
            )

    found = texts.mapInArrow(count, "size int, place int, n long").groupBy("size", "place").agg(F.sum("n"))
    out = {size: np.zeros(len(keys), np.int64) for size, keys in tokens.items()}
    for size, place, n in found.collect() if tokens else []:
        out[size][place] = n
    return out


class _Probe:
    """Arrow step that adds one block's hits to each document."""

    def __init__(self, index: _Index, number: int):
        self.index, self.number = index, number

    def __call__(self, batches):
        members = [_Member(g["keys"]) for g in self.index.groups]
        for part in slices(batches, "body"):
            words = Words(part.column("body"), ALNUM, lower=True)
            hashes = words.hashes()
            spans = [[] for _ in range(part.num_rows)]
            items = [set() for _ in range(part.num_rows)]
            rows = words.row_of_word()
            for g, member in zip(self.index.groups, members, strict=True):
                for row, start, owner in self._hits(g, member, words, hashes, rows):
                    spans[row].append((start, start + g["length"]))
                    items[row].add(owner)
            yield self._out(part, words, spans, items)

    def _hits(self, g, member, words, hashes, rows):
        if len(hashes) < g["length"]:
            return
        where, at = member.find(rolling(hashes, g["size"], g["size"]))
        if not len(where):
            return
        # every window that is looked up by this shingle
        many = g["many"][at]
        window = np.repeat(g["low"][at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        where = np.repeat(where, many)
        row = rows[where]
        start = where - g["offset"][window]
        # the place must lie between the ends of the document
        fits = (start >= words.first[row]) & (start + g["length"] <= words.first[row + 1])
        start, window, row = start[fits], window[fits], row[fits]
        same = rolling(hashes, g["length"], 1000 + g["length"])[start] == g["whole"][window]
        for s, w, r in zip(start[same].tolist(), window[same].tolist(), row[same].tolist(), strict=True):
            if words.bytes_of(s, s + g["length"]) == g["text"][w]:
                yield r, s - int(words.first[r]), int(g["owner"][w])

    def _out(self, part, words, spans, items):
        hits, names = [], []
        held = zip(part.column("hits").to_pylist(), part.column("items").to_pylist(), strict=True)
        for row, (old, known) in enumerate(held):
            if not spans[row]:
                hits.append(old)
                names.append(known)
                continue
            both = json.loads(old or b"[]") + spans[row]
            hits.append(json.dumps(_union(both)).encode())
            names.append(json.dumps(sorted(set(json.loads(known)) | {self.index.names[i] for i in items[row]})))
        columns = {name: part.column(name) for name in part.schema.names}
        columns["n_words"] = pa.array(words.counts.astype(np.int64))
        columns["hits"] = pa.array(hits, pa.binary())
        columns["items"] = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _union(spans: list) -> list:
    out = []
    for low, high in sorted(tuple(s) for s in spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out
