"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the presence of its words, of word pairs, of pairs with one
word between them, and of word stems (the first bytes of longer words, which catch
inflected forms). They are hashed into ``2 ** BITS`` places. Training keeps a rate per
coordinate and an L1 penalty that leaves few weights, so the model is a short
list of places and weights that every task can hold whatever the corpus.

The model is fitted on a bounded sample of labelled documents, all others are scored
over their whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .words import ALNUM, Words, bounded, mix, rolling, run_starts, slices

BITS = 20
STEMS = (5, 6, 7)
# At most so many labelled documents of each label are learned from.
SAMPLE = 2500
EPOCHS = 6
THRESHOLD = 0.7

LETTERS = ALNUM.copy()
LETTERS[0x30:0x3A] = False


@dataclass
class Model:
    """Non-zero weights by feature place, and the intercept."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.places] = self.weights
        return out


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32)


def features(column: pa.Array):
    """Kinds of features of a slice, one after the other: the row and the place of each occurrence."""
    words = Words(column, LETTERS, lower=True)
    hashes = words.hashes()
    rows = words.row_of_word()
    yield rows, _place(hashes)
    if len(hashes) >= 2:
        inside = run_starts(words.first, 2, len(hashes))
        yield rows[:-1][inside], _place(rolling(hashes, 2, 2))[inside]
    if len(hashes) >= 3:
        inside = run_starts(words.first, 3, len(hashes))
        skip = mix(hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[2:] + np.uint64(3))
        yield rows[:-2][inside], _place(skip)[inside]
    length = words.ends - words.starts
    value = np.full(len(hashes), np.uint64(7), np.uint64)
    live = np.arange(len(hashes))
    for at in range(max(STEMS)):
        live = live[length[live] > at]
        value[live] = (value[live] ^ words.data[words.starts[live] + at]) * np.uint64(0x100000001B3)
        if at + 1 in STEMS:
            longer = live[length[live] > at + 1]
            yield rows[longer], _place(mix(value[longer] + np.uint64(at)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    label: str = "toxic",
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> Model:
    """Learn ``label`` (0 or 1) from at most ``sample`` documents of each of its values.

    ``learn`` is a condition on the id of a label row. Of several labels of one document the
    largest counts, of several texts the smallest; null labels and ids are left out. Ids are whole numbers. Which documents are drawn
    follows from a hash of the id. Without a document of either label the model is constant.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y"))
    if learn is not None:
        known = known.where(learn.alias("learn") if id_column == "id" else learn)
    known = known.where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    texts = bounded(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    drawn = None
    for value in (0, 1):
        part = known.where(F.col("y") == value).orderBy(F.xxhash64("id"), "id").limit(sample)
        drawn = part if drawn is None else drawn.unionByName(part)
    # at most 2 * sample rows of an id and a label
    rows = texts.join(F.broadcast(drawn), "id").groupBy("id", "y").agg(F.min("body").alias("body"))
    # written first, so that the one task of the training reads the sample and not the documents
    packed = materialize(rows.mapInArrow(_pack, "id long, y int, places binary"), "sample")
    weights = packed.coalesce(1).mapInPandas(_train, "places binary, weights binary, bias double").first()
    if weights is None:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), -20.0)
    return Model(np.frombuffer(weights[0], np.int32), np.frombuffer(weights[1], np.float32), weights[2])


def _pack(batches):
    for part in slices(batches, "body"):
        found = [[] for _ in range(part.num_rows)]
        for rows, places in features(part.column("body")):
            cuts = np.searchsorted(rows, np.arange(part.num_rows + 1))
            for row in np.flatnonzero(np.diff(cuts)):
                found[row].append(places[cuts[row] : cuts[row + 1]])
        blobs = [np.unique(np.concatenate(f)).astype(np.int32).tobytes() if f else b"" for f in found]
        yield pa.RecordBatch.from_arrays(
            [part.column("id").cast(pa.int64()), part.column("y"), pa.array(blobs, pa.binary())], ["id", "y", "places"]
        )


def _train(frames):
    examples = []
    for frame in frames:
        examples += [(i, y, np.frombuffer(p, np.int32)) for i, y, p in frame.itertuples(index=False)]
    if not examples:
        return
    import pandas as pd

    # a fixed order that depends on the rows alone
    examples.sort(key=lambda e: (int(mix(np.array([e[0]], np.int64).view(np.uint64))[0]), e[0], e[1], e[2].tobytes()))
    places, weights, bias = ftrl([(y, p) for _, y, p in examples])
    yield pd.DataFrame(
        {"places": [places.tobytes()], "weights": [weights.astype(np.float32).tobytes()], "bias": [bias]}
    )


def ftrl(
    examples: list,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 6.0,
    l2: float = 0.5,
    epochs: int = EPOCHS,
    bits: int = BITS,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Follow-the-regularised-leader over (label, places of present features); the intercept is not penalised."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bz = bn = 0.0

    def weight(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for y, at in examples:
            zi, ni = z[at], n[at]
            w = weight(zi, ni)
            bw = -bz / ((beta + bn**0.5) / alpha + l2)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bw, -35, 35)))
            g = p - y
            root = np.sqrt(ni)
            after = np.sqrt(ni + g * g)
            z[at] = zi + g - (after - root) / alpha * w
            n[at] = ni + g * g
            bz += g - ((bn + g * g) ** 0.5 - bn**0.5) / alpha * bw
            bn += g * g
    w = weight(z, n)
    places = np.flatnonzero(w).astype(np.int32)
    return places, w[places], float(-bz / ((beta + bn**0.5) / alpha + l2))


def score(docs: DataFrame, model: Model, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``docs`` with ``score_column``, the probability of label 1, for every row; a null or empty text has the intercept's.

    The columns of ``docs`` pass through, whatever their names; a column called like the score is replaced.
    """
    names = [c for c in docs.columns if c != score_column]
    held = bounded(docs).select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    text = f"c{names.index(text_column)}"
    out = held.select("*", F.lit(0.0).alias("score"))

    def run(batches):
        dense = model.dense()
        for part in slices(batches, text):
            total = np.full(part.num_rows, model.bias)
            pairs = []
            for rows, places in features(part.column(text)):
                used = np.flatnonzero(dense[places])
                pairs.append(rows[used].astype(np.int64) << BITS | places[used])
            # a feature counts once in a text
            both = np.unique(np.concatenate(pairs))
            total += np.bincount(both >> BITS, dense[both & ((1 << BITS) - 1)], part.num_rows)
            value = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            yield part.append_column("score", pa.array(value))

    done = held.mapInArrow(run, out.schema)
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), F.col("score").alias(score_column))
