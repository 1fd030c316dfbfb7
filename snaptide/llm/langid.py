"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier per bit sees the byte
n-grams of a text and gives the mean log-odds that the bit is set. A text gets the
language whose codeword loses least against these margins, every bit weighted by how
well its classifier separates the learned languages; a text whose two best languages lose about
alike is flagged as ambiguous. Codewords differ in many bits, so single
classifiers may be wrong.

The classifiers are learned from n-gram counts per language, summed over all documents
that may be learned from. The counts have ``2 ** BITS`` places per language, so the
model does not grow with the corpus. They stay in Spark: the odds are made block by block of their places, and the
driver gets a total per language, the odds of each bit and how they separate the languages. So a column with
thousands of values is learned in bounded memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .words import ALNUM, LOWER, Text, bounded, slices

BITS = 16
SIZES = (2, 3)
# Places of a count vector that travel in one row and are fitted together, and languages counted at a time.
BLOCK = 1 << 9
AT_ONCE = 32
# Languages up to which every division into two sets is a bit; beyond, so many bits per doubling.
EXHAUSTIVE = 5
BITS_PER_DOUBLING = 12
# Random codes of which the one with the nearest rows farthest apart is taken.
TRIES = 200
# Ratio of losses from which the second best counts as near.
AMBIGUOUS = 0.9
# How fast the score falls with the distance to the next best language.
SHARPNESS = 8.0
UNKNOWN = "und"

_LETTER = ALNUM.copy()
_LETTER[0x30:0x3A] = False
# Runs of other bytes count as a space.
_FOLD = np.where(_LETTER, LOWER, np.uint8(0x20)).astype(np.uint64)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    odds: np.ndarray  # bits x places
    trust: np.ndarray  # bits


def _grams(column: pa.Array):
    """Places of the n-grams of a slice and the byte each begins at; grams that cross rows are left out."""
    text = Text(column)
    value = _FOLD[text.data]
    size = len(value)
    left = np.repeat(text.bounds[1:], np.diff(text.bounds)) - np.arange(size)
    space = value == 0x20
    for n in SIZES:
        if size < n:
            continue
        gram = np.full(size - n + 1, np.uint64(n), np.uint64)
        for k in range(n):
            gram = (gram << np.uint64(8)) | value[k : size - n + 1 + k]
        place = ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
        # runs of other bytes shrink to one: a gram holds no two of them side by side
        good = left[: len(place)] >= n
        for k in range(n - 1):
            good &= ~(space[k : len(place) + k] & space[k + 1 : len(place) + k + 1])
        at = np.flatnonzero(good)
        yield text.bounds, at, place[at]


def fit(
    docs: DataFrame,
    learn: Column | None = None,
    lang_column: str = "lang",
    text_column: str = "text",
) -> Model:
    """Learn from all documents with a text and a language for which ``learn`` holds.

    Counts are combined per task before they are sent: a language with a third of all rows sends no more
    than any other. Without such documents the model knows no language.
    """
    rows = bounded(docs).where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    rows = rows if learn is None else rows.where(learn)
    rows = rows.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("body"))
    sums = rows.mapInArrow(_count, "lang string, block int, counts array<long>")
    cells = sums.select("lang", "block", F.posexplode("counts").alias("place", "n")).where("n > 0")
    cells = materialize(cells.groupBy("lang", "block", "place").agg(F.sum("n").alias("n")), "grams")
    # a row per language
    totals = {r["lang"]: r["n"] for r in cells.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], codewords(0), np.zeros((0, 1 << BITS), np.float32), np.ones(0))
    code = codewords(len(languages))
    block = _Block(languages, np.array([totals[name] for name in languages], float), code)
    odds = np.zeros((code.shape[1], 1 << BITS), np.float32)
    means = np.zeros((len(languages), code.shape[1]))
    blocks = range((1 << BITS) // BLOCK)
    # a plain function of a frame: of an object Spark would count itself as an argument
    fitted = cells.groupBy("block").applyInPandas(lambda rows: block(rows), "block int, odds binary, means binary")
    # one block is in the driver at a time; one without any n-gram is as smoothing leaves it
    rest = block.fitted(np.zeros((len(languages), BLOCK)))
    made = dict.fromkeys(blocks)
    for row in materialize(fitted, "fitted").orderBy("block").toLocalIterator():
        part = np.frombuffer(row["odds"], np.float32).reshape(-1, BLOCK)
        odds[:, row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = part
        means += np.frombuffer(row["means"]).reshape(means.shape)
        made.pop(row["block"])
    for left in made:
        odds[:, left * BLOCK : (left + 1) * BLOCK] = rest[0]
        means += rest[1]
    # distance of the nearest learned languages on the two sides of each bit
    trust = np.ones(code.shape[1])
    for b in range(code.shape[1]):
        on, off = code[:, b] > 0, code[:, b] < 0
        if on.any() and off.any():
            trust[b] = max(means[on, b].min() - means[off, b].max(), 1e-3)
    return Model(languages, code, odds, trust / trust.sum())


class _Block:
    """Odds of every bit at a block of places, and the mean odds of every language there."""

    def __init__(self, languages: list[str], totals: np.ndarray, code: np.ndarray):
        self.number = {name: i for i, name in enumerate(languages)}
        # every language counts alike, however many documents it has
        self.sums, self.code = totals + 0.5 * (1 << BITS), code

    def fitted(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share = (counts + 0.5) / self.sums[:, None]
        odds = np.zeros((self.code.shape[1], counts.shape[1]), np.float32)
        for b in range(len(odds)):
            on, off = self.code[:, b] > 0, self.code[:, b] < 0
            if on.any() and off.any():
                odds[b] = np.log(share[on].mean(axis=0) / share[off].mean(axis=0))
        return odds, share @ odds.T.astype(float)

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(self.sums), BLOCK))
        counts[rows["lang"].map(self.number), rows["place"]] = rows["n"]
        odds, means = self.fitted(counts)
        return pd.DataFrame({"block": rows["block"].iloc[:1], "odds": [odds.tobytes()], "means": [means.tobytes()]})


def _count(batches):
    """Counts of each language, added up over the task for as many languages at a time as it may hold."""
    totals: dict[str, np.ndarray] = {}
    for part in slices(batches, "body"):
        langs = part.column("lang").to_pylist()
        names, code = np.unique(np.array(langs, object).astype(str), return_inverse=True)
        grams = list(_grams(part.column("body")))
        for low in range(0, len(names), AT_ONCE):
            own = names[low : low + AT_ONCE]
            both = np.zeros((len(own), 1 << BITS), np.int64)
            for bounds, at, place in grams:
                row = code[np.repeat(np.arange(part.num_rows), np.diff(bounds))[at]] - low
                here = (row >= 0) & (row < len(own)) if len(names) > AT_ONCE else slice(None)
                cells = row[here] * (1 << BITS) + place[here]
                both += np.bincount(cells, minlength=len(own) << BITS).reshape(len(own), -1)
            if len(totals.keys() | set(own.tolist())) > AT_ONCE:
                yield from _sent(totals)
                totals = {}
            for name, counts in zip(own.tolist(), both, strict=True):
                totals[name] = totals.get(name, 0) + counts
    yield from _sent(totals)


def _sent(totals: dict[str, np.ndarray]):
    for name, own in totals.items():
        blocks = own.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * len(some), pa.string()),
                pa.array(some, pa.int32()),
                pa.array(list(blocks[some]), pa.list_(pa.int64())),
            ],
            ["lang", "block", "counts"],
        )


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language; no column is constant, no two rows are equal."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        columns = np.arange((1 << (languages - 1)) - 1)
        return np.array([[1 if r == 0 else 2 * (c >> (r - 1) & 1) - 1 for c in columns] for r in range(languages)])
    width = int(np.ceil(BITS_PER_DOUBLING * np.log2(languages)))
    best, far = None, -1
    for seed in range(TRIES):
        code = np.random.RandomState(seed).choice([-1, 1], (languages, width))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        # bits in which two rows differ, from their product
        apart = (code.shape[1] - code.astype(np.float32) @ code.T.astype(np.float32)) / 2 + width * np.eye(languages, dtype=np.float32)
        if apart.min() > far:
            best, far = code, apart.min()
    return best


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` of every row, from the whole text alone.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text when no language was
    learned. Repeated rows are predicted alike; other columns are not read.
    """
    texts = bounded(docs).select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        F.col(text_column).alias("body"),
    )
    schema = texts.select("id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous")).schema

    def run(batches):
        for part in slices(batches, "body"):
            names, scores, near = decode(model, margins(model, part.column("body")))
            lettered = part.column("lettered").to_numpy(zero_copy_only=False) & bool(model.languages)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(np.where(lettered, names, UNKNOWN).tolist(), pa.string()),
                    pa.array(np.where(lettered, scores, 0.0)),
                    pa.array(near & lettered),
                ],
                ["id", "lang_pred", "score", "ambiguous"],
            )

    return texts.mapInArrow(run, schema)


def margins(model: Model, column: pa.Array) -> np.ndarray:
    """Mean log-odds of each bit over the n-grams of each row."""
    total = np.zeros((len(column), len(model.trust)))
    grams = np.zeros(len(column))
    for bounds, at, place in _grams(column):
        cuts = np.searchsorted(at, bounds)
        grams += np.diff(cuts)
        some = np.flatnonzero(np.diff(cuts))
        if len(some):
            for b, odds in enumerate(model.odds):
                total[some, b] += np.add.reduceat(odds[place], cuts[some], dtype=np.float64)
    return total / np.maximum(grams, 1)[:, None]


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language with the least weighted logistic loss, its share among all, and whether another is near."""
    rows = len(margin)
    if not model.languages:
        return np.full(rows, UNKNOWN), np.zeros(rows), np.zeros(rows, bool)
    # the loss of a bit is log(1 + exp(-margin)) where it is set, and that plus the margin where it is not
    weighted = margin * model.trust
    loss = (np.logaddexp(0, -margin) @ model.trust)[:, None] + weighted @ (model.code < 0).T
    order = np.sort(loss, axis=1)
    near = order[:, 0] > AMBIGUOUS * order[:, 1] if loss.shape[1] > 1 else np.zeros(rows, bool)
    weight = np.exp(-SHARPNESS * (loss - order[:, :1]))
    return np.array(model.languages)[loss.argmin(axis=1)], 1.0 / weight.sum(axis=1), near
