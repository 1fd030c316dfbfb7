"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell of source, language and topic. The cell weights are
raked to the target share of each marginal in turn until all hold, and documents are
drawn as often as the weight of their cell over its present share asks for: with a probability
up to one time, and several times if the cell holds less than its part of the budget.

Targets name the strata: a value without a target belongs to one common stratum, which keeps its
present share. So the number of cells is bounded by the targets, not by the corpus, and
no key is ever gathered: a source with a third of all rows is summed map-side like
any other.

Topics are learned: clusters of the texts by their longer words, found over all texts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from . import centroids
from .words import Words, bounded, mix, slices

TOPICS = 8
# Bytes of a word that says something of the topic, places of a text's vector, steps of a component, rounds of learning.
LONG_WORD = 8
DIMS = 64
SCALE = 1024
ROUNDS = 6
SEED = 3
REST = "(rest)"

SOURCE_TARGETS = {"src0": 0.24, **{f"src{i}": 0.04 for i in range(1, 20)}}
LANG_TARGETS = {"en": 0.55, "de": 0.15, "es": 0.15, "fr": 0.15}
TOPIC_TARGETS = {f"topic{i}": 1 / TOPICS for i in range(TOPICS)}
# Learned topics differ in size: their targets are their present shares to this power, so small ones gain without being repeated much.
TEMPER = 0.7
# Tokens of the sample, repeats included, as a share of all tokens.
BUDGET = 0.6

AXES = ("source", "lang", "topic")


@dataclass
class Mix:
    """Factor of each cell (target over present share) and the scale that turns it into expected copies."""

    factors: dict[tuple[str, str, str], float]
    scale: float


def _vectors(column: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of each row, and its long words as a vector: each word counts for or against one of ``DIMS`` places."""
    words = Words(column)
    voters = np.flatnonzero(words.ends - words.starts >= LONG_WORD)
    bits = mix(words.hashes()[voters] ^ np.uint64(0xA5A5A5A5))
    place = (bits >> np.uint64(1)) % np.uint64(DIMS)
    sign = 2.0 * (bits & np.uint64(1)) - 1.0
    cell = words.row_of_word()[voters] * DIMS + place.astype(np.int64)
    x = np.bincount(cell, sign, words.rows * DIMS).reshape(-1, DIMS)
    # a word that a text repeats says less each time
    x = np.sign(x) * np.sqrt(np.abs(x))
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return words, np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def learn_topics(docs: DataFrame, text_column: str = "text", topics: int = TOPICS, rounds: int = ROUNDS) -> list[list[int]]:
    """Centroids of the texts' word vectors: ``topics`` clusters learned from all texts that have a long word.

    Texts are read once; the rounds read their vectors, which are written. Without such texts there are no topics.
    """
    rows = bounded(docs).select(F.xxhash64(text_column).alias("id"), F.col(text_column).alias("body")).where("body is not null")

    def run(batches):
        for part in slices(batches, "body"):
            _, x = _vectors(part.column("body"))
            full = np.flatnonzero(x.any(axis=1))
            offsets = pa.array(np.arange(len(full) + 1, dtype=np.int32) * DIMS)
            lists = pa.ListArray.from_arrays(offsets, pa.array(_steps(x[full]).ravel()))
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(full)), lists], ["id", "x"])

    points = materialize(rows.mapInArrow(run, "id long, x array<double>"), "vectors")
    return centroids.centred(points, topics, rounds, SEED)


def _steps(x: np.ndarray) -> np.ndarray:
    """Components in whole steps, which are the same wherever they are computed."""
    return np.floor(x.astype(np.float32).astype(np.float64) * SCALE)


def measured(docs: DataFrame, topics: list[list[int]] | None = None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (white-space separated words) and ``topic``.

    The topic is the nearest of the centroids ``topics``, learned from ``docs`` if not given. Null and empty texts have no
    tokens; they and texts without a long word have the first topic.
    """
    if topics is None:
        topics = learn_topics(docs, text_column)
    search = centroids.Search(topics) if topics else None
    names = [c for c in docs.columns if c not in ("n_tokens", "topic")]
    held = bounded(docs).select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    text = f"c{names.index(text_column)}"
    out = held.select("*", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("topic"))

    def run(batches):
        for part in slices(batches, text):
            words, x = _vectors(part.column(text))
            topic = np.zeros(words.rows, np.int64)
            full = x.any(axis=1)
            if search is not None and full.any():
                topic[full] = search.nearest(_steps(x[full]).astype(np.int64))[0]
            part = part.append_column("n_tokens", pa.array(words.counts.astype(np.int64)))
            yield part.append_column("topic", pa.array([f"topic{t}" for t in topic], pa.string()))

    done = held.mapInArrow(run, out.schema)
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "n_tokens", "topic")


def fit(rows: DataFrame, targets: Mapping[str, Mapping[str, float]], budget: float = BUDGET) -> Mix:
    """Rake the cells of ``rows`` (with ``n_tokens`` and the columns of ``targets``) to the targets.

    Targets of an axis are shares of the tokens that have one of its named values. A value without rows is
    left out and the others share its part. Without tokens every factor is 1.
    """
    strata = [_stratum(F.col(axis), targets[axis]).alias(axis) for axis in targets]
    cells = rows.groupBy(*strata).agg(F.sum("n_tokens").alias("n")).where("n > 0").collect()
    keys = [tuple(r[axis] for axis in targets) for r in cells]
    now = np.array([r["n"] for r in cells], float)
    if not len(now):
        return Mix({}, 1.0)
    now /= now.sum()
    weight = rake(keys, now, list(targets.values()))
    total = float(weight.sum())
    return Mix(dict(zip(keys, (weight / now).tolist(), strict=True)), budget / total if total else 1.0)


def rake(keys: list, now: np.ndarray, targets: list, rounds: int = 1000, tolerance: float = 1e-10) -> np.ndarray:
    """Cell weights whose sums along every axis are the targets, nearest to ``now``."""
    weight = now.copy()
    axes = []
    for axis, target in enumerate(targets):
        names, code = np.unique([k[axis] for k in keys], return_inverse=True)
        present = np.bincount(code, now)
        want = np.array([target.get(n, 0.0) if n != REST else 0.0 for n in names])
        rest = present[names == REST].sum()
        want = want / want.sum() * (1 - rest) if want.sum() else np.zeros(len(names))
        want[names == REST] = rest
        # a value whose target is zero has no tokens to give
        axes.append((code, want if want.sum() else present))
    for _ in range(rounds):
        worst = 0.0
        for code, want in axes:
            have = np.bincount(code, weight)
            ratio = np.divide(want, have, out=np.zeros(len(want)), where=have > 0)
            worst = max(worst, np.abs(have - want).max())
            weight = weight * ratio[code]
        if worst < tolerance:
            break
    return weight


def _stratum(column: Column, target: Mapping[str, float]) -> Column:
    return F.when(column.isin(*target), column).otherwise(F.lit(REST))


def sample(
    rows: DataFrame,
    mixed: Mix,
    axes: tuple[str, ...] = AXES,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    id_column: str = "doc_id",
    epochs: float | None = None,
) -> DataFrame:
    """``rows`` with ``probability``, ``selected``, ``weight`` and ``copies``, which replace columns of these names.

    ``copies`` is how often a row is in the sample, probability x weight on average: a cell that holds less than
    its part of the budget is repeated, so the shares of the sample are the targets. Nothing bounds that but ``epochs``, if
    given: no row is then in the sample more often on average, and ``reached`` shows which targets that leaves open. It follows from a
    hash of the id, so repeated rows share one decision. A cell without tokens is kept whole.
    """
    targets = targets or production_targets()
    table = rows.sparkSession.createDataFrame(
        [(*k, f) for k, f in mixed.factors.items()], ", ".join(f"k{i} string" for i in range(len(axes))) + ", factor double"
    )
    made = ("probability", "selected", "weight", "copies")
    names = [c for c in rows.columns if c not in made]
    # under names of its own, so that no column of the rows is taken for one of the cells
    held = rows.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)),
        *(_stratum(F.col(axis), targets[axis]).alias(f"k{i}") for i, axis in enumerate(axes)),
    )
    # one row per cell, bounded by the targets
    joined = held.join(F.broadcast(table), [f"k{i}" for i in range(len(axes))], "left")
    raw = F.coalesce(F.col("factor") * mixed.scale, F.lit(1.0))
    if epochs is not None:
        raw = F.least(raw, F.lit(float(epochs)))
    draw = F.pmod(F.xxhash64(F.col(f"c{names.index(id_column)}"), F.lit("mixing")), F.lit(1 << 52)) / float(1 << 52)
    chance = F.least(raw, F.lit(1.0))
    copies = F.floor(raw) + (draw < raw - F.floor(raw)).cast("long")
    return joined.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(names)),
        chance.alias("probability"),
        (draw < chance).alias("selected"),
        F.greatest(raw, F.lit(1.0)).alias("weight"),
        copies.alias("copies"),
    )


def reached(drawn: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``axis``, ``value``, its ``target`` and its ``share`` of the sample's tokens among the named values of the axis: a row per target."""
    spark = drawn.sparkSession
    tokens = F.sum(F.col("n_tokens") * F.col("copies"))
    cells = drawn.groupBy(*[_stratum(F.col(axis), targets[axis]).alias(axis) for axis in targets]).agg(tokens.alias("n"))
    # a row per cell, bounded by the targets
    cells = [(r.asDict(), float(r["n"] or 0)) for r in cells.collect()]
    rows = []
    for axis, target in targets.items():
        sums = {value: sum(n for cell, n in cells if cell[axis] == value) for value in target}
        whole = sum(sums.values())
        rows += [(axis, value, share, sums[value] / whole if whole else 0.0) for value, share in target.items()]
    return spark.createDataFrame(rows, "axis string, value string, target double, share double")


def repeated(drawn: DataFrame) -> DataFrame:
    """The sample itself: each row of ``drawn`` as often as its ``copies`` say."""
    keep = [F.col(f"`{c}`") for c in drawn.columns]
    return drawn.where("copies > 0").select(*keep, F.explode(F.sequence(F.lit(1), "copies")).alias("__copy")).drop("__copy")


def tempered(rows: DataFrame, axis: str, names, power: float = TEMPER) -> dict[str, float]:
    """Present shares of tokens of the named values of an axis, to a power, adding up to 1; equal ones where there are no tokens."""
    # a row per name
    sums = dict(rows.where(F.col(axis).isin(*names)).groupBy(axis).agg(F.sum("n_tokens")).collect())
    raw = {n: float(sums.get(n) or 0) ** power for n in names}
    whole = sum(raw.values())
    return {n: v / whole if whole else 1 / len(raw) for n, v in raw.items()}


def production_targets(rows: DataFrame | None = None) -> dict[str, dict[str, float]]:
    """The targets of the registered query; those of the topics follow from ``rows`` if given."""
    topics = TOPIC_TARGETS if rows is None else tempered(rows, "topic", list(TOPIC_TARGETS))
    return {"source": SOURCE_TARGETS, "lang": LANG_TARGETS, "topic": topics}
