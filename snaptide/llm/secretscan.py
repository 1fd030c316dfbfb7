"""Secrets in text: fixed patterns, and strings that look drawn at random.

The patterns find assignments, access keys and long hexadecimal runs. Beside them, every long token is
scored by two character Markov models, one of random strings and one of ordinary identifiers: it is a
secret if the logarithm of the ratio of its two likelihoods reaches ``ODDS``. The models are learned
from labelled samples; in a corpus, the values the patterns find are samples of random strings, and
all other tokens and names put together from them are samples of identifiers.

Counts of character triples are summed in each task and then in Spark, over all samples; the
table has a fixed number of places, so the model can be sent to every task.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, bounded, slices

# --- fixed values: the patterns, the shortest value of each, and the order of kinds ---
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SHORTEST = {"assign": 6, "access": 20, "hex": 24}
# --- end of fixed values ---

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = re.compile(rf"[{re.escape(ALPHABET)}]+")
_LETTER = re.compile(r"[A-Za-z]")
# Tokens shorter than this, or without a letter, are never scored; too short ones teach nothing.
LONG = 16
TAUGHT = 4
# A million ordinary long tokens for each secret: what the ratio of likelihoods has to outweigh.
ODDS = math.log(1e6)
# Weight of the shorter context in that of the longer, in samples; part of random strings that is drawn evenly, and part
# of identifiers of which only the kinds of characters are taken as known.
BACK = 4.0
UNIFORM = 0.5
UNKNOWN = 0.25

_EDGE = len(ALPHABET)
_SYMBOLS = _EDGE + 1
_CODE = np.full(128, _EDGE, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(_EDGE)
_BYTE_CODE = np.append(_CODE, np.full(128, _EDGE)).astype(np.int32)
# capital, small letter, digit, sign, edge
_CLASS = np.array([0] * 26 + [1] * 26 + [2] * 10 + [3] * 5 + [4])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the patterns that are long enough: kind, start and end, by start and then kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= SHORTEST["hex"]]
    return sorted(found, key=_place)


def _place(span):
    return span[1], KINDS.index(span[0]), span[2]


def _values(text: str) -> list[str]:
    """The secret parts of what the patterns find."""
    found = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    return found + [text[a:b] for kind, a, b in base_spans(text) if kind != "assign"]


_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_INSIDE = np.zeros(256, bool)
_INSIDE[[ord(c) for c in ALPHABET]] = True
_HINTS = (b"passw", b"secret", b"token", b"api_key", b"apikey")


class Tokens(Words):
    """The tokens of each row of a column, and in ``spans`` what the patterns find in the rows that have any."""

    def __init__(self, column: pa.Array):
        super().__init__(column, _INSIDE)
        hexes = Words(column, _HEX)
        long = hexes.ends - hexes.starts >= SHORTEST["hex"]
        maybe = set(hexes.row_of_word()[long].tolist())
        # what cannot match is told from bytes, so that the patterns read few texts
        plain = self.data.tobytes()
        low = plain.lower()
        for word, held in ((b"AKIA", plain), *((hint, low) for hint in _HINTS)):
            at = held.find(word)
            while at >= 0:
                row = int(np.searchsorted(self.bounds, at, "right")) - 1
                maybe.add(row)
                at = held.find(word, int(self.bounds[row + 1]))
        self.spans = {}
        self.texts = {}
        # bytes of each row that a span covers, as ranges that do not meet
        self.covered = []
        for row in sorted(maybe):
            text = self.row(row).decode()
            spans = base_spans(text)
            if spans:
                self.spans[row], self.texts[row] = spans, text
                first = int(self.bounds[row])
                for start, end in _merged(spans):
                    self.covered.append((first + len(text[:start].encode()), first + len(text[:end].encode())))

    def row(self, row: int) -> bytes:
        return self.data[self.bounds[row] : self.bounds[row + 1]].tobytes()

    def free(self, least: int) -> np.ndarray:
        """Tokens of at least ``least`` characters that no span touches."""
        keep = self.ends - self.starts >= least
        for start, end in self.covered:
            first = np.searchsorted(self.ends, start, "right")
            keep[first : np.searchsorted(self.starts, end)] = False
        return np.flatnonzero(keep)

    def triples(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every triple of the chosen tokens in the table, and the token (by its rank) it belongs to."""
        starts, ends = self.starts[chosen], self.ends[chosen]
        # each token with two edges before it and one behind
        sizes = ends - starts + 3
        owner = np.repeat(np.arange(len(chosen)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) - 2
        inside = (at >= 0) & (at < (sizes - 3)[owner])
        codes = np.full(len(owner), _EDGE, np.int32)
        codes[inside] = _BYTE_CODE[self.data[(starts[owner] + at)[inside]]]
        place = (codes[:-2] * _SYMBOLS + codes[1:-1]) * _SYMBOLS + codes[2:]
        whole = at[2:] >= 0
        return place[whole], owner[2:][whole]


def _merged(spans):
    out = []
    for _, start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def learn(docs: DataFrame, text_column: str = "text") -> Markov:
    """Models learned from all texts of a corpus, with the labels that the patterns give.

    Every value the patterns find is a random string, every other token of ``TAUGHT`` characters or more an identifier, and so
    is what ``names`` puts together from the different words of a stretch of text.
    """
    rows = bounded(docs).select(F.col(text_column).alias("text")).where("text is not null")
    return _model(rows.mapInArrow(_count_texts, _COUNTS))


def _count_texts(batches):
    table = np.zeros((2, _SYMBOLS**3))
    for batch in slices(batches, "text"):
        tokens = Tokens(batch.column("text"))
        table[1] += _table([v for text in tokens.texts.values() for v in _values(text)])
        free = tokens.free(TAUGHT)
        table[0] += np.bincount(tokens.triples(free)[0], minlength=_SYMBOLS**3)
        _, first = np.unique(tokens.hashes()[free], return_index=True)
        words = [tokens.bytes_of(i, i + 1).decode() for i in free[np.sort(first)]]
        table[0] += _table(list(names([w for w in words if w.isalpha()])))
    yield _nonzero(table)


def _table(values: list[str]) -> np.ndarray:
    return np.bincount(_triples(values)[0], minlength=_SYMBOLS**3)


def names(words: list[str]):
    """Names of three words each, written in the ways of programs, paths and keys by turns."""
    for i in range(0, len(words) - 2, 3):
        one, two, three = words[i : i + 3]
        low = [w.lower() for w in (one, two, three)]
        yield (
            "_".join(low),
            "-".join(low),
            "/".join(low),
            low[0] + two.capitalize() + three.capitalize(),
            one.capitalize() + two.capitalize() + three.capitalize(),
            "_".join(low).upper(),
            f"{low[0]}_{low[1]}_{i % 100}",
        )[i // 3 % 7]


def _codes(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all values, two edges before each and one behind it, and where the values begin."""
    joined = "".join("\0\0" + v + "\0" for v in values)
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *(len(v) + 3 for v in values)])
    return np.where(raw < 128, _CODE[np.minimum(raw, 127)], _EDGE), starts


def _triples(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Place of every triple of symbols in the table, and the value it belongs to; none goes from one value to the next."""
    codes, starts = _codes(values)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = (codes[:-2] * _SYMBOLS + codes[1:-1]) * _SYMBOLS + codes[2:]
    owner = np.repeat(np.arange(len(values)), np.diff(starts))[: len(place)]
    inside = np.ones(len(place), bool)
    # the two triples that begin with the end of a value
    for back in (1, 2):
        at = starts[1:] - back
        inside[at[at < len(place)]] = False
    return place[inside], owner[inside]


@dataclass
class Markov:
    """Log-likelihood ratio of random string to identifier, by triple of symbols."""

    ratio: np.ndarray

    def scores(self, values: list[str]) -> np.ndarray:
        place, owner = _triples(values)
        return np.bincount(owner, self.ratio[place], minlength=len(values))


def fit(labelled: DataFrame) -> Markov:
    """Models learned from ``value``, ``random`` and ``n`` of all rows.

    A triple's chance is smoothed by that of its last two symbols, and this by that of the last. Random strings are
    drawn half from what was learned and half evenly, so that those in an alphabet no sample has are likely, too. Of a part of
    identifiers only the classes of characters follow each other as learned, so that words of a language no sample is in are ordinary.
    Rows without a value or a label teach nothing; without any row no string is told from another.
    """
    rows = labelled.where("value is not null and random is not null and n > 0").select("value", "random", "n")
    return _model(rows.mapInArrow(_count, _COUNTS))


_COUNTS = "random boolean, place int, n double"


def _model(counts: DataFrame) -> Markov:
    # a row per triple of symbols at most
    table = np.zeros((2, _SYMBOLS**3))
    for random, place, n in counts.groupBy("random", "place").agg(F.sum("n").alias("n")).collect():
        table[int(random), place] = n
    if not table.any():
        return Markov(np.zeros(_SYMBOLS**3))
    named, drawn = (_chances(t.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)) for t in table)
    named = (1 - UNKNOWN) * named + UNKNOWN * _classes(table[0].reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS))
    even = np.full_like(drawn, 1 / _SYMBOLS)
    drawn = (1 - UNIFORM) * drawn + UNIFORM * even if table[1].any() else even
    return Markov((np.log(drawn) - np.log(named)).ravel())


def _chances(counts: np.ndarray) -> np.ndarray:
    """Chance of the third symbol after the first two."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = counts.sum(axis=0)
    two = (two + BACK * one) / (two.sum(axis=1, keepdims=True) + BACK)
    return (counts + BACK * two) / (counts.sum(axis=2, keepdims=True) + BACK)


def _classes(counts: np.ndarray) -> np.ndarray:
    """Chance of the third symbol if only the classes of the first two are known."""
    size = _CLASS.max() + 1
    sums = np.zeros((size, size, size))
    np.add.at(sums, (_CLASS[:, None, None], _CLASS[None, :, None], _CLASS[None, None, :]), counts)
    sums += 1.0
    chance = sums / sums.sum(axis=2, keepdims=True) / np.bincount(_CLASS)
    return chance[_CLASS][:, _CLASS][:, :, _CLASS]


def _count(batches):
    """Triples of each kind of sample, added up over the whole task."""
    table = np.zeros((2, _SYMBOLS**3))
    for batch in slices(batches, "value"):
        values, weight = batch.column("value").to_pylist(), batch.column("n").to_numpy()
        label = batch.column("random").to_numpy(zero_copy_only=False).astype(np.int64)
        place, owner = _triples(values)
        both = np.bincount(label[owner] * _SYMBOLS**3 + place, weight[owner], minlength=2 * _SYMBOLS**3)
        table += both.reshape(2, -1)
    yield _nonzero(table)


def _nonzero(table: np.ndarray) -> pa.RecordBatch:
    label, place = np.nonzero(table)
    return pa.RecordBatch.from_arrays(
        [pa.array(label.astype(bool)), pa.array(place.astype(np.int32)), pa.array(table[label, place])], ["random", "place", "n"]
    )


class _Scan:
    def __init__(self, model: Markov):
        self.model = model

    def __call__(self, batches):
        for batch in slices(batches, "text"):
            tokens = Tokens(batch.column("text"))
            found = [[(*s, None) for s in tokens.spans.get(row, ())] for row in range(tokens.rows)]
            long = tokens.free(LONG)
            place, owner = tokens.triples(long)
            scores = np.bincount(owner, self.model.ratio[place], minlength=len(long))
            rows = np.searchsorted(tokens.first, long, "right") - 1
            for i, row, score in zip(long.tolist(), rows.tolist(), scores.tolist(), strict=True):
                value = tokens.bytes_of(i, i + 1).decode()
                if score >= ODDS and _LETTER.search(value):
                    start = len(tokens.data[tokens.bounds[row] : tokens.starts[i]].tobytes().decode())
                    found[row].append(("markov", start, start + len(value), score))
            spans = [
                [dict(zip(("kind", "start", "stop", "score"), s, strict=True)) for s in sorted(f, key=_place)] for f in found
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, _SPANS)], ["id", "spans"])


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])
)


def scan(docs: DataFrame, model: Markov, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``spans`` of every row: kind, start, stop (exclusive, in code points) and, of scored tokens, the log ratio.

    Matches of the patterns all stay, also where those of different kinds overlap; a scored token touches none of
    them. A token of digits and signs only is a number, not a secret. A null or empty text has no spans. Whole texts are searched; repeated rows give repeated rows, a null id
    is kept, and other columns are not read.
    """
    rows = bounded(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}"
    return rows.mapInArrow(_Scan(model), f"{kind}, spans array<struct<kind:string,start:long,stop:long,score:double>>")


def joined(spans) -> F.Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of each pattern's matches, a hash of their places, and all spans as one string."""
    base = F.filter("spans", lambda s: s["kind"] != "markov")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(of(kind) for kind in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
