"""Token counts that follow edits.

A document is kept as a segment tree: its leaves are stretches of whole pre-tokens with
their characters and tokens, its inner nodes the sums of their subtrees. An edit finds its
leaves by descending over character sums, re-encodes the stretch between the last border
before it and the first border after it that the edit cannot have moved, and updates the sums on the
way up. The rest of the document is not encoded again.

A border stands behind a letter of any script, before a space with a letter behind it or before a mark of punctuation (but
no apostrophe). The pre-token pattern of the byte-level vocabularies ends a pre-token there whatever else the
text holds, and looks at no other character to do so; so a border stays one unless the edit touches one of the three
characters. Text without spaces, as of Chinese or Japanese, has borders at its punctuation.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import bounded, slices

# The pre-token pattern of the byte-level vocabularies: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Characters of a leaf, about.
LEAF = 256
# A leaf that edits have made so many times longer is cut again.
OVERLONG = 8

# Letters and marks that all versions of the character tables agree on: fixed values.
_LETTER = (
    r"[\p{L}&&[A-Za-z\u00C0-\u024F\u0386-\u0523\u0531-\u0587\u05D0-\u05EA\u0620-\u064A\u0905-\u0939"
    r"\u0E01-\u0E30\u10D0-\u10F6\u1E00-\u1EF9\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]]"
)
_MARK = r"[!-&(-/:-@\[-`{-~\u060C\u061F\u0964\u2013\u2014\u2026\u3001\u3002\u300C\u300D\uFF01\uFF0C\uFF1A\uFF1B\uFF1F]"
BORDER = regex.compile(rf"(?V1)(?<={_LETTER})(?: (?={_LETTER})|{_MARK})")


class Vocabulary:
    """A tokenizer from the lines of a rank file; travels as those lines and is built once in a process."""

    _built: dict = {}

    def __init__(self, lines: bytes):
        self.lines = lines

    @classmethod
    def read(cls, path: str = VOCABULARY) -> Vocabulary:
        """A published rank file, read once by the driver."""
        with open(path, "rb") as file:
            return cls(file.read())

    def encoding(self) -> tiktoken.Encoding:
        key = hash(self.lines)
        if key not in self._built:
            pairs = (line.split() for line in self.lines.splitlines() if line)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
            self._built[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return self._built[key]


def leaves_of(text: str, leaf: int = LEAF) -> list[str]:
    """``text`` cut at the first border of every ``leaf`` characters; empty text has one empty leaf."""
    out, low, at = [], 0, 1
    while found := BORDER.search(text, at):
        cut = found.start()
        out.append(text[low:cut])
        low, at = cut, (cut // leaf + 1) * leaf
    return [*out, text[low:]]


class TokenTree:
    """Counts of one document."""

    def __init__(self, text: str, count, leaf: int = LEAF):
        self._count, self._leaf = count, leaf
        self.encoded = 0
        self._build(leaves_of(text, leaf))
        self.encoded = 0

    def _build(self, texts: list[str], tokens: list[int] | None = None):
        self.texts = texts
        size = 1 << max(0, len(texts) - 1).bit_length()
        self._base = size
        self._chars, self._tokens = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64)
        self._chars[size : size + len(texts)] = [len(t) for t in texts]
        self._tokens[size : size + len(texts)] = [self._encode(t) for t in texts] if tokens is None else tokens
        while size > 1:
            half = size // 2
            for sums in (self._chars, self._tokens):
                sums[half:size] = sums[size : 2 * size : 2] + sums[size + 1 : 2 * size : 2]
            size = half

    def _encode(self, text: str) -> int:
        self.encoded += len(text)
        return self._count(text)

    @property
    def tokens(self) -> int:
        return int(self._tokens[1])

    @property
    def length(self) -> int:
        return int(self._chars[1])

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds character ``at`` and the characters before it; the last leaf for the end."""
        node, before = 1, 0
        if at >= self.length:
            last = len(self.texts) - 1
            return last, self.length - len(self.texts[last])
        while node < self._base:
            node *= 2
            if at >= before + self._chars[node]:
                before += int(self._chars[node])
                node += 1
        return node - self._base, before

    def edit(self, start: int, stop: int, put: str) -> None:
        """Replace the characters from ``start`` to ``stop`` by ``put``; both are moved into the text if outside."""
        start = min(max(start, 0), self.length)
        stop = min(max(stop, start), self.length)
        # a border is kept if the characters before, at and after it stay
        low, before = self._find(max(start - 2, 0))
        high, upto = self._find(stop)
        if high + 1 < len(self.texts) and stop >= upto + len(self.texts[high]):
            high += 1
        old = "".join(self.texts[low : high + 1])
        new = old[: start - before] + put + old[stop - before :]
        self._replace(low, high, new)

    def _replace(self, low: int, high: int, text: str) -> None:
        parts = leaves_of(text, self._leaf)
        slots = high - low + 1
        if len(parts) > slots:
            parts[slots - 1 :] = ["".join(parts[slots - 1 :])]
        parts += [""] * (slots - len(parts))
        if len(parts[-1]) > OVERLONG * self._leaf and BORDER.search(parts[-1], 1):
            self._rebuild(low, high, text)
            return
        for i, part in enumerate(parts, low):
            if part != self.texts[i]:
                self._set(i, part)

    def _set(self, i: int, text: str) -> None:
        node = i + self._base
        chars = len(text) - int(self._chars[node])
        tokens = self._encode(text) - int(self._tokens[node])
        self.texts[i] = text
        while node:
            self._chars[node] += chars
            self._tokens[node] += tokens
            node //= 2

    def _rebuild(self, low: int, high: int, text: str) -> None:
        """Cut the new text into leaves of their own; the counts of the others are kept."""
        parts = leaves_of(text, self._leaf)
        known = self._tokens[self._base : self._base + len(self.texts)].tolist()
        self._build(
            [*self.texts[:low], *parts, *self.texts[high + 1 :]],
            [*known[:low], *map(self._encode, parts), *known[high + 1 :]],
        )


def counted(
    docs: DataFrame,
    edits: Column,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id``, ``n_tokens`` (of the text), ``n_edited`` (after all edits), ``n_chars`` and ``reencoded`` characters of every row.

    ``edits`` is an array of (start, stop, put), in characters of the text as the edits before it left it;
    positions outside the text mean its ends, a null ``put`` is empty and a null edit does nothing. A null text is empty. Repeated
    rows give repeated rows; other columns are not read.
    """
    rows = bounded(docs).select(F.col(id_column).alias("id"), F.col(text_column).alias("body"), edits.alias("edits"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_edited long, n_chars long, reencoded long"

    def run(batches):
        encode = vocabulary.encoding().encode_ordinary
        count = lambda text: len(encode(text)) if text else 0
        for part in slices(batches, "body"):
            out = [_follow(text, script, count) for text, script in _scripts(part)]
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *(pa.array(c, pa.int64()) for c in columns)],
                ["id", "n_tokens", "n_edited", "n_chars", "reencoded"],
            )

    return rows.mapInArrow(run, kind)


def _scripts(part: pa.RecordBatch) -> Iterable[tuple[str, list]]:
    return zip(part.column("body").to_pylist(), part.column("edits").to_pylist(), strict=True)


def _follow(text: str | None, script: list | None, count) -> tuple[int, int, int, int]:
    tree = TokenTree(text or "", count)
    before = tree.tokens
    for edit in script or ():
        if edit is not None:
            start, stop, put = edit.values()
            tree.edit(start or 0, stop or 0, put or "")
    return before, tree.tokens, tree.length, tree.encoded
