"""Main text of web pages: page furniture and site templates are removed.

A page is read once into blocks of text. Of those the article's count, or the main element's, or else the
body's. What a page does not say about itself is learned from its site: every element subtree that holds chosen text
is hashed, the hashes are counted per host over all pages with different texts, and a subtree that recurs is part of
the site's template and deleted. The rule is the same for hosts of any size. A subtree is a template from
``MIN_PAGES`` pages on; one that is prose of an article or main element (paragraphs, lists, tables, quotations) only if
three quarters of the host's pages have it, since articles quote each other and share titles. Copies of one article count once.

What a page does say: elements for scripts, controls and hidden text are never read. Navigation, headers, footers, asides,
forms, and elements whose role or class names furniture are left out, but never one around the
page's principal article or main element: a layout named after its sidebar, or a form around the whole page, is no furniture. A class or
id counts only if all its words name furniture or a place of the page, so ``share-prices`` or ``ad-free`` do not.

Pages are parsed into a written table of blocks and keys; the templates are joined to those pages that may hold
one, which a bit table of fixed size tells from the others.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from . import marks
from .words import bounded

# A template subtree recurs on so many different pages of its host; prose also on this share of them.
MIN_PAGES = 5
PROSE_SHARE = 0.75
BATCH_BYTES = 4 << 20

# Fixed values of HTML: elements without an end tag, with raw text, and inside a line of text.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Opening one of these ends an open one of the same group.
_SIBLINGS = {t: g for g in ("li", "dt dd", "option optgroup", "tr", "td th") for t in g.split()}
_SCOPES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table"}
_PROSE = set("p blockquote pre figure table ul ol dl".split())
# Parts of such prose and titles: they go with what they are part of.
_PARTS = set("h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead tfoot caption figcaption hgroup".split())

_DROPPED = set(
    "head script style button select textarea input iframe noscript svg canvas template dialog object embed audio video "
    "menu xmp title noembed noframes".split()
)
_FURNITURE = set("nav footer aside form header".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_COMMENTS = set("comment comments disqus replies respond".split())
_WORDS = _COMMENTS | set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager sidebar widget widgets related recommended share sharing social footer "
    "masthead toolbar cookie cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe "
    "subscription signup login search hidden skip header".split()
)
# What may stand beside them: places, shapes and things that furniture is made of.
_PLACES = set(
    "left right top bottom upper lower middle center inner outer side main primary secondary global local site page body "
    "content post posts article articles entry box block section area zone region bar strip row column col grid list items item "
    "link links button buttons icon icons image img text title label wrap wrapper container holder group panel unit slot frame "
    "card cards form field media mobile desktop sticky fixed floating dropdown toggle bottom footer head foot content js app "
    "layout blog news google facebook twitter email mail policy message".split()
)
_NEGATING = {"has", "with", "no", "without", "is", "not"}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


class _Open:
    __slots__ = ("tag", "start", "gone", "keyed", "kind", "soft")

    def __init__(self, tag, start, gone=False, keyed=False, kind=None, soft=False):
        self.tag, self.start, self.gone, self.keyed, self.kind, self.soft = tag, start, gone, keyed, kind, soft


class Page:
    """Blocks of a page, each with the subtrees, the articles and main elements, and the furniture it lies in."""

    def __init__(self, html: str, host: str):
        self.html, self.host = html, host
        # text, in an article, in a main element, subtrees, furniture
        self._blocks: list[tuple[str, bool, bool, tuple[int, ...], tuple[int, ...]]] = []
        self.subtrees: dict[int, int] = {}
        self._stack: list[_Open] = []
        self._pieces: list[str] = []
        self._gone = self._article = self._main = 0
        self._trees: list[int] = []
        self._soft: list[int] = []
        self._comments: set[int] = set()
        self._roots: list[int] = []
        # each article and main element: its kind, the furniture around it and the characters in it
        self._found: dict[int, list] = {}
        self._read()
        self.blocks = self._shown()

    def _read(self):
        html, at = self.html, 0
        match = _TOKEN.search(html)
        while match:
            if match.start() > at and not self._gone:
                self._pieces.append(html[at : match.start()])
            at = match.end()
            name = match[2] or match[5]
            if name:
                tag = name.lower()
                if match[1] or match[4]:
                    self._close(tag, match.start(), at)
                else:
                    at = self._opened(tag, match[3] or match[6] or "", match.start(), at)
            match = _TOKEN.search(html, at)
        if at < len(html) and not self._gone:
            self._pieces.append(html[at:])
        while self._stack:
            self._pop(len(html))
        self._flush()

    def _opened(self, tag: str, attributes: str, start: int, end: int) -> int:
        if tag in _RAW:
            # not shown, so it does not break the line around it
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(self.html, end)
            return close.end() if close else len(self.html)
        if tag not in _INLINE:
            self._flush()
            self._imply(tag, start)
        elif tag in ("br", "img", "wbr"):
            self._pieces.append(" " if tag == "br" else "")
        if tag in _VOID:
            return end
        if self._gone:
            # only the end of what is left out matters
            self._stack.append(_Open(tag, start))
            return end
        gone = tag in _DROPPED or bool(attributes) and _hidden(attributes)
        role = attributes and "main" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes)
        kind = None if gone else "article" if tag == "article" else "main" if role or tag == "main" else None
        keyed = not gone and kind is None and tag not in _INLINE and tag not in ("html", "body")
        if keyed and (self._article or self._main) and tag in _PARTS:
            keyed = False
        soft = False
        if not gone and tag not in ("html", "body"):
            soft = self._furniture(tag, attributes, start)
        top = _Open(tag, start, gone, keyed, kind, soft)
        self._stack.append(top)
        self._gone += gone
        if soft:
            self._soft.append(start)
        if kind:
            self._article += kind == "article"
            self._main += kind == "main"
            self._roots.append(start)
            self._found[start] = [kind, tuple(self._soft), 0]
        if keyed:
            self._trees.append(start)
        return end

    def _imply(self, tag: str, start: int):
        """End what the new element cannot be inside of."""
        group = _SIBLINGS.get(tag)
        if group:
            scope = _SCOPES.get(tag, "").split()
            for i in range(len(self._stack) - 1, -1, -1):
                if self._stack[i].tag in scope:
                    break
                if self._stack[i].tag in group.split():
                    while len(self._stack) > i:
                        self._pop(start)
                    break
        else:
            for i in range(len(self._stack) - 1, -1, -1):
                open_tag = self._stack[i].tag
                if open_tag == "p":
                    while len(self._stack) > i:
                        self._pop(start)
                    break
                if open_tag not in _INLINE:
                    break

    def _close(self, tag: str, start: int, end: int):
        if tag not in _INLINE:
            self._flush()
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i].tag == tag:
                while len(self._stack) > i:
                    self._pop(end if len(self._stack) == i + 1 else start)
                return
            # a stray end tag of a line does not end the block around it
            if tag in _INLINE and self._stack[i].tag not in _INLINE:
                return

    def _pop(self, end: int):
        top = self._stack[-1]
        if top.gone or top.tag not in _INLINE or top.soft:
            self._flush()
        self._stack.pop()
        self._gone -= top.gone
        if top.soft:
            self._soft.pop()
        if top.kind:
            self._roots.pop()
            self._article -= top.kind == "article"
            self._main -= top.kind == "main"
        if top.keyed:
            self._trees.pop()
            raw = self.html[top.start : end]
            key = xxhash.xxh64_intdigest(f"{self.host}\0{raw}".encode("utf-8", "replace"))
            # the last bit says what rule the subtree is under
            prose = top.tag in _PROSE and (self._article > 0 or self._main > 0)
            self.subtrees[top.start] = key & ~1 | prose

    def _flush(self):
        if self._pieces:
            text = " ".join(unescape("".join(self._pieces)).split())
            self._pieces = []
            if text and not self._gone:
                self._blocks.append((text, self._article > 0, self._main > 0, tuple(self._trees), tuple(self._soft)))
                for root in self._roots:
                    self._found[root][2] += len(text)

    def _furniture(self, tag: str, attributes: str, start: int) -> bool:
        inside = self._article > 0
        found = tag in _FURNITURE and not (tag == "header" and inside)
        for name, value in _NAMED.findall(attributes) if attributes else ():
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role" and value in _ROLES:
                found = True
            if name in ("class", "id"):
                for whole in value.split():
                    words = [w for w in _SPLIT.split(whole) if w]
                    if not words or words[0] in _NEGATING:
                        continue
                    named = {w for w in words if w in _WORDS and not (w == "header" and inside)}
                    if named and all(w in named or w in _PLACES or len(w) < 3 or w.isdigit() for w in words):
                        found = True
                        if named & _COMMENTS:
                            self._comments.add(start)
        if found and tag in _INLINE:
            self._flush()
        return found

    def _shown(self) -> list[tuple[str, bool, bool, tuple[int, ...]]]:
        """Blocks outside furniture. What is around the principal article or main element is none, nor, in a page without
        either, what holds more than half of its text (comments apart)."""
        largest = {k: max((s for s, f in self._found.items() if f[0] == k), key=lambda s: self._found[s][2], default=None) for k in ("article", "main")}
        principal = largest["article"]
        if largest["main"] is not None and (principal is None or 2 * self._found[principal][2] < self._found[largest["main"]][2]):
            principal = largest["main"]
        if principal is not None:
            kept = set(self._found[principal][1])
        else:
            sizes: dict[int, int] = {}
            for block in self._blocks:
                for soft in block[4]:
                    sizes[soft] = sizes.get(soft, 0) + len(block[0])
            whole = sum(len(b[0]) for b in self._blocks)
            kept = {s for s, n in sizes.items() if 2 * n > whole and s not in self._comments}
        return [b[:4] for b in self._blocks if kept.issuperset(b[4])]

    def chosen(self) -> list[tuple[str, tuple[int, ...]]]:
        """Blocks of the articles, if they hold half of the main element or there is none; else of the main element, or of the body."""
        article = [b for b in self.blocks if b[1]]
        main = [b for b in self.blocks if b[2]]
        if article and 2 * sum(len(b[0]) for b in article) >= sum(len(b[0]) for b in main):
            main = []
        own = main or article or self.blocks
        return [(b[0], b[3]) for b in own]

    def keyed(self) -> list[tuple[str, list[int]]]:
        """Chosen blocks with the hashes of the subtrees they lie in."""
        return [(text, [self.subtrees[t] for t in trees]) for text, trees in self.chosen()]

    def text(self, template: set[int] = frozenset()) -> str:
        return "\n\n".join(text for text, keys in self.keyed() if template.isdisjoint(keys))


def _hidden(attributes: str) -> bool:
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def host_of(url: str | None) -> str:
    """Host of a URL in lower case, without user and port; empty if there is none."""
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _small(batches):
    """Cut batches to a bounded number of bytes, one row at least."""
    for batch in batches:
        step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes)))
        for low in range(0, batch.num_rows, step):
            yield batch.slice(low, step)


_PARSED = "host long, content long, texts array<string>, keys array<array<long>>"


def _parse(batches):
    """The host, a hash of the text, and the chosen blocks with their subtrees, of each page."""
    for batch in _small(batches):
        hosts, contents, texts, keys = [], [], [], []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(html or "", host_of(url))
            blocks = [(t.encode("utf-8", "replace").decode(), [_signed(k) for k in own]) for t, own in page.keyed()]
            texts.append([t for t, _ in blocks])
            keys.append([own for _, own in blocks])
            hosts.append(_signed(xxhash.xxh64_intdigest(page.host)))
            contents.append(_signed(xxhash.xxh64_intdigest("\n\n".join(texts[-1]).encode())))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64())))
        arrays = [pa.array(v, k) for v, k in zip((hosts, contents, texts, keys), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), batch.column("page_key"), *arrays],
            ["id", "url", "page_key", "host", "content", "texts", "keys"],
        )


def templates(parsed: DataFrame) -> DataFrame:
    """Keys of the subtrees that recur across the pages of a host: column ``key``.

    Pages of a host with the same text count once. A host is summed map-side, however many pages it has.
    """
    whole = F.array(F.lit(None).cast("long"))
    asked = F.explode(F.concat(whole, F.array_distinct(F.flatten("keys")))).alias("key")
    seen = parsed.select("host", asked, "content").distinct()
    counts = seen.groupBy("host", "key").agg(F.count("*").alias("n"))
    counts = materialize(counts.where((F.col("n") >= MIN_PAGES) | F.col("key").isNull()), "subtrees")
    hosts = counts.where("key is null").select("host", F.col("n").alias("pages"))
    often = counts.where("key is not null").join(hosts, "host")
    prose = F.col("key").bitwiseAND(F.lit(1)) == 1
    often = often.where(~prose | (F.col("n") >= PROSE_SHARE * F.col("pages")))
    return materialize(often.select("key").distinct(), "templates")


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: ``id``, ``url``, ``text`` and ``n_chars``.

    Blocks are joined by an empty line; white space in a block is one space and character references are decoded. A
    null or empty page, or one of furniture only, has the empty text. A null url, or one without a host, belongs to a
    site of its own. Unclosed and stray tags end where their parent ends. Repeated pages give
    repeated rows; other columns are not read.
    """
    rows = bounded(pages).select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        F.col(html_column).alias("html"),
        F.xxhash64(html_column, url_column).alias("page_key"),
    )
    kind = f"id {rows.schema['id'].dataType.simpleString()}, url string, page_key long"
    parsed = materialize(rows.mapInArrow(_parse, f"{kind}, {_PARSED}"), "blocks")
    known = templates(parsed)
    may = _Marked(marks.table(known, F.pmod("key", F.lit(marks.BITS))))
    # subtrees that may be a template, of the pages that have any
    asked = parsed.select("page_key", "keys").mapInArrow(may, "page_key long, key long").distinct()
    told = asked.join(known, "key", "left_semi").groupBy("page_key").agg(F.collect_set("key").alias("template"))
    told = materialize(told, "told")
    # blocks of pages without a template stay where they are
    with_any = marks.table(told, marks.bit("page_key"))
    blocks = F.arrays_zip("texts", "keys")
    kept = F.filter(blocks, lambda b: ~F.arrays_overlap(b["keys"], F.coalesce("template", F.array().cast("array<long>"))))
    if not with_any.any():
        return _texts(parsed, F.col("texts"))
    plain = marks.where(parsed, marks.bit("page_key"), with_any, False)
    others = marks.where(parsed, marks.bit("page_key"), with_any).join(told, "page_key", "left")
    return _texts(plain, F.col("texts")).unionByName(_texts(others, F.transform(kept, lambda b: b["texts"])))


def _texts(parsed: DataFrame, blocks: Column) -> DataFrame:
    text = F.array_join(blocks, "\n\n").alias("text")
    return parsed.select("id", "url", text, F.length(text).cast("long").alias("n_chars"))


class _Marked:
    """Keys of each page whose bit is set."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __call__(self, batches):
        if not self.table.any():
            return
        for batch in batches:
            outer = batch.column("keys")
            inner = outer.flatten()
            keys = inner.flatten().to_numpy(zero_copy_only=False)
            # how many keys each page has
            ends = np.cumsum(np.asarray(inner.value_lengths(), np.int64)) if len(inner) else np.zeros(0, np.int64)
            blocks = np.cumsum(np.asarray(outer.value_lengths(), np.int64))
            upto = np.concatenate([[0], ends])[blocks]
            sizes = np.diff(np.concatenate([[0], upto]))
            pages = np.repeat(batch.column("page_key").to_numpy(), sizes)
            chosen = marks.marked(self.table, keys % marks.BITS)
            yield pa.RecordBatch.from_arrays([pa.array(pages[chosen]), pa.array(keys[chosen])], ["page_key", "key"])
