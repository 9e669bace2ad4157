"""Main text of web pages: site templates are found by counting element subtrees per host.

Every element with text gets a hash of its tags and text. Per host, Spark counts the different pages
that hold a subtree (outside the article) or the different articles (inside it), and subtrees that
recur on a large share of them are deleted from the host's pages. Elements that say what they are, such
as nav, footer, form or a class of adverts, go as well. Copies of a page or an article count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import Scratch

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|select|object|canvas|title)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
# Element names of HTML by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody"
    " tfoot thead tr ul".split()
)
_CLOSED_BY = {
    "p": _BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "head": frozenset(["body"]), "option": frozenset(["option"]),
}
_FENCE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
          "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"])}
_DROPPED = frozenset("aside button dialog footer form head menu nav".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr"
    r"|notice|notices|newsletter|subscribe|popup|modal|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer"
    r"|comments?|replies|disqus|share|sharing|social|related|recommended|widget|pagination|pager)(?:$|[\s_-])",
    re.I,
)
_BREAK = None  # between blocks in the list of pieces


class _Element:
    __slots__ = ("tag", "at", "parts", "drop", "kind", "text")

    def __init__(self, tag: str, at: int, drop: bool, kind: str):
        self.tag, self.at, self.drop, self.kind = tag, at, drop, kind
        self.parts: list[bytes] = []
        self.text = False


def _named_out(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element says that it is no part of the article."""
    if tag in _DROPPED or (tag == "header" and not inside):
        return True
    if "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in _ROLES:
            return True
        if name in ("class", "id") and tag not in ("body", "html", "main", "article"):
            # within the article a name has to be the whole word: a share price is no share button
            if any(map(_NAMES.fullmatch, value.split())) if inside else _NAMES.search(value):
                return True
        if name in ("class", "id") and tag == "article" and "comment" in value:
            return True
    return False


class Page:
    """One pass over a page's tokens, with a stack of open elements."""

    def __init__(self, html: str, recurring: frozenset[int] = frozenset()):
        self.recurring = recurring
        self.pieces: list[str | None] = []  # words of text, and breaks
        self.articles: list[tuple[int, int]] = []  # ranges of pieces
        self.subtrees: list[tuple[bool, int]] = []  # in an article, hash
        self.article_hash = 0
        self._stack = [_Element("", 0, False, "")]
        self._inside = 0
        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            tag = m[3] or m[6]
            if not tag:
                continue
            tag = tag.lower()
            if m[2] or m[5]:
                self._close(tag)
            else:
                self._open(tag, m[4] or m[7] or "")
        if at < len(html):
            self._text(html[at:])
        while len(self._stack) > 1:
            self._pop()

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if not text.isspace():
            top = self._stack[-1]
            top.parts.append(xxhash.xxh64_digest(" ".join(text.split())))
            top.text = True

    def _open(self, tag: str, attributes: str) -> None:
        for known, closers in _CLOSED_BY.items():
            if tag in closers:
                self._close(known, _FENCE.get(known, _BLOCKS - {"p"} if known == "p" else frozenset()))
        if tag in _BLOCKS:
            self.pieces.append(_BREAK)
        elif tag in ("br", "td", "th"):
            self.pieces.append(" ")
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCKS:
            return
        drop = _named_out(tag, attributes, self._inside > 0)
        kind = "article" if tag == "article" and not drop else ""
        self._stack.append(_Element(tag, len(self.pieces), drop, kind))
        self._inside += kind == "article"

    def _close(self, tag: str, fence: frozenset[str] = frozenset()) -> None:
        for k in range(len(self._stack) - 1, 0, -1):
            known = self._stack[k]
            if known.tag == tag:
                while len(self._stack) > k:
                    self._pop()
                return
            if known.tag in fence:
                return

    def _pop(self) -> None:
        e = self._stack.pop()
        digest = xxhash.xxh64_digest(e.tag.encode() + b"".join(e.parts))
        up = self._stack[-1]
        if e.text:
            up.parts.append(digest)
            up.text = True
            value = int.from_bytes(digest, "big", signed=True)
            if e.kind == "article":
                self.article_hash ^= value
            elif not e.drop and e.tag not in ("html", "body", "main"):
                self.subtrees.append((self._inside > 0, value))
                e.drop = value in self.recurring
        if e.drop:
            del self.pieces[e.at :]
            while self.articles and self.articles[-1][0] >= e.at:
                self.articles.pop()
        elif e.kind == "article":
            while self.articles and self.articles[-1][0] >= e.at:
                self.articles.pop()
            self.articles.append((e.at, len(self.pieces)))
        self._inside -= e.kind == "article"
        if e.tag in _BLOCKS:
            self.pieces.append(_BREAK)

    def text(self) -> str:
        """Blocks of the article, or of what is left of the page if it marks none. Of several articles those of
        less than half the text of the longest are cards of other pages, and left out."""
        pieces = self.pieces
        if self.articles:
            sizes = [sum(len(x) for x in pieces[a:b] if x is not _BREAK) for a, b in self.articles]
            long = [r for r, n in zip(self.articles, sizes) if 2 * n >= max(sizes)]
            pieces = [x for a, b in long for x in (_BREAK, *self.pieces[a:b])]
        blocks, words = [], []
        for piece in [*pieces, _BREAK]:
            if piece is not _BREAK:
                words.append(piece)
            elif words:
                block = " ".join("".join(words).split())
                if block:
                    blocks.append(block)
                words = []
        return "\n\n".join(blocks)


_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def recurring_subtrees(
    pages: DataFrame, least_pages: int, outside_share: float, inside_share: float
) -> DataFrame:
    """host and ``subtrees``, hashes of what recurs there: outside articles on at least ``least_pages``
    different pages and that share of them, inside likewise of the different articles. A share bounds
    how many can recur: elements of a page over the share."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, copies, inside, hashes = [], [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = Page(html)
                whole = xxhash.xxh64_intdigest(html) - (1 << 63)
                found = {(True, 0), (False, 0), *page.subtrees}  # 0 counts the pages themselves
                for within, value in found:
                    hosts.append(host)
                    copies.append(page.article_hash if within else whole)
                    inside.append(within)
                    hashes.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(inside, pa.bool_()), pa.array(hashes, pa.int64()), pa.array(copies, pa.int64())],
                names=["host", "inside", "hash", "copy"])

    found = pages.select("host", "html").mapInArrow(hashed, "host string, inside boolean, hash long, copy long")
    counts = found.distinct().groupBy("host", "inside", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    total = counts.filter("hash = 0").select("host", "inside", F.col("n").alias("all"))
    share = F.when(F.col("inside"), F.lit(inside_share)).otherwise(F.lit(outside_share))
    frequent = counts.filter("hash <> 0").join(total, ["host", "inside"]).filter(F.col("n") >= F.col("all") * share)
    return frequent.groupBy("host").agg(F.collect_set("hash").alias("subtrees"))


def extract(
    pages: DataFrame, least_pages: int = 10, outside_share: float = 0.1, inside_share: float = 0.8,
    scratch: Scratch | None = None,
) -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` of every row of ``pages`` (page_id, url, html).

    Null html is empty and gives empty text; a null url, or one without host, belongs to the host "".
    Character references are decoded, white space runs inside a block become one space, blocks are
    joined by an empty line in page order. Unclosed and stray tags are taken as browsers do in
    essence. Repeated rows each give their row; other columns are dropped.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract("url", _HOST, 1), F.lit("")))
    keyed = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    recurring = scratch.table(recurring_subtrees(keyed, least_pages, outside_share, inside_share))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, frozenset()
        for batch in batches:
            out = []
            for html, hashes in zip(batch.column("html").to_pylist(), batch.column("subtrees").to_pylist()):
                if hashes != last:
                    last, known = hashes, frozenset(hashes or ())
                out.append(Page(html, known).text())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    joined = keyed.join(recurring, "host", "left").select("page_id", "url", "html", "subtrees")
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")
