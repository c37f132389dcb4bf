"""Main text of web pages, with site templates removed.

``subtree_counts`` hashes the element subtrees that may be template and counts,
in Spark, in how many distinct page contents of its host each occurs; those in
at least ``MIN_PAGES`` contents and ``MIN_SHARE`` of them are the host's
template.  A content is a page's text outside elements that never hold any, so
copies of a page count once.  ``extract_pages`` deletes these subtrees, and
what by its element is no article text (menus, forms, scripts, ...), and joins
what is left block by block.

What host counts may delete depends on where a subtree stands:

* outside ``article`` and ``main`` everything, but among the page's own
  paragraphs a plain passage only if it has up to ``SHORT`` characters and
  recurs in ``FIRM`` of the contents;
* inside them link lists, blocks whose class or id says that they are no
  article text, and in a ``main`` outside articles notices of up to ``SHORT``
  characters.  A passage that many articles quote stays;
* never ``html`` or ``body``, nor a subtree that holds more than ``SHORT``
  characters and most of the page's text.

Words in class and id are a tie-break where text does not recur.  Reader
comments, adverts, share bars and the like change from page to page, so words
that mean nothing else (``SURE``) mark a block anywhere.  Words that articles
use too (``MARKS``: notice, related, social, ...) mark a block outside marked
content; inside it they need the host: the slot, an element with this class and
id, must recur as a template does.

Of a page with a ``main``, articles in it are read if they hold ``OWN`` of its
text, otherwise all of it, so that a teaser in an ``article`` of its own does
not hide the story beside it.  Without a ``main``, articles are read if they
hold ``OWN`` of the body's text or more than ``SHORT`` characters, otherwise
the body.

Defined cases: null or empty html gives ''; broken markup is read as browsers
do in the main (unclosed tags, stray ends, text cut off anywhere); a null url
belongs to the host ''; repeated pages count once, and each has its row; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import read_table, small_batches, stored

MIN_PAGES = 5
MIN_SHARE = 0.1
FIRM = 0.5
#: Characters of text up to which a recurring subtree is a notice, however little else a page holds.
SHORT = 200
#: Share of the text around them that articles must hold to be read alone.
OWN = 0.3
#: A host with more than this share of all pages is spread over several tasks.
HOT = 0.001
#: So many template hashes, 8 bytes each, may be broadcast.
SMALL = 1 << 19

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']|[\"'])*)>?|<[!?/][^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[a-z0-9]+")
_NUMBER = re.compile(r"[0-9]+")
_TELLING = re.compile("class|id|role|hidden", re.I).search

#: Elements whose text is no page text at all; up to their end tag nothing in them is markup.
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
#: Elements that hold no article text.
DROPPED = RAW | frozenset("head nav footer aside form menu dialog select button input object audio video canvas applet map datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that may be template inside marked content; no headings, cells or single list items, whose words recur anyway.
NOTICES = frozenset("address center details dir div dl ol p section table ul".split())
#: A start tag that ends an open element of the second kind, unless one of the third stands between.
_ENDS = {
    **{t: ({"p"}, {"table", "td", "th", "caption", "button"}) for t in BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Plain passages, which articles quote.
PASSAGES = frozenset("blockquote p pre".split())
#: Words of class or id, whole, that mark a block as no article text wherever it stands.
SURE = frozenset(
    "ad ads adbox adsense adslot advert adverts advertisement advertising sponsor sponsored promo promoted nav navbar menu breadcrumb breadcrumbs toolbar footer pagination sidebar widget login signup popup modal cookie cookies cookie-notice cookie-banner cookie-consent newsletter newsletter-signup subscribe share share-buttons share-bar sharing social social-share related related-posts related-articles recommended "
    "comment comments comment-list comment-section commentlist comments-area post-comments reply replies disqus disqus_thread respond".split()
)
#: Those of them that may hold most of a page's text.
THREADS = frozenset("comment comments comment-list comment-section commentlist comments-area post-comments disqus disqus_thread respond".split())
#: Parts of class or id that mark a block outside marked content, or a slot that recurs on its host.
MARKS = frozenset(
    "ad ads adbox adsense adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu menubar breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations comment comments disqus respond replies widget pagination pager login signin signup search skip teaser".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())


class Page:
    """Nodes of a page and its blocks of (node, text)."""

    def __init__(self, html: str) -> None:
        self.parent, self.tag, self.marks = [-1], ["#page"], [NOTHING]
        self.blocks: list[list[tuple[int, str]]] = []
        self._block: list[tuple[int, str]] = []
        self._stack = [0]
        self._read(html)
        self._flush()
        #: (node, text with single spaces) of all strings that have any
        self.strings = [(node, s) for block in self.blocks for node, text in block if (s := " ".join(text.split()))]
        self._judge()

    def _flush(self) -> None:
        if self._block:
            self.blocks.append(self._block)
            self._block = []

    def _pop_to(self, depth: int) -> None:
        if any(self.tag[n] in BLOCKS for n in self._stack[depth:]):
            self._flush()
        del self._stack[depth:]

    def _open(self, tag: str, attributes: str) -> None:
        if ends := _ENDS.get(tag):
            for i in range(len(self._stack) - 1, 0, -1):
                t = self.tag[self._stack[i]]
                if t in ends[0]:
                    self._pop_to(i)
                    break
                if t in ends[1]:
                    break
        top = self._stack[-1]
        if tag in BLOCKS:
            self._flush()
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                self._block.append((top, " "))
            return
        self.parent.append(top)
        self.tag.append(tag)
        self.marks.append(marks_of(tag, attributes) if _TELLING(attributes) else NOTHING)
        self._stack.append(len(self.parent) - 1)

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            t = self.tag[self._stack[i]]
            if t == tag:
                self._pop_to(i)
                return
            if tag not in BLOCKS and t in BLOCKS:  # an inline end does not reach over a block
                return

    def _text(self, s: str) -> None:
        if s:
            self._block.append((self._stack[-1], unescape(s) if "&" in s else s))

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        find = _TOKEN.search
        while at < n:
            m = find(html, at)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self._close(name)
                continue
            own = m[3].rstrip().endswith("/") and name in ("svg", "math", "iframe", "script")
            self._open(name, m[3])
            if name in RAW and not own:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                if end is None:  # the rest of the page lies in it
                    self._text(html[at:])
                    return
                self._text(html[at : end.start()])
                self._close(name)
                at = end.end()
            elif own:
                self._close(name)

    def _judge(self) -> None:
        """What goes whatever the host shows, and where marked content lies (main: 1 an article, 2 a main element, 3 both)."""
        n = len(self.parent)
        self.gone, self.main, self.slot = [False] * n, [0] * n, [0] * n
        hard = [False] * n
        for node in range(1, n):
            m = self.marks[node]
            hard[node] = hard[self.parent[node]] or self.tag[node] in DROPPED or m.dropped
        self.size = size = self._sizes(hard)
        holds = [False] * n  # marked content in or at a node
        for node in range(n - 1, 0, -1):
            holds[node] = holds[node] or (self._kind(node) > 0 and not hard[node])
            holds[self.parent[node]] = holds[self.parent[node]] or holds[node]
        for node in range(1, n):
            up, tag, m = self.parent[node], self.tag[node], self.marks[node]
            main = self.main[up]
            gone = self.gone[up] or hard[node] or (tag == "header" and not main)
            if not gone and (m.sure or m.maybe):
                most = size[node] > SHORT and 2 * size[node] > size[0] and (main > 0 or holds[node] or not holds[0])
                if m.sure and (tag in BLOCKS or not main):
                    gone = (not most or m.sure > 1) and size[node] < size[0]
                elif m.maybe and not main:
                    gone = not most
                if not gone and m.maybe and main and not most:
                    self.slot[node] = m.slot
            self.gone[node] = gone
            self.main[node] = main if gone else main | self._kind(node)

    def _kind(self, node: int) -> int:
        return 1 if self.tag[node] == "article" else 2 if self.tag[node] == "main" or self.marks[node].main else 0

    def _sizes(self, without: list[bool]) -> list[int]:
        """Characters of each node's subtree outside these nodes."""
        out = [0] * len(self.parent)
        for node, text in self.strings:
            if not without[node]:
                out[node] += len(text)
        for node in range(len(out) - 1, 0, -1):
            if out[node]:
                out[self.parent[node]] += out[node]
        return out

    def hashes(self) -> list[int]:
        """A hash of each node's subtree (tags and text) from below; 0 for those without text."""
        inner: list[list[str]] = [[] for _ in self.parent]
        for node, text in self.strings:
            inner[node].append(text)
        out = [0] * len(self.parent)
        for node in range(len(self.parent) - 1, 0, -1):  # children stand behind their parents
            if inner[node]:
                d = hashlib.blake2b(f"{self.tag[node]}\0{chr(1).join(inner[node])}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
                out[node] = int.from_bytes(d, "little", signed=True)
                inner[self.parent[node]].append(d.hex())
        return out

    def candidates(self) -> list[bool]:
        """Whether each node may be template where it stands."""
        size, links = [0] * len(self.parent), [0] * len(self.parent)
        for node, text in self.strings:
            size[node] += len(text)
        for node in range(len(size) - 1, 0, -1):
            if self.tag[node] == "a":
                links[node] = size[node]
            size[self.parent[node]] += size[node]
            links[self.parent[node]] += links[node]
        return [
            not main or m.maybe or bool(m.sure) or (tag in NOTICES and (2 * linked >= n or (main == 2 and n <= SHORT)))
            for main, m, tag, linked, n in zip(self.main, self.marks, self.tag, links, size, strict=True)
        ]

    def subtrees(self) -> set[int]:
        """Hashes of the subtrees that may be template, and of the slots that may be."""
        return {x for x, may in zip(self.hashes(), self.candidates(), strict=True) if may} | set(self.slot) - {0}

    def content(self) -> int:
        """A hash of the text outside elements that go anyway."""
        kept = " ".join(" ".join("".join(t for node, t in block if not self.gone[node]) for block in self.blocks).split())
        return _hash(kept)

    def _template(self, template: frozenset[int], firm: frozenset[int]) -> list[bool]:
        """What goes, with the subtrees and slots whose hash is in template; firm: those that most contents have."""
        gone, h, may, size = list(self.gone), self.hashes(), self.candidates(), self.size
        often = [m and x in template for m, x in zip(may, h, strict=True)]
        own = [0] * len(gone)  # own paragraphs right below
        for node in range(1, len(gone)):
            own[self.parent[node]] += self.tag[node] in PASSAGES and not often[node] and size[node] > 0
        stays = [False] * len(gone)
        for node in range(1, len(gone)):
            up = self.parent[node]
            most = self.tag[node] in ("html", "body") or (size[node] > SHORT and 2 * size[node] > size[0])
            quoted = self.tag[node] in PASSAGES and (size[node] > SHORT or h[node] not in firm) and own[up] > 0 and not self.marks[node].maybe
            hit = often[node] or (self.slot[node] != 0 and self.slot[node] in template)
            stays[node] = stays[up] or (often[node] and (most or quoted))
            gone[node] = gone[node] or gone[up] or (hit and not stays[node])
        return gone

    def _region(self, gone: list[bool]) -> list[bool]:
        """Which nodes belong to the main content."""
        n = len(gone)
        if not any(self.main):
            return [True] * n
        size, own, tops, inside = self._sizes(gone), [0] * n, [], [False] * n
        for node in range(1, n):
            up = self.parent[node]
            if self.main[node] & 1 and not self.main[up] & 1:
                own[node] = size[node]
            inside[node] = bool(self.main[node] & 2)
            if inside[node] and not inside[up] and size[node]:
                tops.append(node)
        for node in range(n - 1, 0, -1):  # text in articles in or at a node
            own[self.parent[node]] += own[node]
        if tops:
            read = sum(own[i] for i in tops) >= OWN * sum(size[i] for i in tops)
        else:
            read = own[0] > min(SHORT, OWN * size[0])
        if read:
            return [bool(m & 1) for m in self.main]
        return inside if tops else [True] * n

    def text(self, template: frozenset[int] = frozenset(), firm: frozenset[int] = frozenset()) -> str:
        """The main text, without subtrees whose hash is in template."""
        gone = self._template(template, firm) if template else self.gone
        want = self._region(gone)
        out = []
        for block in self.blocks:
            s = " ".join("".join(t for node, t in block if want[node] and not gone[node]).split())
            if s:
                out.append(s)
        return "\n".join(out)


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Marks(NamedTuple):
    """What an element's attributes say."""

    dropped: bool = False  # it is no page text
    sure: int = 0  # 2: a thread of comments
    maybe: bool = False
    main: bool = False
    slot: int = 0


NOTHING = Marks()


@lru_cache(maxsize=4096)
def marks_of(tag: str, attributes: str) -> Marks:
    dropped, sure, maybe, main, names = False, 0, False, False, []
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            words = frozenset(value.split())
            names.append(f"{name}={_NUMBER.sub('0', ' '.join(sorted(words)))}")
            sure = max(sure, 2 if not THREADS.isdisjoint(words) else int(not SURE.isdisjoint(words)))
            parts = _PARTS.findall(value)
            maybe |= not MARKS.isdisjoint(parts) or "header" in parts
        elif name == "role":
            dropped |= value.strip() in ROLES
            main |= value.strip() == "main"
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            dropped = True
    return Marks(dropped, sure, maybe, main, _hash(f"slot\0{tag}\0{chr(0).join(names)}") if sure or maybe else 0)


def host() -> Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))


def subtree_counts(pages: DataFrame) -> DataFrame:
    """(host, subtree, n): in how many distinct contents of the host each subtree that may be template occurs; subtree 0 counts the contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            hosts, out, contents = [], [], []
            for h, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = Page(html or "")
                found = page.subtrees() | {0}
                out += found
                hosts += [h] * len(found)
                contents += [page.content()] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(np.array(x, np.int64)) for x in (out, contents))], names=["host", "subtree", "content"])

    found = pages.select(host().alias("host"), "html").mapInArrow(run, "host string, subtree long, content long")
    # first by all three, so that a common subtree of a large host is spread and then counted in parts
    return found.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))


def site_templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((host, template, firm): the recurring subtrees of each host, (host, pages) of hosts with more than HOT of all contents).

    A page has so many subtrees that a host has at most 1 / MIN_SHARE times as many; there are at most 1 / HOT hot hosts.
    """
    counts = stored(subtree_counts(pages).where(f"subtree = 0 or n >= {MIN_PAGES}"), "subtrees")
    total = counts.where("subtree = 0").select("host", F.col("n").alias("pages"))
    often = counts.where(f"subtree <> 0 and n >= {MIN_PAGES}").join(total, "host").where(F.col("n") >= F.col("pages") * MIN_SHARE)
    every = total.agg(F.sum("pages")).first()[0] or 0
    firm = F.collect_list(F.when(F.col("n") >= F.col("pages") * FIRM, F.col("subtree")))
    return stored(often.groupBy("host").agg(F.collect_list("subtree").alias("template"), firm.alias("firm")), "templates"), total.where(F.col("pages") > HOT * every)


def with_templates(pages: DataFrame, templates: DataFrame, hot: DataFrame, small: int = SMALL) -> DataFrame:
    """page_id, url, html, template, firm.

    Templates of at most small hashes in all go to every executor and pages stay where they are.  Beyond that pages
    meet them by host, those of a hot host dealt over as many tasks as its share asks for.
    """
    plain = pages.select("page_id", "url", "html", host().alias("host"))
    if (templates.agg(F.sum(F.size("template"))).first()[0] or 0) <= small:
        return plain.join(F.broadcast(templates), "host", "left").select("page_id", "url", "html", "template", "firm")
    every = hot.agg(F.sum("pages")).first()[0] or 0
    parts = F.ceil(F.col("pages") / (HOT * every)).cast("int") if every else F.lit(1)
    salts = F.broadcast(hot.select("host", parts.alias("salts")))  # at most 1 / HOT rows
    salt = F.pmod(F.xxhash64("page_id", "html"), F.coalesce("salts", F.lit(1))).cast("int")
    rows = plain.join(salts, "host", "left").withColumn("salt", salt)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    dealt = templates.join(salts, "host", "left").select("host", copies.alias("salt"), "template", "firm")
    return rows.join(dealt, ["host", "salt"], "left").select("page_id", "url", "html", "template", "firm")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = with_templates(pages, *site_templates(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 2):
            texts = [Page(h or "").text(frozenset(t or ()), frozenset(f or ())) for h, t, f in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f for f in pages.schema}
    return rows.mapInArrow(run, T.StructType([kinds["page_id"], kinds["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
