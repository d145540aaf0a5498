"""Main text of web pages: subtrees of elements that recur across a host's pages are template and go.

Each page is read once into blocks of text and the hashes of its elements' subtrees (tag and content, from the leaves up).
Spark counts, for every host and hash, the *articles* the subtree occurs in: pages with one heading (or title) are one
article, so that copies of a page don't make its text a template. What recurs goes, with all below it:

* outside the page's root, if found in ``FEW`` articles or more;
* inside the root, if found in at least ``FEW_INSIDE`` articles and in half of all articles of the host, for passages
  that several articles share are their text.

The root is ``main``, or the ``article`` elements, or else the least element with over half of the text. Where ``main`` or
``article`` is given, text outside goes too, but for the first heading if the root has none. Hosts with few pages show no
recurrence, so elements that say what they are go on every page: menus, headers (their headings stay inside the root),
footers, sidebars, forms, scripts, and classes, ids or roles of notices, adverts, comments and the like, unless they hold
the page's heading or article and most of its text.

Defined results: a null or empty html has no text; a page without a host is compared with no other; markup cut off at the
end is read as far as it goes; character references are decoded once; elements nested over ``DEEPEST`` deep count as part
of the one around them. Repeated rows are pages of their own, of one article.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.urls import hostname
from tidewire.llm.shared import slices
from tidewire.sources.shared_folder import written

FEW, FEW_INSIDE, SALTS, DEEPEST = 3, 5, 16, 512
#: Up to so many pages (numbers only, no texts) with a recurring subtree are broadcast to the texts; beyond, both are shuffled.
BROADCAST_ROWS = 200_000

_words = lambda s: frozenset(s.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
#: Their content is no markup; the first kind without an end swallows the page, the others are taken as empty.
RAW = _words("script style xmp noembed noframes iframe plaintext")
RAW_TEXT = _words("textarea title")
BLOCKS = _words(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search"
    " section summary table tbody td tfoot th thead tr ul"
)
HEADINGS = _words("h1 h2 h3 h4 h5 h6")
CONTAINERS = _words("body main article section div td center table tbody tr form center details")
#: Elements that are no main text wherever they stand.
DROPPED = _words("head script style noscript template nav footer aside form button select option textarea input label iframe svg math object canvas audio video dialog menu search noembed noframes map datalist")
ROLES = _words("navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog alert status")
#: Words of classes and ids that name such elements.
NAMES = _words(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu submenu"
    " breadcrumb breadcrumbs masthead topbar header footer sidebar widget widgets related recommended recommendations trending share sharing social comment comments disqus reply replies respond newsletter subscribe"
    " subscription signup login search paywall toolbar pager pagination skip"
)
#: What an opening element ends, up to the nearest of the second kind; every block ends a paragraph.
CLOSES = {
    "li": (_words("li"), _words("ul ol menu dir")),
    "dt": (_words("dt dd"), _words("dl")),
    "dd": (_words("dt dd"), _words("dl")),
    "tr": (_words("tr td th"), _words("table")),
    "td": (_words("td th"), _words("table tr")),
    "th": (_words("td th"), _words("table tr")),
}
_MARKUP = r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)"
_TOKEN = re.compile(_MARKUP + r"((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
_PLAIN = re.compile(_MARKUP + r"([^>]*)>", re.DOTALL)
_NAMED = re.compile(r"(?<![^\s/\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/\"']|$)", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_MASK = (1 << 64) - 1


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


DROP, HEADER = 1, 2


def mark(tag: str, attributes: str) -> int:
    """Whether the element says that it is no main text, or a header."""
    marked = DROP if tag in DROPPED else HEADER if tag == "header" else 0
    for name, value in _NAMED.findall(attributes) if attributes and marked != DROP else ():
        name, value = name.lower(), entities.unescape(value.strip("\"'"))
        if name in ("class", "id"):
            if tag not in ("html", "body"):
                said = NAMES.intersection(x.lower() for x in _PARTS.findall(value))
                marked = DROP if said - {"header"} else HEADER if said else marked
        elif (name == "role" and value.strip().lower() in ROLES) or name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            marked = DROP
        if marked == DROP:
            break
    return marked


class Page:
    """Blocks of text in page order, and the elements (nodes, in page order) that hold them, each a run of blocks."""

    def __init__(self, source: str):
        self.blocks: list[str] = []
        self.tag, self.parent, self.first, self.end, self.hash, self.marked, self.is_main = [], [], [], [], [], [], []
        self.title = ""
        self._stack: list[int] = []
        self._open: dict[str, int] = {}
        self._text: list[str] = []
        self._skipped = 0
        self._push("html", "")
        self._read(source)
        while self._stack:
            self._pop()

    def _push(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
        self.tag.append(tag)
        self.parent.append(self._stack[-1] if self._stack else -1)
        self.first.append(len(self.blocks))
        self.end.append(-1)
        self.hash.append(_hash(tag))
        self.marked.append(mark(tag, attributes))
        self.is_main.append(tag == "main" or bool(attributes and _MAIN.search(attributes)))
        self._stack.append(len(self.tag) - 1)
        self._open[tag] = self._open.get(tag, 0) + 1
        self._skipped += tag not in BLOCKS

    def _pop(self) -> None:
        node = self._stack[-1]
        if self.tag[node] in BLOCKS:
            self._flush()
        else:
            self._skipped -= 1
        self._stack.pop()
        self.end[node] = len(self.blocks)
        self._open[self.tag[node]] -= 1
        if self._stack and self.end[node] > self.first[node]:
            self._mix(self._stack[-1], self.hash[node])

    def _mix(self, node: int, value: int) -> None:
        mixed = (self.hash[node] ^ value) * 0x9E3779B97F4A7C15 & _MASK
        self.hash[node] = mixed ^ (mixed >> 29)

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text.clear()
        if text:
            self._mix(self._stack[-1], _hash(text))
            self.blocks.append(text)

    def _pop_to(self, node: int) -> None:
        while self._stack[-1] != node:
            self._pop()
        self._pop()

    def _starts(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS or tag == "hr":
            if self._open.get("p"):
                self._pop_to(next(n for n in reversed(self._stack) if self.tag[n] == "p"))
            ended, until = CLOSES.get(tag, ((), ()))
            while any(self._open.get(t) for t in ended):
                node = next(n for n in reversed(self._stack) if n == 0 or self.tag[n] in ended or self.tag[n] in until)
                if self.tag[node] not in ended:
                    break
                self._pop_to(node)
        if tag in BLOCKS:
            if tag == "html" or len(self._stack) >= DEEPEST:
                self._flush()
            else:
                self._push(tag, attributes)
        elif tag in ("br", "hr"):
            self._flush() if tag == "hr" else self._text.append(" ")
        elif tag not in VOID and len(self._stack) < DEEPEST and mark(tag, attributes) == DROP:
            # Elements within a line that go: the text around them is one block.
            self._push(tag, attributes)

    def _read(self, source: str) -> None:
        at, last, strict = 0, source.rfind(">"), True
        no_end = dict.fromkeys(RAW_TEXT, False)
        while True:
            start = source.find("<", at)
            self._say(source[at : start if start >= 0 else len(source)])
            if start < 0:
                return
            found = (_TOKEN if strict else _PLAIN).match(source, start) if start <= last or source.startswith("<!--", start) else None
            if not found and strict and start <= last and source[start + 1 : start + 2].isalpha():
                # A quote without an end: from here on tags end at the first ">".
                strict, found = False, _PLAIN.match(source, start)
            if not found:
                if start > last and re.match("<[a-zA-Z/!?]", source[start : start + 2]):
                    return  # cut off within a tag
                self._say("<")
                at = start + 1
                continue
            at = found.end()
            ended, tag, attributes = found.groups()
            if ended:
                ended = ended.lower()
                if ended == "br":
                    self._text.append(" ")
                elif ended == "p" and not self._open.get("p"):
                    self._flush()
                elif self._open.get(ended) and ended != "html":
                    self._pop_to(next(n for n in reversed(self._stack) if self.tag[n] == ended))
            elif tag:
                tag = tag.lower()
                if tag in RAW or (tag in RAW_TEXT and not no_end[tag]):
                    close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                    if close:
                        if tag == "title" and not self.title:
                            self.title = " ".join(entities.unescape(source[at : close.start()]).split())
                        at = close.end()
                    elif tag in RAW:
                        return
                    else:
                        no_end[tag] = True
                elif not (attributes.endswith("/") and tag in ("svg", "math")):
                    self._starts(tag, attributes)

    def _say(self, text: str) -> None:
        if text and not self._skipped:
            self._text.append(entities.unescape(text) if "&" in text else text)

    def _sums(self, own: list[int]) -> list[int]:
        """For every node the sum over it and all nodes in it."""
        total = own.copy()
        for i in range(len(total) - 1, 0, -1):
            total[self.parent[i]] += total[i]
        return total

    def parts(self) -> tuple[int, list[str], list[tuple[int, int, int, int]], int]:
        """(hash of the article's name, blocks that may stay, (hash, first, end, kind) of nodes, blocks marked)

        Kinds: 0 inside the root, 1 outside, both as runs of those blocks; 2 marked, with the number of its blocks as end.
        """
        nodes = range(len(self.tag))
        upto = np.r_[0, np.cumsum([len(b) for b in self.blocks], dtype=np.int64)].tolist()
        size = [upto[self.end[i]] - upto[self.first[i]] for i in nodes]
        h1, bodies = self._sums([int(t == "h1") for t in self.tag]), self._sums([int(m or t == "article") for m, t in zip(self.is_main, self.tag, strict=True)])
        unmarked_bodies = sum(not m and (t == "article" or is_main) for m, t, is_main in zip(self.marked, self.tag, self.is_main, strict=True))
        # The topmost marked element around each node, -1 if none; headings in headers are told apart below.
        marked = self.marked
        for i in nodes:
            if marked[i] and 2 * size[i] > size[0] and (h1[i] or bodies[i] > (self.tag[i] == "article" or self.is_main[i]) or (bodies[i] and not unmarked_bodies)):
                marked[i] = 0
        under, header = [-1] * len(nodes), [False] * len(nodes)
        for i in nodes:
            up = self.parent[i]
            header[i] = up >= 0 and (header[up] or marked[up] == HEADER)
            if up >= 0 and under[up] >= 0 and not (self.tag[i] in HEADINGS and marked[under[up]] == HEADER):
                under[i] = under[up]
            elif marked[i]:
                under[i] = i
        mains = [i for i in nodes if self.is_main[i] and under[i] < 0] or [i for i in nodes if self.tag[i] == "article" and under[i] < 0]
        mains = [i for i in mains if h1[i]] or mains
        given = bool(mains)
        if not given:
            mains = [self._least(under, size)]
        inside, heading = [False] * len(nodes), None
        for i in nodes:
            inside[i] = i in mains or (self.parent[i] >= 0 and inside[self.parent[i]])
        of = [-1] * len(self.blocks)  # the innermost node of each block
        for i in nodes:
            of[self.first[i] : self.end[i]] = [i] * (self.end[i] - self.first[i])
        headings = [i for i in nodes if self.tag[i] in HEADINGS and under[i] < 0 and self.end[i] > self.first[i]]
        own = [i for i in headings if inside[i]]
        if given and not own and headings:
            heading = next((i for i in headings if self.tag[i] == "h1"), None)
        stays = [under[i] < 0 and (inside[i] or (not given and not header[i]) or i == heading) for i in of]
        place = np.r_[0, np.cumsum(stays, dtype=np.int64)].tolist()
        kept = [b for b, s in zip(self.blocks, stays, strict=True) if s]
        ancestors = {0}
        for i in mains:
            while i > 0:
                ancestors.add(i)
                i = self.parent[i]
        out = []
        for i in nodes:
            if under[i] == i and self.end[i] > self.first[i]:
                out.append((self.hash[i], 0, self.end[i] - self.first[i], 2))
            elif i not in ancestors and place[self.end[i]] > place[self.first[i]]:
                out.append((self.hash[i], place[self.first[i]], place[self.end[i]], int(not inside[i])))
        name = (own or ([heading] if heading is not None else headings))[:1]
        named = " ".join(self.blocks[self.first[name[0]] : self.end[name[0]]]) if name else self.title or max(kept, key=len, default="")
        return _hash(named), kept, out, len(self.blocks) - len(kept)

    def _least(self, under: list[int], size: list[int]) -> int:
        """The least container with over half of the unmarked text."""
        own = [0] * len(size)
        for i in range(len(size)):
            if under[i] == i:
                own[i] -= size[i]
        free = [s + o for s, o in zip(size, self._sums(own), strict=True)]
        at = 0
        for i in range(1, len(size)):
            if self.parent[i] == at and 2 * free[i] > free[0] and self.tag[i] in CONTAINERS and under[i] < 0:
                at = i
        return at


NODE = "array<struct<hash:bigint,first:int,end:int,kind:int>>"


def parse(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(row, page_id, url, host, article, blocks, nodes, n_marked) of every page."""
    node = pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            names, blocks, nodes, gone = [], [], [], []
            for source in batch.column("html").to_pylist():
                name, kept, found, n = Page(source or "").parts()
                names.append(signed(name))
                blocks.append(kept)
                nodes.append([{"hash": signed(h), "first": a, "end": b, "kind": k} for h, a, b, k in found])
                gone.append(n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "page_id", "url", "host")), pa.array(names, pa.int64()), pa.array(blocks, pa.list_(pa.string())), pa.array(nodes, pa.list_(node)), pa.array(gone, pa.int64())],
                ["row", "page_id", "url", "host", "article", "blocks", "nodes", "n_marked"],
            )

    host = F.nullif(hostname(F.col(url_col).cast("string")), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.when(host.isNotNull(), F.xxhash64(host)).alias("host"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(run, f"row bigint, page_id {pages.schema[id_col].dataType.simpleString()}, url string, host bigint, article bigint, blocks array<string>, nodes {NODE}, n_marked bigint")


def templates(parsed: DataFrame) -> DataFrame:
    """(host, hash, inside): subtrees that recur on a host, and whether often enough to go inside a root too."""
    nodes = parsed.where("host is not null").select("host", "article", F.explode(F.array_distinct(F.col("nodes.hash"))).alias("hash"))
    found = nodes.groupBy("host", "hash").agg(F.count_distinct("article").alias("articles")).where(F.col("articles") >= FEW)
    hosts = parsed.where("host is not null").groupBy("host").agg(F.count_distinct("article").alias("every"))
    return found.join(hosts, "host").select("host", "hash", ((F.col("articles") >= FEW_INSIDE) & (2 * F.col("articles") >= F.col("every"))).alias("inside"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_marked, n_template) of every page: text, its length, and the number of blocks
    that stay, that went by what they say they are or by their place, and that went (these included) as template."""
    parsed = written(parse(pages, id_col, url_col, html_col), "pages")
    salt = F.pmod(F.col("row"), F.lit(SALTS)).cast("int")
    nodes = parsed.where("host is not null").select("row", "host", salt.alias("salt"), F.explode("nodes").alias("node")).select("row", "host", "salt", "node.*")
    # A menu may be on all pages of a host with a third of all pages: each template is met under several salts.
    known = templates(parsed).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = nodes.join(known, ["host", "hash", "salt"]).where("kind > 0 or inside").groupBy("row").agg(F.collect_set(F.struct("first", "end", "kind")).alias("gone"))
    hits = written(found, "hits")
    known_rows = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits.hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, template = [], [], []
            for blocks, gone in zip(batch.column("blocks").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                edge = np.zeros(len(blocks) + 1, np.int64)
                marked = 0
                for g in gone or ():
                    if g["kind"] == 2:
                        marked += g["end"]
                    else:
                        edge[g["first"]] += 1
                        edge[g["end"]] -= 1
                stays = np.cumsum(edge)[: len(blocks)] == 0
                texts.append("\n\n".join(b for b, s in zip(blocks, stays.tolist(), strict=True) if s))
                counts.append(int(stays.sum()))
                template.append(len(blocks) - counts[-1] + marked)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), batch.column("n_marked"), pa.array(template, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_marked", "n_template"],
            )

    joined = parsed.join(known_rows, "row", "left").select("page_id", "url", "blocks", "n_marked", "gone")
    kind = pages.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint, n_blocks bigint, n_marked bigint, n_template bigint")
