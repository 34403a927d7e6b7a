"""Main text of web pages by site template removal.

A page is parsed into elements; every block element's subtree is hashed (tag, text
and children, without attributes), and every line of text (what is between block boundaries). Spark counts, for each host,
the pages that a line is on; lines on at least ``MIN_PAGES`` recur. A subtree is then looked at beside what else its pages say: a page speaks for
it if most of the page's other text is the page's own (doesn't recur), and pages whose own text has the same
smallest hash are one article. Subtrees that at least ``MIN_PAGES`` articles speak for are the site's template and are deleted; then
the same is asked of the rest, until no more are found. So a
notice of any length goes, while the paragraphs of copies and near copies of an article, which stand beside recurring text,
stay. The bound doesn't grow with the host. What is inside <article> or <main> is that article's, also where others quote the same passage: no template
is looked for or deleted there. Elements that name themselves
something else than article text (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments) are deleted on every page, which also
covers hosts with few pages. Of the rest, text inside <article> (else <main>) is the
main text if it is at least half of the text.

Scale: two passes over the pages, no shuffle of html or text: a page is reduced to hashes and lengths, written once. Pairs of host and hash are
made distinct and counted by partial aggregates; a page's recurring lines come back to it as positions, as many as it has lines. The
templates of a host are joined back by host (broadcast by Spark only when their
size is under Spark's own threshold; else a join whose hot host AQE splits). Parsing takes time and memory linear in a page's length.

Defined results: null or empty html, or nothing left, gives an empty text; a null url or
one without :// belongs to the empty host; rows that repeat a url are extracted alike
and count as one page; an empty table gives no rows; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, table
from ledgerline.llm.link_trust import url_host

MIN_PAGES = 5

# Fixed values of HTML: elements without content, with raw content, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag closes an open element of its group, looked for up to a boundary.
GROUPS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("thead tbody tfoot tr td th", "table"), "thead": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tfoot tr td th", "table"), "option": ("option", "select"),
}
IMPLIED = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in GROUPS.items()}
P_ENDS = frozenset("td th li dd dt div article section main aside nav body html table button".split())

#: Elements that are never article text, and words of class, id and role that say so.
OTHER_TAGS = frozenset("head nav footer aside form script style noscript template iframe object svg button select textarea dialog menu input label noembed noframes canvas audio video".split())
OTHER_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead banner topbar footer contentinfo sidebar aside complementary ad ads adv advert adverts "
    "advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog "
    "newsletter subscribe subscription signup login signin search searchform form comment comments commentlist disqus reply replies respond related recommended recommendations share sharing "
    "social pagination pager toolbar".split()
)
ARTICLE_WORDS = frozenset("comment comments reply related recommended ad ads advert sponsored promo".split())
NEGATIONS = frozenset("has have no not with without".split())
KEPT_WHOLE = frozenset("html body article main".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def host_of(url: str | None) -> str:
    """What is between the first :// and the next / ? # or the end, A-Z lower-cased."""
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host)


NO, WRAPPER, YES = 0, 1, 2  # WRAPPER: only a class, id or role says so, and one that wrappers of the whole page have too


def says_other(tag: str, attributes: str, in_article: bool) -> int:
    if tag in OTHER_TAGS or (tag == "header" and not in_article):
        return YES
    if not attributes or attributes.isspace() or tag in ("html", "body", "main"):
        return NO
    allowed = ARTICLE_WORDS if tag == "article" else OTHER_WORDS
    said = NO
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return YES
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                return YES
        elif name != "aria-hidden":
            words = {w for v in value.split() for w in before_negation(_WORDS.split(v))}
            if not allowed.isdisjoint(words) or (not in_article and tag != "article" and "header" in words):
                said = max(said, WRAPPER if name != "role" and ARTICLE_WORDS.isdisjoint(words) else YES)
    return said


def before_negation(parts: list[str]) -> list[str]:
    """has-sidebar, content-with-sidebar, no-comments: said of a page, not of the element."""
    return parts[: next((i for i, w in enumerate(parts) if w in NEGATIONS), len(parts))]


class Page:
    """Elements in order of their start: parent, subtree hash (0: no block or no
    text), whether it says it isn't article text; and pieces (element, block, text)."""

    def __init__(self, source: str):
        self.parent, self.hash, self.other, self.tag = [-1], [0], [NO], [""]
        self.span: list[tuple[int, int]] = [(0, 0)]  # of pieces, by element
        self.pieces: list[tuple[int, int, str]] = []
        self._at: dict[str, list[int]] = {}  # places in the stack of a tag's open elements
        self._stack, self._parts, self._block, self._articles = [0], [[]], 0, 0
        at = 0
        search = _TAG.search
        while match := search(source, at):
            if match.start() > at:
                self._text(source[at : match.start()])
            at = match.end()
            closing, tag, attributes = match[1] or match[4], (match[2] or match[5] or "").lower(), match[3] or match[6] or ""
            if not tag:
                continue
            if closing:
                self._close(tag)
                continue
            self._open(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                self._pop()
        if at < len(source):
            self._text(source[at:])
        while len(self._stack) > 1:
            self._pop()
        if WRAPPER in self.other:
            self._keep_wrappers()

    def _keep_wrappers(self) -> None:
        """Unmarks what only its name marks, where it holds the page's articles (if none is
        outside of marked elements) or most of the page's text besides links."""
        sure, marked, link = [False], [False], [False]
        for n in range(1, len(self.parent)):
            up = self.parent[n]
            sure.append(sure[up] or self.other[n] == YES)
            marked.append(marked[up] or self.other[n] != NO)
            link.append(link[up] or self.tag[n] == "a")
        held = [0] * len(self.parent)
        for n, _, text in self.pieces:
            if not sure[n] and not link[n]:
                held[n] += len("".join(text.split()))
        articles = [n for n in range(1, len(self.parent)) if self.tag[n] == "article" and not sure[n]]
        around = set() if any(not marked[n] for n in articles) else {n for n in articles if self.other[n] == NO}
        for n in range(len(self.parent) - 1, 0, -1):
            held[self.parent[n]] += held[n]
            if n in around:
                around.add(self.parent[n])
        for n, other in enumerate(self.other):
            if other == WRAPPER and (n in around or 2 * held[n] > held[0]):
                self.other[n] = NO

    def _text(self, text: str) -> None:
        if "&" in text:
            text = html_lib.unescape(text)
        self.pieces.append((self._stack[-1], self._block, text))
        if words := " ".join(text.split()):
            self._parts[-1].append(words)

    def _open(self, tag: str, attributes: str) -> None:
        if tag in IMPLIED:
            self._imply(*IMPLIED[tag])
        elif tag in BLOCK:
            self._imply(frozenset(("p",)), P_ENDS)
        if tag == "br":
            self.pieces.append((self._stack[-1], self._block, " "))
        if tag in VOID:
            self._block += tag == "hr"
            return
        self.parent.append(self._stack[-1])
        self.hash.append(0)
        self.tag.append(tag)
        self.other.append(says_other(tag, attributes, self._articles > 0))
        if tag == "main":  # what holds the main part is none of the others
            for n in self._stack:
                self.other[n] = self.other[n] if self.tag[n] in OTHER_TAGS else NO
        self._articles += tag in ("article", "main")
        self._block += tag in BLOCK
        self._at.setdefault(tag, []).append(len(self._stack))
        self._stack.append(len(self.parent) - 1)
        self.span.append((len(self.pieces), len(self.pieces)))
        self._parts.append([])

    def _last(self, tags: frozenset[str]) -> int:
        """Place in the stack of the last open element of some tags; 0 without one."""
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=0)

    def _imply(self, tags: frozenset[str], ends: frozenset[str]) -> None:
        while (depth := self._last(tags)) > self._last(ends):
            while len(self._stack) > depth:
                self._pop()
            if len(tags) <= 3:  # a table section closes rows and cells alike
                return

    def _close(self, tag: str) -> None:
        if depth := self._last(frozenset((tag,))):
            while len(self._stack) > depth:
                self._pop()

    def _pop(self) -> None:
        n, parts = self._stack.pop(), self._parts.pop()
        tag = self.tag[n]
        self._at[tag].pop()
        self.span[n] = (self.span[n][0], len(self.pieces))
        self._block += tag in BLOCK
        self._articles -= tag in ("article", "main")
        if parts and tag not in RAW:
            digest = xxhash.xxh64_intdigest("\x1f".join((tag, *parts)).encode("utf-8", "replace"))
            if tag in BLOCK and tag not in KEPT_WHOLE:
                self.hash[n] = signed(digest) or 1
            self._parts[-1].append(f"\x1e{digest:x}")

    def _parts_of_page(self, template: frozenset[int] | set[int] = frozenset()) -> tuple[list[bool], list[int]]:
        """Of each element, whether it is deleted, and whether it is inside <article> (2) or <main> (1)."""
        gone, within = [False] * len(self.parent), [0] * len(self.parent)
        for n in range(1, len(self.parent)):
            up = self.parent[n]
            within[n] = max(within[up], (self.tag[n] == "article") * 2, int(self.tag[n] == "main"))
            gone[n] = bool(gone[up] or self.other[n] or (not within[n] and self.hash[n] in template))
        return gone, within

    def text(self, template: frozenset[int] | set[int] = frozenset()) -> str:
        """The main text, without subtrees whose hash is in ``template``."""
        gone, within = self._parts_of_page(template)
        kept = [(within[n], block, text) for n, block, text in self.pieces if not gone[n]]
        sizes = [sum(len("".join(text.split())) for w, _, text in kept if w >= inside) for inside in range(3)]
        inside = next(w for w in (2, 1, 0) if sizes[w] and 2 * sizes[w] >= sizes[0] or not w)
        blocks: dict[int, list[str]] = {}
        for w, block, text in kept:
            if w >= inside:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)

    def profile(self) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
        """Hashes and lengths of the lines outside of deleted elements, and (hash, first line, end) of the subtrees
        there that are outside of <article> and <main>."""
        gone, within = self._parts_of_page()
        parts: dict[int, list[str]] = {}
        for n, block, text in self.pieces:
            if not gone[n]:
                parts.setdefault(block, []).append(text)
        lines = {block: line for block, p in parts.items() if (line := " ".join("".join(p).split()))}
        number = {block: i for i, block in enumerate(lines)}
        before, seen = [0], 0  # lines begun before each piece
        for n, block, _ in self.pieces:
            if not gone[n] and number.get(block, -1) >= seen:
                seen = number[block] + 1
            before.append(seen)
        trees = [(h, before[a], before[z]) for h, (a, z), out, inside in zip(self.hash, self.span, gone, within, strict=True) if h and not out and not inside and before[z] > before[a]]
        return [signed(xxhash.xxh64_intdigest(line)) for line in lines.values()], [len(line) for line in lines.values()], trees


def signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def articles_beside(lines: list[int], sizes: list[int], trees: list[tuple[int, int, int]], recurring: list[int], known: frozenset[int] | set[int] = frozenset()) -> list[tuple[int, int]]:
    """(subtree, article) for the subtrees that a page speaks for: most of the text outside of it, and outside of
    ``known`` templates, is the page's own. The article is the smallest hash of the page's own lines there."""
    size, again = np.array(sizes, np.int64), np.zeros(len(lines), bool)
    again[recurring] = True
    for h, a, z in trees:
        if h in known:
            size[a:z], again[a:z] = 0, True
    total, repeated = (np.concatenate([[0], np.cumsum(x)]) for x in (size, size * again))
    most = np.iinfo(np.int64).max
    own = np.where(again, most, np.array(lines, np.int64))
    ahead = np.minimum.accumulate(np.concatenate([[most], own]))
    behind = np.minimum.accumulate(np.concatenate([own, [most]])[::-1])[::-1]
    found = []
    for h, a, z in trees:
        rest = total[-1] - (total[z] - total[a])
        own_rest = rest - (repeated[-1] - (repeated[z] - repeated[a]))
        if h not in known and total[z] > total[a] and own_rest > 0 and 2 * own_rest >= rest:
            found.append((h, int(min(ahead[a], behind[z]))))
    return found


def page_profiles(pages: DataFrame) -> DataFrame:
    """(row, host, page, lines, sizes, trees) of each page; ``page`` is its url's hash."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = pa.struct([("h", pa.int64()), ("a", pa.int32()), ("z", pa.int32())])
        for b in batches:
            hosts, profiles = [], []
            for url, source in zip(b.column(1), b.column(2), strict=True):
                hosts.append(host_of(url.as_py()))
                profiles.append(Page(source.as_py() or "").profile())
            trees = [[{"h": h, "a": a, "z": z} for h, a, z in t] for _, _, t in profiles]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(hosts, pa.string()), b.column(3), pa.array([p[0] for p in profiles], pa.list_(pa.int64())),
                 pa.array([p[1] for p in profiles], pa.list_(pa.int32())), pa.array(trees, pa.list_(tree))],
                names=["row", "host", "page", "lines", "sizes", "trees"],
            )

    rows = pages.select(F.monotonically_increasing_id().alias("row"), "url", "html", F.xxhash64("url").alias("page"))
    return rows.mapInArrow(scan, "row long, host string, page long, lines array<long>, sizes array<int>, trees array<struct<h:long,a:int,z:int>>")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, template): the hashes of each host's recurring subtrees, as a written table."""
    profiles = materialize(page_profiles(pages), "page-profiles")
    lines = profiles.select("row", "host", "page", F.posexplode("lines").alias("at", "line"))
    counts = lines.select("host", "page", "line").distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    often = counts.filter(F.col("n") >= min_pages).select("host", "line")
    again = lines.join(often, ["host", "line"], "left_semi").groupBy(F.col("row").alias("_row")).agg(F.collect_list("at").alias("again"))
    marked = materialize(profiles.join(again, F.col("row") == F.col("_row"), "left").select("host", "lines", "sizes", "trees", "again"), "page-lines")

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, found = [], []
            for host, hashes, sizes, trees, again, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                some = articles_beside(hashes, sizes, [(t["h"], t["a"], t["z"]) for t in trees], again or [], set(known or ()))
                hosts += [host] * len(some)
                found += some
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))], names=["host", "hash", "article"])

    known = None
    while True:  # as long as templates found let pages speak for others
        rows = marked.withColumn("known", F.lit(None).cast("array<long>")) if known is None else marked.join(known, "host").withColumnRenamed("template", "known")
        said = rows.select("host", "lines", "sizes", "trees", "again", "known").mapInArrow(beside, "host string, hash long, article long").distinct()
        new = materialize(said.groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages).select("host", "hash"), "page-templates")
        if known is not None and new.isEmpty():
            return known
        before = new if known is None else new.unionByName(known.select("host", F.explode("template").alias("hash")))
        known = materialize(before.groupBy("host").agg(F.sort_array(F.collect_set("hash")).alias("template")), "host-templates")
        if new.isEmpty():
            return known


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text) of each row of ``pages`` (page_id, url, html)."""
    # written first: Spark then knows its size, and doesn't shuffle the html for a join with a small table
    found = templates(pages, min_pages)
    rows = pages.select("page_id", "url", "html").withColumn("host", url_host(F.col("url"))).join(found, "host", "left")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, template = None, frozenset()
        for b in batches:
            texts = []
            for source, h, hashes in zip(b.column(2), b.column(3), b.column(4), strict=True):
                if h.as_py() != host:
                    host, template = h.as_py(), frozenset(hashes.as_py() or ())
                texts.append(Page(source.as_py() or "").text(template))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url", "html", "host", "template").mapInArrow(scan, f"page_id {id_type}, url string, text string")


def query(spark, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
