"""Main text of web pages by differencing with the nearest page of the host.

A page is read into lines, one per block element, each with the part of the
page it stands in: article body, marked boilerplate (menus, headers, footers,
sidebars, notices, adverts, forms, comments) or neither.  Pages are put in
order of URL path, then query, within their host; a page is paired with the
neighbour in that order whose path and query share the longer prefix.  The lines of the pair are
aligned by longest common subsequence and the shared ones deleted: what two
pages of a site have in common, in the same order, is its template.

Two limits keep article text whole.  Lines inside a page's own article element
are never deleted as shared, since an article may quote or repeat another
page's; and a neighbour beside which nothing unmarked is left is a copy of the
page and says nothing about the template, so the next one is asked.  One that
shares almost all unmarked text is a near copy or has the same large template:
what the other neighbour shares too is deleted, or, if that one shares nothing,
what the first does.
After differencing, what is left of the marked boilerplate goes too (menus that
differ from page to page are not shared), and if an article or main element holds
most of the rest (or no neighbour is known), only its lines stay.

How the work is spread.  Distinct (host, path with query) keys are put in order by a range
shuffle and numbered, so a host that holds a third of all pages is cut like any
other; neighbours are found by joins on that number, and only line hashes of
one page per key travel to them.  Page texts are shuffled once, compressed, to meet
their neighbours' hashes; that join's right side is unique, so Spark can split a hot
path.

Defined results: null or empty html gives an empty text; a page without a URL
or alone on its host has no neighbour and is judged by its structure; repeated
rows each give a row; pages with equal host, path and query have one representative,
that of the smallest page id (a null id only if there is no other).
"""

from __future__ import annotations

import hashlib
import html
import os.path
import re
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import in_order, written

FREE, BODY, BOILER, NAMED = 0, 1, 2, 3
COPY = 0.8

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = re.compile(r"[a-z0-9]+")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_IMPLIED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
_BOILER_TAGS = {"head", "nav", "header", "footer", "aside", "form", "select", "button", "menu", "dialog", "svg", "object", "canvas", "audio", "video"}
_BODY_TAGS = {"article", "main"}
_BOILER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments respond reply replies disqus footer header masthead share sharing "
    "social related recommended widget login signup search toolbar pagination pager copyright responses".split()
)
#: Words beside which a boilerplate name still names boilerplate (share-buttons); any other makes it another name (related-work).
_PLAIN_NAMES = set(
    "area bar block body bottom box btn button buttons container content form group inner item left link links list outer page panel reader readers right section site slot thread title top unit "
    "user users visitor visitors wrap wrapper".split()
)
#: Lists of these hold article elements that are not the page's article.
_LIST_NAMES = set("comment comments respond reply replies responses disqus related recommended".split())
#: Reader comments and adverts are these on any block and by id too, also inside an article.
_FOREIGN_NAMES = set("comment comments respond reply replies responses disqus ad ads adv advert adverts advertisement advertising adsense sponsor sponsored".split())
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_BOXES = {"div", "aside", "section", "ul", "ol", "dl", "table", "figure", "span"}
_BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "alertdialog", "menu", "menubar"}


def _boiler_name(whole: str) -> set[str]:
    """The boilerplate names in a class or id, if nothing else is in it."""
    parts = set(_NAMES.findall(whole))
    found = parts & _BOILER_NAMES
    return found if parts <= found | _PLAIN_NAMES else set()


def _mark(name: str, attributes: str, in_body: bool) -> int:
    """What an element's tag and attributes say about the text in it.

    NAMED is boilerplate by a class or id alone, which does not hold for an
    article in it.
    """
    if name in _BOILER_TAGS and not (name == "header" and in_body):
        return BOILER
    if "=" in attributes or "hidden" in attributes:
        found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in _BOILER_ROLES or _HIDDEN.search(found.get("style", "")):
            return BOILER
        if name in _BODY_TAGS or found.get("role") in ("main", "article") or found.get("itemprop") == "articlebody":
            return BODY
        if name not in ("html", "body"):
            classes, ids = (set().union(*map(_boiler_name, found.get(c, "").split())) for c in ("class", "id"))
            if not in_body:
                named = classes if name in _HEADINGS else classes | ids
            else:  # most ids in an article are anchors, and its small elements have names of their own
                named = (classes if name in _BOXES else set()) - {"header"}
                if name not in _INLINE | _HEADINGS | {"pre"}:
                    named |= (classes | (ids if name in _BOXES else set())) & _FOREIGN_NAMES
            if named:
                return BOILER if named & _LIST_NAMES else NAMED
    return BODY if name in _BODY_TAGS else FREE


class _Reader:
    """Collects the lines of one page."""

    def __init__(self):
        self.lines: list[tuple[str, int]] = []
        self.run: list[str] = []
        self.open: list[tuple[str, int]] = []
        self.count: dict[str, int] = {}
        self.depth = [0, 0, 0, 0]
        self.named = [0]  # NAMED elements around every open BODY one

    def in_boiler(self) -> bool:
        return self.depth[BOILER] > 0 or self.depth[NAMED] > self.named[-1]

    def end_line(self) -> None:
        text = " ".join(html.unescape("".join(self.run)).split())
        self.run = []
        if text:
            self.lines.append((text, BOILER if self.in_boiler() else BODY if self.depth[BODY] else FREE))

    def push(self, name: str, attributes: str) -> None:
        mark = _mark(name, attributes, self.depth[BODY] > 0)
        self.open.append((name, mark))
        self.count[name] = self.count.get(name, 0) + 1
        self.depth[mark] += 1
        if mark == BODY:
            self.named.append(self.depth[NAMED])

    def pop(self, name: str) -> None:
        if self.count.get(name):
            while True:
                last, mark = self.open.pop()
                self.count[last] -= 1
                self.depth[mark] -= 1
                if mark == BODY:
                    self.named.pop()
                if last == name:
                    return

    def close_implied(self, name: str) -> None:
        """A new paragraph or item ends the one before it, if nothing but inline elements is open in that."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                self.pop(name)
                return
            if self.open[k][0] not in _INLINE:
                return


def read_lines(page: str | None) -> list[tuple[str, int]]:
    """(text, part of the page) of every non-empty block of a page, in order."""
    reader, at = _Reader(), 0
    page = page or ""
    while m := _TAG.search(page, at):
        if m.start() > at:
            reader.run.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name in _RAW and not closing:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            reader.run.append(" ")
            continue
        if name not in _INLINE:
            reader.end_line()
        if closing:
            if reader.in_boiler() and name in _INLINE:
                reader.end_line()
            reader.pop(name)
        elif name not in _VOID and not attributes.rstrip().endswith("/"):
            if name in _IMPLIED:
                reader.close_implied(name)
            if name in _INLINE and _mark(name, attributes, reader.depth[BODY] > 0) in (BOILER, NAMED):
                reader.end_line()
            reader.push(name, attributes)
    reader.run.append(page[at:])
    reader.end_line()
    return reader.lines


def url_key(url: str | None) -> tuple[str | None, str]:
    """(host, path) of a URL; the path without fragment, ending and last slash, and the query after a NUL.

    So keys in order are in order of path, then query, and a page's longest
    common prefixes are with the pages of its own path.
    """
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").lower()
    except ValueError:
        return None, ""
    path = re.sub(r"\.[a-z]{3,5}$", "", parts.path.rstrip("/"))
    return host or None, f"{path}\0{parts.query}" if parts.query else path


def line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Lengths of the longest common subsequence of ``a`` with every prefix of ``b``."""
    places: dict[int, int] = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out, n = [0], 0
    for bit in reversed(bin(v | 1 << len(b))[3:]):
        n += bit == "0"
        out.append(n)
    return out


def shared_lines(a: list[int], b: list[int]) -> list[bool]:
    """For each line of ``a``, whether the alignment with ``b`` matches it."""
    out = [False] * len(a)
    low, end_a, end_b = 0, len(a), len(b)
    while low < min(end_a, end_b) and a[low] == b[low]:
        out[low] = True
        low += 1
    while end_a > low and end_b > low and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
        out[end_a] = True
    both = set(a[low:end_a]) & set(b[low:end_b])
    left = [k for k in range(low, end_a) if a[k] in both]
    right = [x for x in b[low:end_b] if x in both]
    work = [(left, right)]
    while work:
        places, other = work.pop()
        if not places or not other:
            continue
        if len(places) == 1:
            out[places[0]] = a[places[0]] in other
            continue
        half = len(places) // 2
        first, second = places[:half], places[half:]
        ahead = _lengths([a[k] for k in first], other)
        behind = _lengths([a[k] for k in reversed(second)], other[::-1])[::-1]
        cut = max(range(len(other) + 1), key=lambda j: ahead[j] + behind[j])
        work += [(first, other[:cut]), (second, other[cut:])]
    return out


def main_text(lines: list[tuple[str, int]], hashes: list[int], neighbours: list[list[int]]) -> tuple[str, int]:
    """(text, number of lines deleted as shared) given the neighbours' line hashes, nearest first."""
    shared = [False] * len(lines)
    own = [k for k, (_, mark) in enumerate(lines) if mark != BOILER]
    views = [shared_lines(hashes, other) for other in neighbours]
    views = [flags for flags in views if not own or not all(flags[k] for k in own)]  # a copy leaves nothing
    if views:
        shared = views[0]
        size = sum(len(lines[k][0]) for k in own)
        same = sum(len(lines[k][0]) for k in own if shared[k])
        if same >= COPY * size and all(lines[k][1] == FREE or shared[k] for k in own) and any(any(flags[k] for k in own) for flags in views[1:]):
            shared = [all(x) for x in zip(*views, strict=True)]
    gone = [s and mark != BODY for (_, mark), s in zip(lines, shared, strict=True)]
    left = [x for x, g in zip(lines, gone, strict=True) if not g and x[1] != BOILER]
    in_body, outside = (sum(len(t) for t, mark in left if mark == kind) for kind in (BODY, FREE))
    if in_body and (not views or in_body >= outside):
        left = [x for x in left if x[1] == BODY]
    return "\n\n".join(t for t, _ in left), sum(gone)


def _keys(batches):
    for batch in batches:
        page_ids, urls, pages = (batch.column(k).to_pylist() for k in range(3))
        keys = [url_key(u) for u in urls]
        lines = [read_lines(p) for p in pages]
        hashes = [[line_hash(t) for t, _ in x] for x in lines]
        content = [line_hash("\n".join(t for t, mark in x if mark != BOILER)) for x in lines]
        yield pa.RecordBatch.from_arrays(
            [pa.array(page_ids, batch.schema.field(0).type), pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(hashes, pa.list_(pa.int64())), pa.array(content, pa.int64())],
            ["page_id", "host", "path", "hashes", "content"],
        )


def _parsed(batches):
    for batch in batches:
        page_ids, urls, pages = (batch.column(k).to_pylist() for k in range(3))
        keys = [url_key(u) for u in urls]
        lines = [read_lines(p) for p in pages]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.string()),
                pa.array([zlib.compress("\n".join(t for t, _ in x).encode(), 6) for x in lines], pa.binary()),  # no line holds a line end
                pa.array(["".join(str(m) for _, m in x) for x in lines], pa.string()),
            ],
            ["page_id", "url", "host", "path", "lines", "marks"],
        )


def _nearest_first(path: str, around: list[tuple[str | None, list[int] | None]]) -> list[list[int]]:
    known = [(p, h) for p, h in around if h is not None]
    known.sort(key=lambda x: -len(os.path.commonprefix([path, x[0] or ""])))
    return [h for _, h in known]


def _extracted(batches):
    for batch in batches:
        columns = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names) if k > 1}
        texts, line_count, deleted = [], [], []
        for k in range(batch.num_rows):
            marks = columns["marks"][k]
            lines = list(zip(zlib.decompress(columns["lines"][k]).decode().split("\n"), map(int, marks), strict=True)) if marks else []
            around = [(columns["path_before"][k], columns["hashes_before"][k]), (columns["path_after"][k], columns["hashes_after"][k])]
            text, n = main_text(lines, [line_hash(t) for t, _ in lines], _nearest_first(columns["path"][k], around))
            texts.append(text)
            line_count.append(len(lines))
            deleted.append(n)
        n_chars = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), n_chars, pa.array(line_count, pa.int64()), pa.array(deleted, pa.int64())],
            ["page_id", "url", "text", "n_chars", "n_lines", "n_shared"],
        )


def _neighbours(known: DataFrame) -> DataFrame:
    """Per (host, path) the nearest keys before and after it whose unmarked lines are not the same as its own.

    Keys of equal lines at adjacent places are one run, whose neighbours are
    the key before its first and the key after its last.
    """
    places = known.select("host", "place", "content")
    last = places.select("host", (F.col("place") + 1).alias("place"), F.col("content").alias("content_before"))
    starts = places.join(last, ["host", "place"], "left").where("content_before IS NULL OR content <> content_before").select("host", F.col("place").alias("start"))
    runs = written(in_order(starts, F.col("start")).withColumnRenamed("place", "run"), "page-runs")
    following = runs.select((F.col("run") - 1).alias("run"), F.col("start").alias("next"), F.col("host").alias("next_host"))
    spans = runs.join(following, "run", "left").withColumn("next", F.coalesce("next", F.lit(known.count())))
    for side, place in (("before", F.col("start") - 1), ("after", F.col("next"))):
        other = known.select("host", F.col("place").alias(f"place_{side}"), F.col("path").alias(f"path_{side}"), F.col("hashes").alias(f"hashes_{side}"))
        spans = spans.withColumn(f"place_{side}", place).join(other, ["host", f"place_{side}"], "left")
    found = ["path_before", "hashes_before", "path_after", "hashes_after"]
    each = spans.select("host", F.explode(F.sequence("start", F.col("next") - 1)).alias("place"), *found)
    return known.select("host", "path", "place").join(each, ["host", "place"]).select("host", "path", *found)


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars, its number of lines and of those deleted as shared."""
    picked = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"), pages[body].cast("string").alias("html"))
    kind = picked.schema["page_id"].dataType.simpleString()
    keyed = picked.mapInArrow(_keys, f"page_id {kind}, host string, path string, hashes array<long>, content long").where("host IS NOT NULL")
    chosen = F.min_by(F.struct("hashes", "content"), F.struct(F.col("page_id").isNull(), "page_id", "hashes")).alias("page")
    first = written(keyed.groupBy("host", "path").agg(chosen).select("host", "path", "page.hashes", "page.content"), "page-lines")
    near = _neighbours(in_order(first, F.col("host"), F.col("path")))
    parsed = picked.mapInArrow(_parsed, f"page_id {kind}, url string, host string, path string, lines binary, marks string")
    joined = parsed.join(near, ["host", "path"], "left")
    order = ["page_id", "url", "host", "path", "lines", "marks", "path_before", "hashes_before", "path_after", "hashes_after"]
    return joined.select(*order).mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_chars long, n_lines long, n_shared long")
