"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by URL path, and each is paired with its nearest neighbours. The text lines of a pair are aligned
by a longest common subsequence, and lines that both pages share are deleted: what a site repeats from page to page is
its template. Pages of a host with equal lines count once, so that each distinct page meets its nearest distinct neighbours. Pages
whose own lines are edits of each other are copies, and so are those that share most of their text and have no own lines. Then, and
where most of the text is shared, a line has to be shared by half of the host's other pairs as well. Markup limits this from both sides. Lines in menus, headers, footers, sidebars, adverts, forms, comments and the like
never become lines at all, and where a page marks its article, lines outside are left out and paragraphs inside are not deleted,
since articles quote and repeat each other too, unless the host gives evidence: paragraphs and long lines go if a URL neighbour has them at
an aligned place and so have at least ``FIRM_PAIRS`` and half of the host's pairs of pages that differ in their other lines.

Only 64-bit line hashes and URL keys are paired and shuffled; the lines themselves move once, to meet the
list of places to delete.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import stored

# Element names and the words of class, id and role names that mark parts outside the main text.
RAW = ["script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "noembed", "xmp"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
DROPPED = ["nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "label", "fieldset", "datalist"]
BLOCKS = [
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav",
    "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
]
PROSE = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
MARKS = (
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer gdpr legal login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion related reply replies respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe toolbar topbar widget"
).split()
HEADER_MARKS = ["header", "top", "banner"]
THREADS = ["comment", "comments", "disqus", "replies", "reply", "respond"]
ROLES = ["alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"]
CONTENT_MARKS = ["article", "articlebody", "content", "entry", "main", "post", "story"]

_RAW, _VOID, _DROPPED, _BLOCKS, _PROSE = map(frozenset, (RAW, VOID, DROPPED, BLOCKS, PROSE))
_MARKS, _HEADER, _ROLES, _CONTENT, _THREADS = map(frozenset, (MARKS, HEADER_MARKS, ROLES, CONTENT_MARKS, THREADS))
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|$)|<[a-zA-Z][^>]*(?:>|$)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_NAME = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
SHORT_WORDS = 8
COPY_SHARE = 0.8
ENDS = 3
FIRM_PAIRS = 4
SPREAD = 256

Line = tuple[str, bool]


def _marks(attributes: str) -> tuple[set[str], set[str], bool, bool]:
    """Words of class and id, roles, whether the element is hidden, and whether a whole name says that it is a marked part
    (``ad``, ``cookie-notice``; not ``has-sidebar``)."""
    names, roles, hidden, whole = set(), set(), False, False
    for name, a, b, c, flag in _ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name in ("class", "id"):
            for part in value.split():
                words = {x.lower() for x in re.split(r"[^A-Za-z0-9]+", part) if x}
                names |= words | {x.lower() for x in _NAME.findall(part)}
                whole = whole or bool(words) and words <= _MARKS - _HEADER
        elif name in ("role", "itemprop"):
            roles |= {x.lower() for x in value.split()}
        elif flag or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return names, roles, hidden, whole


class _Part:
    """An element that its class, id or role marks as no main text, until the whole page has been read."""

    def __init__(self, outer: _Part | None, wrapper: bool, thread: bool):
        self.outer, self.wrapper, self.thread = outer, wrapper, thread
        self.articles, self.size, self.long, self.kept = 0, 0, 0, False


def _keep_wrappers(top: list[_Part], articles: int, lines: list) -> None:
    """Marked parts that only wrap the page count as unmarked: those with its only article or main, and those outside of one
    that hold most of the text by a name that says something else as well (``has-sidebar``, ``top``). Comment threads never do.
    """
    marked = articles or any(zone and not part for _, zone, _, part in lines)
    total = sum(len(t) for t, *_ in lines if len(t.split()) >= SHORT_WORDS)
    for text, _, _, part in lines:
        while part:
            part.size += 1
            part.long += len(text) if len(text.split()) >= SHORT_WORDS else 0
            part = part.outer
    for part in top:  # outer parts come first
        if not part.thread and (not part.outer or part.outer.kept):
            alone = part.articles and not articles
            part.kept = bool(alone or part.wrapper and not marked and 2 * part.long > total)


def page_lines(page: str | None) -> list[Line]:
    """Candidate lines ``(text, deletable)`` in page order: blocks with white space folded and references decoded.

    If the page marks an article (``article``, ``itemprop``; else ``main`` or a content class) that holds at least half of its
    running text (lines of ``SHORT_WORDS`` words; all lines if there are none), only its lines; an article beside ``main`` counts as
    ``main`` does, and headings mark nothing. There a line is deletable by one pair of pages only if it is short and not in a
    paragraph, heading, list, table or quote.
    """
    page = page or ""
    lines: list[tuple[str, int, bool, _Part | None]] = []  # text, zone, in prose, innermost marked part
    stack: list[tuple[str, bool, int, bool, _Part | None, bool]] = []  # name, dropped, zone, prose, marked part, in main
    part: list[str] = []
    parts: list[_Part] = []
    at, dropped, zone, prose, marked, in_main = 0, False, 0, False, None, False
    articles, has_main = 0, False

    def flush() -> None:
        if part:
            text = " ".join(html.unescape("".join(part)).split())
            part.clear()
            if text:
                lines.append((text, zone, prose, marked))

    def settle() -> None:
        nonlocal dropped, zone, prose, marked, in_main
        _, dropped, zone, prose, marked, in_main = stack[-1] if stack else ("", False, 0, False, None, False)

    length = len(page)
    while at < length:
        m = _TAG.search(page, at)
        if not m:
            if not dropped:
                part.append(page[at:])
            break
        if m.start() > at and not dropped:
            part.append(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in _BLOCKS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if stack[k][1] != dropped or stack[k][4] is not marked or name in _BLOCKS:
                        flush()
                    del stack[k:]
                    settle()
                    break
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(page, at)
            at = page.find(">", end.start()) + 1 or length if end else length
            continue
        if name in _BLOCKS:
            flush()
            if stack and stack[-1][0] in ("p", *HEADINGS) or name == "li" and stack and stack[-1][0] == "li":
                stack.pop()  # a paragraph ends where a block begins
                settle()
        if name == "br":
            part.append(" ")
        if name in _VOID or m[3].endswith("/") and name not in _BLOCKS:
            continue
        new_dropped, new_zone = dropped or name in _DROPPED or name == "header" and zone < 2, zone
        new_part, new_main = marked, in_main or name == "main"
        if not new_dropped and m[3].strip():
            names, roles, hidden, whole = _marks(m[3])
            new_dropped = hidden
            out = bool(names & _MARKS or roles & _ROLES) or zone < 2 and bool(names & _HEADER) and name not in HEADINGS
            if out and name in ("html", "body", "article", "main"):
                out = name == "article" and bool(names & {"comment", "comments", "reply", "ad", "sponsored", "related"})
                new_dropped = out
            elif out:
                new_part = _Part(marked, not whole and not zone and not roles & _ROLES, bool(names & _THREADS))
                parts.append(new_part)
            new_main = new_main or "main" in roles
            if roles & {"articlebody", "article"}:
                new_zone = 2
            elif name not in HEADINGS and (roles & {"main"} or names & _CONTENT):
                new_zone = max(zone, 1)
        if name == "article":
            new_zone = 2
        elif name == "main":
            new_zone = max(new_zone, 1)
        if name in ("article", "main") and not new_dropped:
            has_main = has_main or name == "main"
            articles += not new_part
            outer = new_part
            while outer:
                outer.articles += 1
                outer = outer.outer
        if new_zone == 2 and not new_main:
            new_zone = 3  # settled when it is known whether the page has a main element
        if new_dropped != dropped or new_part is not marked:
            flush()
        stack.append((name, new_dropped, new_zone, prose and name not in ("div", "section") or name in _PROSE, new_part, new_main))
        settle()
    flush()
    if parts:
        _keep_wrappers(parts, articles, lines)
    outside = 1 if has_main else 2
    found = [(t, outside if z == 3 else z, p) for t, z, p, x in lines if not x or x.kept]
    weights = [len(t) if len(t.split()) >= SHORT_WORDS else 0 for t, _, _ in found]
    if not any(weights):
        weights = [len(t) for t, _, _ in found]
    for best in (2, 1):
        if sum(w for w, (_, z, _) in zip(weights, found, strict=True) if z >= best) * 2 >= max(sum(weights), 1):
            return [(t, not p and len(t.split()) < SHORT_WORDS) for t, z, p in found if z >= best]
    return [(t, True) for t, _, _ in found]


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists, by growing sequences over the matches (fast when few
    lines repeat)."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - end - 1, start - 1, -1):
        where.setdefault(b[j], []).append(j)
    tails: list[int] = []
    links: list[tuple | None] = []
    for i in range(start, len(a) - end):
        for j in where.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, j, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            elif j < tails[k]:
                tails[k], links[k] = j, link
    found, link = [], links[-1] if links else None
    while link:
        found.append(link[:2])
        link = link[2]
    tail = [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]
    return [(k, k) for k in range(start)] + found[::-1] + tail


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def _path(url: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", ""), r"[?#].*$", ""), F.lit(""))


def neighbours(keys: DataFrame) -> DataFrame:
    """``k1, k2, n1, n2, host``: each page (k1, k2, host, path) with the next one of its host in path order.

    The keys are sorted over range partitions; the pairs across two partitions come from each partition's first and last
    key, a table with one row per partition. A host of any size is spread over many tasks.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "k1", "k2"]
    dealt = stored(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "url-order")
    row = F.struct(*order)
    inside = dealt.withColumn("_next", F.lead(row).over(Window.partitionBy("part").orderBy(*order)))
    ends = dealt.groupBy("part").agg(F.min(row).alias("_low"))
    ends = ends.select("part", F.lead("_low").over(Window.orderBy("part")).alias("_over"))  # one row per partition
    paired = inside.join(F.broadcast(ends), "part").withColumn("_n", F.coalesce("_next", "_over"))
    paired = paired.where(F.col("_n.host") == F.col("host"))
    return paired.select("k1", "k2", F.col("_n.k1").alias("n1"), F.col("_n.k2").alias("n2"), "host")


def _hashes(lines: list[Line]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(t) for t, _ in lines], np.uint64).view(np.int64)


def _list_hash(hashes: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64))


def _ends(text: str) -> int:
    """The first and the last words of a line as two 16-bit hashes, 0 for a short line."""
    words = text.split(" ")
    if len(words) < SHORT_WORDS:
        return 0
    head, tail = (zlib.crc32(" ".join(w).encode("utf-8", "replace")) & 0xFFFF for w in (words[:ENDS], words[-ENDS:]))
    return (head << 16 | tail) - (1 << 31)


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [page_lines(p.as_py()) for p in batch["html"]]
        hashes = [_hashes(x) for x in lines]
        yield pa.RecordBatch.from_arrays(
            [batch["h"], batch["path"], pa.array([_list_hash(x) for x in hashes], pa.int64()), pa.array(hashes, pa.list_(pa.int64())),
             pa.array([[len(t) for t, _ in x] for x in lines], pa.list_(pa.int32())),
             pa.array([[_ends(t) for t, _ in x] for x in lines], pa.list_(pa.int32()))],
            ["h", "path", "d", "lines", "sizes", "ends"],
        )


def differ(own_a: list[tuple[int, int]], own_b: list[tuple[int, int]]) -> bool:
    """Whether both pages have lines ``(size, ends)`` of their own that are no edits of the other's: lines with the same first or
    last words hold less than half of them."""
    if not own_a or not own_b:
        return False
    for x, y in ((own_a, own_b), (own_b, own_a)):
        heads, tails = {e >> 16 for _, e in y if e}, {e & 0xFFFF for _, e in y if e}
        edits = sum(n for n, e in x if e and (e >> 16 in heads or e & 0xFFFF in tails))
        if 2 * edits >= sum(n for n, _ in x):
            return False
    return True


def _share_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ("k1", "n1", "h", "a", "b", "sa", "sb", "ea", "eb")
    for batch in batches:
        rows = []
        d = batch.to_pydict()
        for k1, n1, h, a, b, sa, sb, ea, eb in zip(*(d[c] for c in columns), strict=True):
            pairs = common_lines(a, b)
            i, j = [x for x, _ in pairs], [y for _, y in pairs]
            in_a, in_b = set(i), set(j)
            own_a = [(n, e) for k, (n, e) in enumerate(zip(sa, ea, strict=True)) if k not in in_a]
            own_b = [(n, e) for k, (n, e) in enumerate(zip(sb, eb, strict=True)) if k not in in_b]
            differs = differ(own_a, own_b)
            edited = bool(own_a and own_b) and not differs
            near = edited or sum(sa[x] for x in i) >= COPY_SHARE * max(sum(sa), sum(sb))
            rows.append((k1, n1, h, near, differs, i, j, [a[x] for x in i]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["k1", "n1", "h", "near", "differ", "i", "j", "lines"])


def _text_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [page_lines(p.as_py()) for p in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], batch["h"], pa.array([_list_hash(_hashes(x)) for x in lines], pa.int64()),
             pa.array([[t for t, _ in x] for x in lines], pa.list_(pa.string())),
             pa.array([[k for k, (_, d) in enumerate(x) if d] for x in lines], pa.list_(pa.int32()))],
            ["page_id", "url", "h", "d", "lines", "open"],
        )


def _spread_join(rows: DataFrame, table: DataFrame, on: list[str], sizes: DataFrame, salt: Column) -> DataFrame:
    """Left join with a ``table`` that is unique on ``on``. ``sizes`` (on, size) tells how many rows a key has: keys with more than
    ``SPREAD`` rows, of which there are few, are cut into cells, and the table's row goes to each cell."""
    hot = F.broadcast(sizes.where(F.col("size") > SPREAD).select(*on, F.ceil(F.col("size") / SPREAD).cast("int").alias("_cells")))
    cells = F.coalesce("_cells", F.lit(1))
    left = rows.join(hot, on, "left").withColumn("_cell", F.pmod(salt, cells).cast("int")).drop("_cells")
    right = table.join(hot, on, "left").withColumn("_cell", F.explode(F.sequence(F.lit(0), cells - 1))).drop("_cells")
    return left.join(right, [*on, "_cell"], "left").drop("_cell")


def _templates(told: DataFrame) -> DataFrame:
    """``h, size, pairs, template, firm``: the pairs of each host, those whose lines differ, and the lines that at least two
    (``firm``: ``FIRM_PAIRS``) and half of these share. A list has at most twice as many lines as a pair shares on average."""
    hosts = told.groupBy("h").agg(F.count("*").alias("size"), F.sum(F.col("differ").cast("long")).alias("pairs"))
    seen = told.where("differ").select("h", F.explode(F.array_distinct("lines")).alias("line"))
    seen = seen.groupBy("h", "line").agg(F.count("*").alias("n")).where("n >= 2")
    seen = _spread_join(seen, hosts.select("h", "pairs"), ["h"], hosts.select("h", "size"), F.col("line"))
    firm = F.collect_list(F.when(F.col("n") >= FIRM_PAIRS, F.col("line"))).alias("firm")
    found = seen.where("2 * n >= pairs").groupBy("h").agg(F.collect_list("line").alias("template"), firm)
    return hosts.join(found, "h", "left")


def _page_places(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``d, h, loose, firm`` for each distinct list of lines of a host: places of lines to delete where they are deletable, and of those
    to delete anywhere; and ``d, h, size``, the number of pages with that list."""
    hashed = pages.select("h", "path", "html").mapInArrow(
        _hash_lines, "h long, path string, d long, lines array<long>, sizes array<int>, ends array<int>"
    )
    distinct = hashed.groupBy("d", "h").agg(
        F.min("path").alias("path"), F.count("*").alias("size"), *[F.first(c).alias(c) for c in ("lines", "sizes", "ends")]
    )
    distinct = stored(distinct, "line-lists")
    some = distinct.where(F.size("lines") > 0)
    pairs = neighbours(some.select(F.col("d").alias("k1"), F.col("h").alias("k2"), F.col("h").alias("host"), "path"))
    lists = [F.col("lines"), F.col("sizes"), F.col("ends")]
    left = some.select(F.col("d").alias("k1"), "h", *[c.alias(n) for c, n in zip(lists, ("a", "sa", "ea"), strict=True)])
    right = some.select(F.col("d").alias("n1"), "h", *[c.alias(n) for c, n in zip(lists, ("b", "sb", "eb"), strict=True)])
    both = pairs.select("k1", "n1", F.col("host").alias("h")).join(left, ["k1", "h"]).join(right, ["n1", "h"])
    told = both.mapInArrow(
        _share_lines, "k1 long, n1 long, h long, near boolean, differ boolean, i array<int>, j array<int>, lines array<long>"
    )
    told = stored(told, "shared-lines")
    hosts = stored(_templates(told), "templates")
    rows = _spread_join(told, hosts.drop("size"), ["h"], hosts.select("h", "size"), F.col("k1"))
    every = ~F.col("near") | F.col("differ") & (F.col("pairs") == 1)

    def chosen(places: str, lines: str) -> Column:
        held = F.filter(places, lambda _, k: F.array_contains(lines, F.get("lines", k)))
        return F.when(F.col(lines).isNull(), F.array().cast("array<int>")).otherwise(held)

    def side(page: str, places: str) -> DataFrame:
        loose = F.when(every, F.col(places)).otherwise(chosen(places, "template"))
        return rows.select(F.col(page).alias("d"), "h", loose.alias("loose"), chosen(places, "firm").alias("firm"))

    sides = side("k1", "i").unionByName(side("n1", "j")).where((F.size("loose") > 0) | (F.size("firm") > 0))
    places = sides.groupBy("d", "h").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("loose", "firm")])
    return places, distinct.select("d", "h", "size")


def _split_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, lines, gone``: the lines of every page and the places of those to delete."""
    keyed = pages.select("page_id", "url", "html", F.xxhash64(_host(F.col("url"))).alias("h"), _path(F.col("url")).alias("path"))
    places, sizes = _page_places(keyed)
    out = "page_id long, url string, h long, d long, lines array<string>, open array<int>"
    lines = keyed.select("page_id", "url", "h", "html").mapInArrow(_text_lines, out)
    lines = _spread_join(lines, places, ["d", "h"], sizes, F.xxhash64("page_id", "url"))
    none = F.array().cast("array<int>")
    loose = F.array_intersect("open", F.coalesce("loose", none))
    return lines.withColumn("gone", F.array_union(loose, F.coalesce("firm", none)))


def deleted_lines(pages: DataFrame) -> DataFrame:
    """``pages, lines, deleted, deleted_on_host_evidence``: one row that says how many lines differencing deletes from ``pages``, and how
    many of them only because the host repeats them."""
    rows = _split_pages(pages)
    firm = F.size(F.array_except("gone", "open"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in (F.size("lines"), F.size("gone"), firm)]
    names = ("lines", "deleted", "deleted_on_host_evidence")
    return rows.agg(F.count("*").alias("pages"), *[c.alias(n) for c, n in zip(sums, names, strict=True)])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (page_id, url, html).

    Null and empty html give an empty text; pages without a host are a host of their own; pages of a host with equal lines have one
    place in the order, at their first path, and equal deletions. Other columns are not read.
    """
    lines = _split_pages(pages)
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(
        F.filter("lines", lambda x, k: ~F.array_contains(F.col("gone"), k))
    )
    text = lines.select("page_id", "url", F.array_join(kept, " ").alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
