"""Main text of web pages by nearest-URL page differencing.

Each page is read into blocks of text: those inside an article or main element,
those inside elements that are never the article (menus, headers, footers,
sidebars, forms, adverts, notices, reader comments, scripts, styles), and those
in neither.  Pages are ordered by URL path within each host, by a distributed
sort; a page's partner is the nearest page before or after it in that order
that has other lines than itself, of the two the one whose path shares the longer
prefix.  All lines but those of the second kind are aligned with the partner's
by longest common subsequence, and shared ones are deleted if they recur: if
``RECURS`` pages of the host, copies counted once, have them.  So copies of a
page at neighbouring URLs don't delete each other's text.

Lines inside an article element are not deleted: neighbouring pages may carry
copies of an article or repeat a passage, which is text all the same.  Only
those are decided by differencing that stand in an element whose id or compound
class has a word such as "related" or "notice" in it.  A page's
text is its article lines and the other lines that are left, in page order; on
a page whose lines are all an article's, differencing has nothing to decide.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ROW_ID, bounded, running_before, stash

#: Different pages of a host that a line is on before it can be deleted: the page, its partner and another one.
RECURS = 3
# Element names and class words of the HTML vocabulary.
RAW = {"script", "style", "title", "textarea", "iframe", "noscript", "template", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
MAIN = {"article", "main"}
SKIP = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "datalist"}
HINTS = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
         "cookie", "cookies", "copyright", "disclaimer", "footer", "header", "login", "masthead", "menu", "modal", "nav",
         "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promotion", "related",
         "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar",
         "widget"}

# a quote opens a value after an equals sign only: elsewhere it is a character like any other
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TELLING = re.compile(r"class|id|role|style|hidden", re.I)


def _mark(name: str, attributes: str, inside: bool) -> str:
    """"mark" if an element is marked as something else than the article, or hidden; "doubt" if it may be; or "".

    inside: of an article.  There only whole values of class and role mark an
    element; a word of a compound class or of an id makes its lines doubtful,
    so that differencing decides on them.
    """
    if not attributes or name in ("html", "body") or not _TELLING.search(attributes):
        return ""
    doubt = ""
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key not in ("class", "id", "role", "style", "hidden", "aria-hidden"):
            continue  # names are compared whole; a value belongs to its name
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "mark"
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "mark"
        elif (hints := HINTS.intersection(re.split(r"[^a-z]+", value))) and not (inside and hints == {"header"}):
            if not inside or key in ("class", "role") and (HINTS - {"header"}).intersection(value.split()):
                return "mark"
            doubt = "doubt"
    return doubt


class _Open:
    """The open elements that matter, innermost last, with where each name stands among them."""

    def __init__(self):
        self.stack: list[tuple[str, str]] = []  # (name, "main", "tag", "mark", "doubt" or "")
        self.places: dict[str, list[int]] = defaultdict(list)
        self.n = {"main": 0, "tag": 0, "mark": 0, "doubt": 0, "": 0}
        self.blocks = 0

    def push(self, name: str, kind: str) -> None:
        self.places[name].append(len(self.stack))
        self.stack.append((name, kind))
        self.n[kind] += 1
        self.blocks += name in BLOCK

    def pop(self) -> None:
        name, kind = self.stack.pop()
        self.places[name].pop()
        self.n[kind] -= 1
        self.blocks -= name in BLOCK

    @property
    def shown(self) -> bool:
        return not self.n["tag"] and not self.n["mark"]


def lines(page: str) -> list[tuple[str, bool]]:
    """(block, whether an article surely holds it) in page order; white space is one space, references are decoded.

    Blocks begin and end at block elements only: an inline element that is
    hidden or marked leaves its text out of the block around it.
    """
    out: list[tuple[str, bool]] = []
    run: list[str] = []
    open_ = _Open()
    n, stack = open_.n, open_.stack

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                out.append((text, n["main"] > 0 and not n["doubt"]))

    def close(k: int) -> None:
        """Close the elements from place k on; a block among them ends here."""
        blocks = open_.blocks
        if blocks and any(x[0] in BLOCK for x in stack[k:]):
            flush()
        while len(stack) > k:
            open_.pop()

    at, lower = 0, None
    for m in iter(lambda: _TOKEN.search(page, at), None):
        if m.start() > at and open_.shown:
            run.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        if m[1]:  # an end tag
            if open_.places[name]:
                close(open_.places[name][-1])
            continue
        attributes = m[3]
        if name in ("svg", "math") and attributes.endswith("/"):  # these two may close themselves
            continue
        if name in RAW:
            lower = lower or page.lower()
            if len(lower) != len(page):  # a letter whose lower case is longer
                lower = re.sub(r"[A-Z]", lambda x: x[0].lower(), page)
            end = lower.find(f"</{name}", at)
            at = len(page) if end < 0 else end
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        if name in BLOCK and stack and stack[-1][0] == "p":  # a paragraph ends where a block begins
            close(len(stack) - 1)
        if name in MAIN and not n["mark"]:
            while stack and stack[-1][1] == "tag":  # a menu that was never closed
                close(len(stack) - 1)
        mark = _mark(name, attributes, n["main"] > 0)
        if name not in BLOCK and mark == "doubt":
            mark = ""  # the block around it decides
        kind = (mark if mark == "mark" else "main" if name in MAIN and not mark else
                "tag" if name in SKIP and not (name == "header" and n["main"]) else mark)
        if kind or open_.places[name]:
            if kind == "main":
                flush()
            open_.push(name, kind)
    if open_.shown:
        run.append(page[at:])
    flush()
    return out


def blocks(page: str) -> tuple[list[str], list[str]]:
    """(article blocks, other blocks), each in page order."""
    found = lines(page)
    return [x for x, held in found if held], [x for x, held in found if not held]


#: Pairs of equal lines, for each line of both pages, up to which they are looked at one by one.
PAIRS_PER_LINE = 32


def _by_pairs(a: list, b: list) -> list[int]:
    """One longest common subsequence, from the pairs of equal lines (Hunt and Szymanski)."""
    where = defaultdict(list)
    for j, x in enumerate(b):
        where[x].append(j)
    tails: list[int] = []  # smallest end in b of a common subsequence of each length
    nodes: list[tuple] = []  # its last pair and what came before
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(tails, j)
            node = (i, nodes[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                nodes.append(node)
            elif j < tails[k]:
                tails[k], nodes[k] = j, node
    out, node = [], nodes[-1] if nodes else None
    while node:
        out.append(node[0])
        node = node[1]
    return out[::-1]


def _lengths(a: list, b: list) -> np.ndarray:
    """Longest common subsequence of a and each prefix of b: a row of the table as the bits of one integer."""
    masks: dict = defaultdict(int)
    for j, x in enumerate(b):
        masks[x] |= 1 << j
    full = (1 << len(b)) - 1
    row = full  # bit j is 0 where the length grows at j
    for x in a:
        hit = row & masks.get(x, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.append(0, np.cumsum(bits == 0))


def common_lines(a: list, b: list) -> list[int]:
    """Positions in a of one longest common subsequence with b.

    Equal heads and tails belong to one.  In between, where lines are equal to
    very many others, a is halved and b is cut where the halves' lengths add up to
    most (Hirschberg), until there are few pairs; lengths are counted bit-parallel.
    """
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append(k)
        if i == k or j == m:
            continue
        left, right = a[i:k], b[j:m]
        counts = Counter(right)
        if sum(counts[x] for x in left) <= PAIRS_PER_LINE * (len(left) + len(right)) or len(left) == 1:
            out += [i + p for p in _by_pairs(left, right)]
            continue
        half = len(left) // 2
        ahead = _lengths(left[:half], right) + _lengths(left[half:][::-1], right[::-1])[::-1]
        cut = int(ahead.argmax())
        todo += [(i, i + half, j, j + cut), (i + half, k, j + cut, m)]
    return sorted(out)


def _place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL (empty if it has none)."""
    try:
        parts = urlsplit(url or "")
        return (parts.netloc or "").lower(), re.sub(r"\.html?$", "", parts.path.rstrip("/"))
    except ValueError:
        return "", url or ""


def _read(pages: DataFrame, kind: str) -> DataFrame:
    """Per page: row id, page_id, url, host, path, hashes of its lines; the lines and the places of those in no article, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in bounded(batches, 3):
            hosts, paths, texts, free, hashes = [], [], [], [], []
            for url, page in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                host, path = _place(url)
                found = lines(page or "")
                hosts.append(host)
                paths.append(path)
                free.append([i for i, (_, held) in enumerate(found) if not held] or None)
                texts.append([x for x, _ in found] if free[-1] else None)
                hashes.append(np.array([xxh64_intdigest(x) for x, _ in found], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(texts, pa.list_(pa.string())), pa.array(free, pa.list_(pa.int32())),
                 pa.array(hashes, pa.list_(pa.int64()))],
                names=[ROW_ID, "page_id", "url", "host", "path", "texts", "free", "lines"])

    return pages.mapInArrow(run, f"{ROW_ID} long, page_id {kind}, url string, host string, path string, "
                                 "texts array<string>, free array<int>, lines array<long>")


def _articles(pages: DataFrame, kind: str) -> DataFrame:
    """page_id, url, text of the pages that have no line outside an article: no other page has a say in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 2):
            at, texts = [], []
            for i, page in enumerate(batch.column(2).to_pylist()):
                found = lines(page or "")
                if all(held for _, held in found):
                    at.append(i)
                    texts.append("\n".join(x for x, _ in found))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    return pages.mapInArrow(run, f"page_id {kind}, url string, text string")


def _alike(a: str, b: str) -> int:
    """Length of the common prefix of two paths."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _shared(frame: DataFrame) -> DataFrame:
    """(row id, host, at, line): the lines in no article that a page's partner has, and their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hosts, places, hashes = [], [], [], []
            for r in batch.to_pylist():
                near = [(_alike(r["path"], x["path"]), x["lines"]) for x in (r["before"], r["after"])
                        if x is not None and x["host"] == r["host"]]
                shared = common_lines(r["lines"], max(near, key=lambda x: x[0])[1]) if near else []
                for i in sorted(set(shared).intersection(r["free"])):
                    rows.append(r[ROW_ID])
                    hosts.append(r["host"])
                    places.append(i)
                    hashes.append(r["lines"][i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(hosts, pa.string()), pa.array(places, pa.int32()),
                 pa.array(hashes, pa.int64())], names=["gone_row", "host", "at", "line"])

    return frame.mapInArrow(run, "gone_row long, host string, at int, line long")


def _in_runs(placed: DataFrame) -> DataFrame:
    """``placed`` with ``run``, the number of each stretch of pages of one host and the same lines, and whether a page is its first or last."""
    beside = lambda name, step: placed.select(
        (F.col("place") + step).alias("place"), F.lit(True).alias(name), F.col("host").alias(f"{name}_host"),
        F.col("sequence").alias(f"{name}_sequence"))
    other = lambda name: F.col(name).isNull() | (F.col(f"{name}_host") != F.col("host")) | (
        F.col(f"{name}_sequence") != F.col("sequence"))
    ends = (placed.join(beside("before", 1), "place", "left").join(beside("after", -1), "place", "left")
            .select(*placed.columns, other("before").alias("first"), other("after").alias("last")))
    runs = running_before(ends, [F.col("place")], {"run": F.col("first").cast("long")}).drop("run_total")
    return runs.withColumn("run", F.col("run") + F.col("first").cast("long"))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Null or empty html gives an empty text.  Pages without a host (null or odd
    URLs) form one host.  Repeated rows each have a row, and no say in each
    other's text.  An empty table gives no rows.  Other columns are ignored.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    own = [F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")]
    read = stash(_read(pages.select(F.monotonically_increasing_id().alias(ROW_ID), *own), kind))
    # neighbours in the order of host and path: places are global, so no host is one task's
    spoken = read.filter("size(lines) > 0").select(ROW_ID, "host", "path", "lines", F.xxhash64("lines").alias("sequence"))
    placed = stash(running_before(spoken, [F.col("host"), F.col("path"), F.col(ROW_ID)],
                                  {"place": F.lit(1).cast("long")}).drop("place_total"))
    runs = stash(_in_runs(placed))
    # the last page of the run before and the first of the run after: one row per run
    page = F.struct("host", "path", "lines")
    nothing = F.lit(None).cast(runs.select(page.alias("p")).schema["p"].dataType)
    sides = (runs.filter("last").select((F.col("run") + 1).alias("run"), page.alias("before"), nothing.alias("after"))
             .unionByName(runs.filter("first").select((F.col("run") - 1).alias("run"), nothing.alias("before"),
                                                      page.alias("after")))
             .groupBy("run").agg(F.first("before", ignorenulls=True).alias("before"),
                                 F.first("after", ignorenulls=True).alias("after")))
    open_pages = read.filter("free IS NOT NULL")
    pairs = runs.join(open_pages.select(ROW_ID, "free"), ROW_ID).join(stash(sides), "run")
    shared = _shared(pairs.select(ROW_ID, "host", "path", "lines", "free", "before", "after"))
    recurring = (placed.groupBy("host", "sequence").agg(F.first("lines").alias("lines"))
                 .select("host", F.explode(F.array_distinct("lines")).alias("line"))
                 .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(f"n >= {RECURS}").drop("n"))
    gone = (stash(shared).join(stash(recurring), ["host", "line"])
            .groupBy("gone_row").agg(F.collect_list("at").alias("gone")))  # at most a page's lines
    left = F.array_except(F.sequence(F.lit(0), F.size("texts") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    differenced = (open_pages.join(gone, F.col(ROW_ID) == F.col("gone_row"), "left")
                   .withColumn("left", left)
                   .select("page_id", "url", F.expr("array_join(transform(left, i -> texts[i]), '\n')").alias("text")))
    # article texts are read again rather than stored and shuffled
    return (_articles(pages.select(*own), kind).unionByName(differenced)
            .withColumn("n_chars", F.length("text").cast("long")))
