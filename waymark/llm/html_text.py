"""Main text of web pages: nearest-URL differencing, with the page's own structure.

`parse` turns a page into lines, one per block, each marked as boilerplate by structure (menus, page headers and
footers, sidebars, notices, adverts, forms, comments, hidden parts), as part of an article element, or as neither.
Pages sort by host, path, id and html; each page's lines are aligned by longest common subsequence with those of the
nearest pages before and after it on its host that differ from it, and the lines they share are deleted.  Lines inside
an article element are kept although shared: mirrored articles and quoted passages are main text.  Where a page has an
article element, lines outside it go.

Pages are parsed once, into a table.  Each task reads its range of the URL order and holds two pages; where ranges
meet, the last page of one and the first of the next are joined and compared.  Pages of one host with the same lines
are one page to the comparison: what any of them shares with a neighbour is deleted from all, so that the result does
not depend on how pages are dealt, and a hot page costs nothing.

Defined results: null or empty html and malformed markup give what text there is (possibly ''); null URLs are one host;
rows equal in page_id, url and html fare alike; every row gives one row; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import compress, packed_runs, partitions, runs, stored, text_hash, unpacked

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'>]+)""")
TOKEN = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math canvas object audio video select button head".split())
PLAIN = RAW - frozenset("head noscript template svg math object audio video select button canvas".split())  # no tags inside count
BOILERPLATE = frozenset("nav aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body caption td th tr tbody thead tfoot option legend summary".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Words of a class or id that mark what is no main text.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar toolbar comment comments reply replies respond disqus share sharing social related recommended newsletter subscribe subscription signup login search widget pagination pager".split()
)
MARKED_EDGES = frozenset(("header", "footer"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())


def attributes(text: str) -> dict[str, str]:
    return {(m[1] or m[3]).lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(text)}


def is_boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in BOILERPLATE or tag == "footer" or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main") or not attrs:
        return False
    names = {t for key in ("class", "id") for t in TOKEN.findall(CAMEL.sub(" ", attrs.get(key, "")).lower())}
    if names & MARKED or (names & MARKED_EDGES and not in_article and tag != "article"):
        return True
    style = attrs.get("style", "").replace(" ", "").lower()
    return attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style


@dataclass(frozen=True)
class Tag:
    """What a tag's text says, whatever stands around it."""

    name: str
    closes: bool
    raw: bool
    block: bool
    void: bool
    marks: tuple[bool, bool]  # whether it starts boilerplate outside and inside an article
    idle: bool  # it changes nothing


@lru_cache(maxsize=20_000)
def tag_of(closes: str, name: str, rest: str) -> Tag:
    name = name.lower()
    attrs = {} if closes or not rest else attributes(rest)
    marks = (False, False) if closes else (is_boilerplate(name, attrs, False), is_boilerplate(name, attrs, True))
    raw, block, void = name in RAW and not rest.endswith("/"), name in BLOCKS, name in VOID
    inline = not block and not raw and name != "br"
    return Tag(name, bool(closes), raw, block, void, marks, inline and (void or (not closes and not any(marks))))


def parse(page: str) -> list[tuple[str, str]]:
    """(text, kind) of the page's blocks, in order; kind is b (boilerplate), a (in an article) or o (other)."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = [("", False, False)]  # element, whether in boilerplate, whether in an article
    muted = 0  # depth of the marked inline element that hides what it holds, amid a block
    at, size, find, match = 0, len(page), page.find, TAG.match

    def say(text: str) -> None:
        if not muted:
            held.append(html.unescape(text))

    def flush() -> None:
        if held and not muted:
            if text := " ".join("".join(held).split()):
                _, skipped, article = stack[-1]
                out.append((text, "b" if skipped else "a" if article else "o"))
            held.clear()

    while at < size:
        start = find("<", at)
        if start != at:
            say(page[at : start if start >= 0 else size])
            if start < 0:
                break
        m = match(page, start)
        if m is None:
            follows = page[start + 1 : start + 2]
            if follows in ("!", "?") and follows:
                mark = "-->" if page.startswith("<!--", start) else ">"
                end = find(mark, start + (4 if mark == "-->" else 2))
                at = size if end < 0 else end + len(mark)
            elif follows.isalpha() or follows == "/":  # a tag that doesn't end well
                end = find(">", start)
                at = size if end < 0 else end + 1
            else:
                say("<")
                at = start + 1
            continue
        at, tag = m.end(), tag_of(*m.groups())
        if tag.idle:
            continue
        if tag.closes:
            if tag.block:
                flush()
            if any(x[0] == tag.name for x in stack):
                while stack.pop()[0] != tag.name:
                    pass
                muted = muted if len(stack) >= muted else 0
        elif tag.raw:
            end = re.compile(rf"</{tag.name}\b[^>]*>", re.IGNORECASE).search(page, at)
            if end is None and tag.name == "head":
                end = re.compile(r"(?=<body\b)", re.IGNORECASE).search(page, at)
            if end is not None:
                at = end.end()
            elif tag.name in PLAIN:
                at = size
            say(" ")
        elif tag.name == "br":
            say(" ")
        else:
            if tag.block:
                flush()
                if stack[-1][0] == "p" and tag.name in CLOSES_P:
                    stack.pop()
                if tag.name in SIBLINGS:
                    depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag.name or stack[i][0] in SIBLINGS[tag.name]), 0)
                    if depth and stack[depth][0] == tag.name:
                        del stack[depth:]
                muted = muted if len(stack) >= muted else 0
            if not tag.void:
                _, skipped, article = stack[-1]
                marked = skipped or tag.marks[article]
                if tag.block or marked != skipped:
                    stack.append((tag.name, marked, article or tag.name == "article"))
                    if not tag.block and not muted:
                        muted = len(stack)
    muted = 0
    flush()
    return out


def place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, as what pages sort by: no query or fragment, slash or suffix at the end; numbers by value."""
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "", url or ""
    path = re.sub(r"\.\w{1,5}$", "", parts.path.rstrip("/"))
    return parts.netloc.lower(), re.sub(r"\d+", lambda m: m[0].zfill(12), path)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in a of the lines of a longest common subsequence with b; bits of one integer per line of a."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    at: dict[int, int] = {}
    for j, line in enumerate(y):
        at[line] = at.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, v = [], full
    for line in x:
        u = v & at.get(line, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    inner, i, j = [], len(x), len(y)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                inner.append(low + i)
                j -= 1
    return [*range(low), *reversed(inner), *range(len(a) - high, len(a))]


def main_text(lines: list[str], kinds: str, shared: set[int]) -> str:
    wanted = "a" if "a" in kinds else "o"
    return "\n".join(t for i, (t, k) in enumerate(zip(lines, kinds, strict=True)) if k == wanted and (k == "a" or i not in shared))


PARSED = "page_id long, url string, page_key long, host string, path string, lines_key long, hashes array<long>, kinds string, packed binary"
SHARED = "host string, lines_key long, shared array<int>, part int, edge int, hashes array<long>"
KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def frame(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines (blocks of the page) and n_shared (those that a nearest page has too)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 4 << 20, "html"):
            rows = []
            for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = parse(page or "")
                host, path = place(url)
                hashes = [text_hash(t.encode()) for t, _ in lines]
                body = "\n".join(t for t, _ in lines).encode()
                rows.append((page_id, url, text_hash(f"{url}\n{page}".encode()), host, path, text_hash(body), hashes, "".join(k for _, k in lines), compress(body, 9)))
            yield frame(PARSED, rows)

    parsed = stored(pages.mapInArrow(read, PARSED))
    order = ["host", "path", "page_id", "page_key"]
    ordered = parsed.select(*order, "lines_key", "hashes").repartitionByRange(partitions(pages.sparkSession), *order).sortWithinPartitions(*order)
    compared = stored(ordered.mapInArrow(compare, SHARED))
    edges = compared.where("edge IS NOT NULL")
    parts = sorted(r["part"] for r in edges.where("edge = 0").select("part").collect())  # one number a task
    following = pages.sparkSession.createDataFrame(list(zip(parts, parts[1:], strict=False)), "part int, next_part int")
    of = lambda which, name: edges.where(f"edge = {which}").select(*[F.col(c).alias(f"{c}_{name}") for c in ("part", "host", "lines_key", "hashes")])
    borders = of(1, "a").join(F.broadcast(following), F.col("part_a") == F.col("part")).join(of(0, "b"), F.col("next_part") == F.col("part_b"))
    across = borders.where("host_a = host_b AND lines_key_a <> lines_key_b").mapInArrow(compare_borders, "host string, lines_key long, shared array<int>")
    shared = compared.where("edge IS NULL").select("host", "lines_key", "shared").unionByName(across)
    shared = stored(shared.groupBy("host", "lines_key").agg(F.array_distinct(F.flatten(F.collect_set("shared"))).alias("shared")))
    told = parsed.select("page_id", "url", "host", "lines_key", "kinds", "packed").join(shared.hint("merge"), ["host", "lines_key"], "left")
    return told.select("page_id", "url", "kinds", "packed", "shared").mapInArrow(write, "page_id long, url string, text string, n_lines long, n_shared long")


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in URL order to the places of the lines that the nearest different pages share, once per run of equal pages.

    The first and the last page of a task's range come as rows of their own (edge 0 and 1).
    """
    part = TaskContext.get().partitionId()
    rows: list[tuple] = []
    page: dict | None = None

    def both(a: dict, b: dict) -> None:
        if a["host"] == b["host"]:
            rows.extend((x["host"], x["lines_key"], common_lines(x["hashes"], y["hashes"]), None, None, None) for x, y in ((a, b), (b, a)))

    def edge(which: int) -> None:
        rows.append((page["host"], page["lines_key"], None, part, which, page["hashes"]))

    for batch in batches:
        for host, key, hashes in zip(*(batch.column(n).to_pylist() for n in ("host", "lines_key", "hashes")), strict=True):
            if page is not None and page["host"] == host and page["lines_key"] == key:
                continue
            new = {"host": host, "lines_key": key, "hashes": hashes}
            if page is None:
                page = new
                edge(0)
            else:
                both(page, new)
                page = new
        yield frame(SHARED, rows)
        rows.clear()
    if page is not None:
        edge(1)
    yield frame(SHARED, rows)


def compare_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of pages on either side of a border to the places of the lines that they share."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            rows.append((r["host_a"], r["lines_key_a"], common_lines(r["hashes_a"], r["hashes_b"])))
            rows.append((r["host_a"], r["lines_key_b"], common_lines(r["hashes_b"], r["hashes_a"])))
        yield frame("host string, lines_key long, shared array<int>", rows)


def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in packed_runs(batches):
        texts, shared = [], [x or [] for x in batch.column("shared").to_pylist()]
        kinds = batch.column("kinds").to_pylist()
        for k, body, some in zip(kinds, unpacked(batch.column("packed")), shared, strict=True):
            texts.append(main_text(body.decode().split("\n") if k else [], k, set(some)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, kinds), pa.int64()), pa.array(map(len, shared), pa.int64())],
            ["page_id", "url", "text", "n_lines", "n_shared"],
        )
