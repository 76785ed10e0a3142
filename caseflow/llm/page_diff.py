"""Main text of web pages by nearest-URL page differencing.

Pages of a host are put in order of their URL paths and each is paired with the neighbour whose path is nearer; the text
lines of the two are aligned by longest common subsequence, and what they share outside an article is page furniture and
is deleted. Lines are the blocks of the page in page order. Markup settles what a pair cannot: text inside furniture
elements (menus, headers, footers, asides, forms, adverts, notices, reader comments) is deleted though only this page has it,
and shared lines inside an article element stay, since an article may quote or copy another. Pages with an article or main
element give only what is inside it.

The pages are shuffled once, as compressed lines, by ranges of (host, path); a host of any size spreads over as many
ranges as it needs, and only the pages at a range's ends meet again to find their neighbours.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, slices

#: Fixed values of HTML: elements without end tags, elements whose content is not text, elements that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
#: Elements that hold no article text.
FURNITURE = frozenset("head title nav header footer aside form menu button select option textarea dialog template noscript iframe object svg canvas audio video label fieldset".split())
#: Words of class, id or role that mark furniture.
CUES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side aside nav navbar navigation menu menus breadcrumb "
    "breadcrumbs header masthead topbar footer foot footnav notice notices cookie cookies consent gdpr alert popup modal overlay comment comments commentlist "
    "respond reply replies disqus discussion share sharing social related recommended newsletter subscribe subscription signup login search pagination pager "
    "toolbar widget widgets complementary contentinfo".split()
)
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<raw>script|style|noscript|iframe|template|textarea|xmp|noembed|noframes)\b[^<>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
MARK = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")

#: Where a line stands: in an article, elsewhere, in furniture.
ARTICLE, PLAIN, ASIDE = 0, 1, 2


def _marked(attrs: str) -> bool:
    for m in MARK.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            if name in CUES or not CUES.isdisjoint(WORD.findall(name)[:1]):
                return True
    return False


def page_lines(source: str | None) -> list[tuple[int, str]]:
    """(place, text) of every block with text, in page order; references decoded, white space as single spaces.

    An unclosed comment, declaration or raw element takes the rest of the page. Time is linear in the page's length.
    """
    lines: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, furniture, article
    opened: dict[str, int] = {}  # how often each element is on the stack
    aside = article = 0

    def end_block() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                lines.append((ASIDE if aside else ARTICLE if article else PLAIN, text))

    def pop() -> None:
        nonlocal aside, article
        element, a, b = stack.pop()
        opened[element] -= 1
        aside -= a
        article -= b

    at = 0
    source = source or ""
    for m in TOKEN.finditer(source):
        if m.start() > at:
            held.append(html.unescape(source[at : m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            end_block()
        elif name == "br":
            held.append(" ")
        if name in VOID or m["attrs"].endswith("/") and not m["end"] and name not in BLOCK:
            continue
        if m["end"]:
            if opened.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in BLOCK and stack and stack[-1][0] == "p":
            pop()
        if name in ("li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == name:
            pop()
        furniture = name in FURNITURE or name not in ("html", "body", "main") and _marked(m["attrs"])
        main = name in ("article", "main") and not furniture
        if name in BLOCK or furniture or main:  # inline elements carry no place
            stack.append((name, furniture, main))
            opened[name] = opened.get(name, 0) + 1
            aside += furniture
            article += main
    if at < len(source):
        held.append(html.unescape(source[at:]))
    end_block()
    return lines


def _shared_small(a: list, b: list) -> set[int]:
    """Positions of ``a`` in one longest common subsequence, by a bit vector a row of the table."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full, v, rows = (1 << len(b)) - 1, (1 << len(b)) - 1, []
    for x in a:
        rows.append(v)
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    rows.append(v)
    # Bit j of row i is 0 where the subsequence of a[:i] and b[:j+1] is one longer than that of b[:j].
    out, j = set(), len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        while j >= 0 and rows[i + 1] >> j & 1:
            j -= 1
        if j < 0:
            break
        if rows[i] >> j & 1:  # the step comes from this line
            out.add(i)
            j -= 1
    return out


def _row_lengths(a: list, b: list) -> list[int]:
    """Lengths of the longest common subsequence of ``a`` and each prefix of ``b``."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = v = (1 << len(b)) - 1
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out, total = [0], 0
    for bit in reversed(format(v, f"0{len(b)}b")) if b else "":
        total += bit == "0"
        out.append(total)
    return out


def shared_lines(a: list, b: list, bits: int = 1 << 28) -> set[int]:
    """Positions of ``a`` that one longest common subsequence of ``a`` and ``b`` takes.

    Equal ends are stripped and lines without an equal on the other side left out first; a table over ``bits`` is halved as
    Hirschberg does, so memory stays bounded for any page.
    """
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out = {*range(start), *range(len(a) - end, len(a))}
    mid_a, mid_b = a[start : len(a) - end], b[start : len(b) - end]
    known_a, known_b = set(mid_a), set(mid_b)
    index = [i for i, x in enumerate(mid_a) if x in known_b]
    xs, ys = [mid_a[i] for i in index], [y for y in mid_b if y in known_a]
    if not xs or not ys:
        return out
    if len(xs) * len(ys) <= bits or len(xs) == 1:
        found = _shared_small(xs, ys)
    else:
        half = len(xs) // 2
        left, right = _row_lengths(xs[:half], ys), _row_lengths(xs[half:][::-1], ys[::-1])[::-1]
        at = max(range(len(ys) + 1), key=lambda j: left[j] + right[j])
        found = shared_lines(xs[:half], ys[:at], bits) | {half + i for i in shared_lines(xs[half:], ys[at:], bits)}
    return out | {start + index[i] for i in found}


def main_text(lines: list, other: list | None) -> str:
    """Article text of a page's lines, given those of its nearest page (None where the host has no other)."""
    shared = shared_lines([x[1] for x in lines], [x[1] for x in other]) if other else set()
    has_article = any(place == ARTICLE for place, _ in lines)
    keep = []
    for i, (place, text) in enumerate(lines):
        if place == ARTICLE or place == PLAIN and not has_article and i not in shared:
            keep.append(text)
    return "\n".join(keep)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host without port, and the path without query, fragment and last slash."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.lower(F.regexp_extract(place, r"^([^/:]*)", 1))
    return host, F.regexp_replace(F.regexp_extract(place, r"^[^/]*(.*)$", 1), "/+$", "")


def _nearness(path: str, other: str) -> int:
    n = 0
    for x, y in zip(path, other):
        if x != y:
            break
        n += 1
    return n


def _nearer(row: dict, before: dict | None, after: dict | None) -> dict | None:
    """The neighbour of the same host with the longer common path, the earlier one on a tie."""
    before = before if before and before["host"] == row["host"] else None
    after = after if after and after["host"] == row["host"] else None
    if before and after:
        return before if _nearness(row["path"], before["path"]) >= _nearness(row["path"], after["path"]) else after
    return before or after


def _unpack(row: dict | None) -> list | None:
    return json.loads(zlib.decompress(row["lines"])) if row else None


_SORT = ["host", "path", "url", "id", "lines"]


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url and ``text`` of every page.

    Null html gives an empty text; null urls count as one host without a name; repeated rows are pages of their own (and each
    other's neighbours); an empty table gives no rows; other columns are not carried, so their names cannot clash.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html", 8 << 20):
                packed = [zlib.compress(json.dumps(page_lines(h)).encode(), 6) for h in column(batch, "html").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "url"), pa.array(packed, pa.binary())], ["id", "url", "lines"])

    parsed = rows.mapInArrow(parse, "id long, url string, lines binary").select("id", "url", host.alias("host"), path.alias("path"), "lines")
    # A fixed number of ranges, so that both readers below see the same ends.
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = parsed.repartitionByRange(n, "host", "path", "url", "id").sortWithinPartitions(*_SORT)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict | None, dict, dict | None]]:
        """(number, previous, page, next) in order."""
        before = row = None
        k = 0
        for batch in batches:
            for after in batch.to_pylist():
                if row is not None:
                    yield k, before, row, after
                    k += 1
                before, row = row, after
        if row is not None:
            yield k, before, row, None

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        names, kinds = ["id", "url", "text"], (pa.int64(), pa.string(), pa.string())
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        for _, before, row, after in walk(batches):
            if before is None or after is None:
                continue
            out.append((row["id"], row["url"], main_text(_unpack(row), _unpack(_nearer(row, before, after)))))
            if len(out) == 256:
                yield pack()
                out.clear()
        if out:
            yield pack()

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first two and last two pages of a range; ``decide`` marks the first and the last."""
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        out: dict[int, tuple] = {}
        for k, before, row, after in walk(batches):
            if before is None or after is None:
                out[k] = (part, k, True, row)
                for j, other in ((k - 1, before), (k + 1, after)):
                    if other is not None:
                        out.setdefault(j, (part, j, False, other))
        for part, k, decide, row in sorted(out.values(), key=lambda x: x[1]):
            cols = [[part], [k], [decide], [row["id"]], [row["url"]], [row["host"]], [row["path"]], [row["lines"]]]
            kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["part", "k", "decide", "id", "url", "host", "path", "lines"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                text = main_text(_unpack(r), _unpack(_nearer(r, r["prev"], r["next"])))
                yield pa.RecordBatch.from_arrays([pa.array([r["id"]], pa.int64()), pa.array([r["url"]]).cast(pa.string()), pa.array([text])], ["id", "url", "text"])

    page = "id long, url string, text string"
    edge = ranged.mapInArrow(ends, "part int, k long, decide boolean, id long, url string, host string, path string, lines binary")
    order = Window.partitionBy("host").orderBy("part", "k")
    one = F.struct("host", "path", "lines")
    edge = edge.withColumn("prev", F.lag(one).over(order)).withColumn("next", F.lead(one).over(order)).where("decide")
    edge = edge.select("id", "url", "host", "path", "lines", "prev", "next").mapInArrow(settle, page)
    out = ranged.mapInArrow(inner, page).unionByName(edge)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
