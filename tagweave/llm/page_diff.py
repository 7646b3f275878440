"""Main text of web pages by page differencing against the nearest URLs, checked by markup.

Every page is cut once into lines (blocks of text) and differenced: pages are ordered by host
and path, a page is paired with the one of its ``NEIGHBOURS`` nearest on each side whose path
shares the longest prefix, the lines of both are aligned by longest common subsequence, and
the shared lines are deleted.  Lines on more than half of the neighbours say nothing about a
page; the others are its own.  A neighbour that shares over ``COPY_SHARE`` of the own lines'
characters is a copy, which says nothing about templates: the next is taken.  A page without
own lines, or with copies only, keeps its lines.

An exact check by what the page itself names follows.  Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments go (by element, role and class), also
where no neighbour repeats them.  Where a page marks its article (``article``, ``main`` or the
like) its other lines go too, and shared lines of the article are put back: a sentence that
other pages repeat is still part of the text.  ``lines_shared`` counts the lines that
differencing deleted, ``lines_back`` those put back.  An ``article`` inside an ``article``, or
one named as a comment or advert, is not the article; beside a ``main`` that holds text,
articles outside of it are teasers.

Scale: only the keys (host, path, hash of the page) are sorted and numbered.  Every
``STRETCH`` of them are a stretch (longer ones beyond ``MOST`` stretches, so the bounds in the
driver stay few); a page goes to its stretch and, when it is among the ``NEIGHBOURS`` next to
a bound, also beyond it.  Pages move once; a stretch is read in order, a few pages at a time.

Tags are scanned in one pass: a tag ends at the first ``>`` outside quotes, a quote without
its partner is a character, and a tag that the page ends in is dropped with what follows.

Cases: a null or empty html has no text; a null url has empty host and path; pages equal
in url and html count as one when pairing; unclosed elements end with their parent, and an
unclosed comment or script at the end of the page; an empty table gives no rows; an input
column named like an added one (``ADDED``) is replaced, other names are free.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tagweave.llm.common import column, pieces
from tagweave.llm.url_filter import host_path
from tagweave.operators.ids import sequential_ids

COPY_SHARE = 0.5
NEIGHBOURS = 4  # on each side
STRETCH = 256  # different pages of a stretch, twice NEIGHBOURS at least
MOST = 16384  # stretches
ADDED = ["text", "n_chars", "lines_shared", "lines_back"]

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style textarea title iframe".split()}


class Tag(NamedTuple):
    """A token from ``start`` to ``end``; ``name`` is empty for comments and raw elements (``raw``)."""

    start: int
    end: int
    name: str = ""
    close: bool = False
    attrs: str = ""
    raw: bool = False


def tags(page: str) -> Iterator[Tag]:
    """The tags, comments and raw elements of a page, in time linear in its length."""
    last = {c: page.rfind(c) for c in ">\"'"}
    at, size, quotes = 0, len(page), True
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = size if end < 0 else end + 3
            yield Tag(at, end)
        elif page[at + 1:at + 2] in ("!", "?"):
            end = page.find(">", at) + 1 or size
            yield Tag(at, end)
        elif m := _NAME.match(page, at + 1):
            name, here = m[2].lower(), m.end()
            if not m[1] and name in _RAW:
                start = page.find(">", here) + 1 or size
                found = _RAW[name].search(page, start)
                end = found.end() if found else size
                yield Tag(at, end, raw=True)
                at = end
                continue
            end = 0
            while here <= last[">"]:
                stop = _STOP.search(page, here)
                here = stop.end()
                if stop[0] == ">":
                    end = here
                    break
                if quotes and here <= last[stop[0]]:
                    here = page.index(stop[0], here) + 1
            if not end and quotes and at < last[">"]:
                quotes = False  # a quote swallowed the last tag: from here on quotes are characters
                continue
            yield Tag(at, end, name, bool(m[1]), page[m.end():end - 1]) if end else Tag(at, size)
            end = end or size
        else:
            at += 1
            continue
        at = end


_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Element names of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
             "span strike strong sub sup time tt u var wbr img".split())
CHROME = set("head nav header footer aside form menu dialog object fieldset noscript template svg select datalist "
             "optgroup option button".split())
CLOSES_P = set("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
               "h6 header hr main menu nav ol p pre section table ul".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                   "menubar toolbar".split())
CHROME_WORDS = set("nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts "
                   "advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
                   "notices alert popup modal overlay newsletter subscribe signup login search comment comments "
                   "disqus reply replies respond share sharing social related breadcrumb breadcrumbs pagination "
                   "pager toolbar widget form copyright skip".split())
ARTICLE_NAMES = set("article article-body article-content articlebody post-content post-body entry-content "
                    "story-body main-content".split())
NEVER_CHROME = set("html body article main".split())


def _kind(name: str, attrs: str) -> str:
    """``chrome``, ``article`` or empty for an element; what it is called comes before what it is."""
    if name in CHROME:
        return "chrome"
    if not attrs:
        return "article" if name in ("article", "main") else ""
    found = {}
    for m in _ATTR.finditer(attrs):
        found[m[1].lower()] = (m[2] or m[3] or m[4] or "").lower()
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if name in ("article", "main"):  # its first word: a topic in a later one doesn't make it chrome
        if found.get("role") in CHROME_ROLES or any(re.split(r"[^a-z]+", n)[0] in CHROME_WORDS for n in names):
            return "chrome"
        return "article"
    if found.get("role") in ("main", "article") or \
            found.get("itemprop") == "articlebody" or any(n in ARTICLE_NAMES for n in names):
        return "article"
    if name in NEVER_CHROME:
        return ""
    if found.get("role") in CHROME_ROLES:
        return "chrome"
    for n in names:
        words = re.split(r"[^a-z]+", n)
        if words[0] not in ("has", "with", "no") and CHROME_WORDS & set(words):
            return "chrome"
    return ""


def page_lines(page: str | None) -> list[tuple[str, str]]:
    """``(kind, text)`` of every line in page order; kind as of :func:`_kind`.

    A line inside chrome is chrome, also within an article.
    """
    out: list[tuple[str, str]] = []
    inside: list[bool] = []  # whether the line is in a main element
    run: list[str] = []
    stack: list[tuple[str, str]] = []  # (element, kind of its lines)

    def end_line():
        if run:
            line = " ".join(html.unescape("".join(run)).split())
            if line:
                out.append((stack[-1][1] if stack else "", line))
                inside.append(any(x[0] == "main" for x in stack))
            run.clear()

    page, at = page or "", 0
    for tag in tags(page):
        if tag.start > at:
            run.append(page[at:tag.start])
        at, name = tag.end, tag.name
        if not name:
            if tag.raw:
                end_line()
            continue
        if name in INLINE and not stack_kind(stack, tag):
            continue
        end_line()
        if name in VOID:
            continue
        if tag.close:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in CLOSES_P:
            _close(stack, "p", CLOSES_P - {"p"})
        elif name in ("li", "tr", "td", "th", "dt", "dd"):
            _close(stack, name, {"ul", "ol", "table", "dl"})
        elif name in ("option", "optgroup"):
            _close(stack, "option", {"select", "datalist"})
            if name == "optgroup":
                _close(stack, name, {"select", "datalist"})
        elif name == "button":
            _close(stack, name, {"table", "td", "th", "object", "template"})
        if tag.attrs.endswith("/"):
            continue
        outer = stack[-1][1] if stack else ""
        own = _kind(name, tag.attrs)
        if name == "article" and any(x[0] == "article" for x in stack):
            own = outer = "chrome"
        stack.append((name, outer if outer == "chrome" else own or outer))
    if at < len(page):
        run.append(page[at:])
    end_line()
    if any(here and kind == "article" for here, (kind, _) in zip(inside, out)):
        return [("chrome" if kind == "article" and not here else kind, text) for here, (kind, text) in zip(inside, out)]
    return out


def stack_kind(stack: list[tuple[str, str]], tag: Tag) -> bool:
    """Whether an inline element matters as one: it opens, or closes, a part of its own kind."""
    if tag.close:
        return any(x[0] == tag.name for x in stack)
    return bool(_kind(tag.name, tag.attrs))


def _close(stack: list[tuple[str, str]], name: str, until: set[str]) -> None:
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] == name:
            del stack[k:]
            return
        if stack[k][0] in until:
            return


def common_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    The beginning that both share, and lines that occur in only one of the two, are left out
    first; the rest is the bit-parallel algorithm, one integer of ``len(b)`` bits per line of ``a``.
    """
    head = _prefix(a, b)
    if head in (len(a), len(b)):
        return [*range(head)]
    both = set(a[head:]) & set(b[head:])
    at = [i for i in range(head, len(a)) if a[i] in both]
    b = [x for x in b[head:] if x in both]
    place: dict = {}
    for j, x in enumerate(b):
        place[x] = place.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for i in at:
        match = place[a[i]]
        hit = row & match
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # a zero bit j of row i: the subsequence of a[:i+1] and b[:j+1] is longer than of b[:j]
    out, i, j = [], len(at) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        here = (j + 1) - (rows[i] & ((1 << (j + 1)) - 1)).bit_count()
        if here == 0:
            break
        above = (j + 1) - (rows[i - 1] & ((1 << (j + 1)) - 1)).bit_count() if i else 0
        if above == here:
            i -= 1
            continue
        # line i is used: at the last place of b that still gives ``here``
        while not ((rows[i] >> j) & 1 == 0 and b[j] == a[at[i]]):
            j -= 1
        out.append(at[i])
        i, j = i - 1, j - 1
    return [*range(head), *out[::-1]]


def _marked(lines: list[tuple[str, str]]) -> bool:
    return any(kind == "article" for kind, _ in lines)


def _prefix(a: str | list, b: str | list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def delete(path: str, lines: list[str], others: list[tuple[str, list[str]]]) -> list[int]:
    """Positions of the lines that a page shares with its pair among ``others`` (path, lines), nearest first."""
    held = Counter(x for _, other in others for x in set(other))
    own = {x for x in lines if 2 * held[x] <= len(others)} if len(others) > 1 else set(lines) - set(held)
    total = sum(len(x) for x in lines if x in own)
    if total:
        for _, other in sorted(others, key=lambda x: -_prefix(path, x[0])):  # ties: as given
            same = common_lines(lines, other)
            if sum(len(lines[i]) for i in same if lines[i] in own) <= COPY_SHARE * total:
                return same
    return []


def checked(lines: list[tuple[str, str]], shared: list[int]) -> tuple[str, int]:
    """The text of a page whose lines ``shared`` were deleted, checked by its markup, and the lines put back."""
    gone, marked = set(shared), _marked(lines)
    kept = [t for k, (kind, t) in enumerate(lines) if (kind == "article" if marked else kind != "chrome" and k not in gone)]
    return " ".join(kept), sum(lines[k][0] == "article" for k in gone)


@dataclass
class _Page:
    """A page of a stretch: its place, its lines, and its rows (record batch, row) that belong there."""

    place: tuple
    lines: list[tuple[str, str]]
    rows: list[tuple[pa.RecordBatch, int]] = field(default_factory=list)

    def __post_init__(self):
        self.texts = [t for _, t in self.lines]


def _result(near: list[_Page], k: int) -> tuple[str, int, int]:
    """Text, lines deleted and lines put back of page ``k`` of consecutive pages."""
    page = near[k]
    others = [near[k + d] for n in range(1, NEIGHBOURS + 1) for d in (-n, n) if 0 <= k + d < len(near)]
    others = [(o.place[2], o.texts) for o in others if o.place[:2] == page.place[:2]]
    shared = delete(page.place[2], page.texts, others)
    text, back = checked(page.lines, shared)
    return text, len(shared), back


def _differenced(rows: DataFrame, kept: int) -> DataFrame:
    """The first ``kept`` columns and ``ADDED`` of the rows at home in their stretch; rows come in the order of the pages."""
    schema = StructType([*rows.schema.fields[:kept], StructField("text", StringType()), *(StructField(c, LongType()) for c in ADDED[1:])])

    def written(done: list[tuple[pa.RecordBatch, int, tuple[str, int, int]]]) -> Iterator[pa.RecordBatch]:
        for _, part in groupby(done, key=lambda x: id(x[0])):
            part = [*part]
            found = part[0][0].take(pa.array([i for _, i, _ in part], pa.int64()))
            text, shared, back = zip(*(x for _, _, x in part))
            yield pa.RecordBatch.from_arrays([
                *found.columns, pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                pa.array(shared, pa.int64()), pa.array(back, pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: list[_Page] = []  # the pages before the first undecided one, and the undecided ones
        at = 0  # the first undecided page

        def decided(until: int) -> list[tuple[pa.RecordBatch, int, tuple[str, int, int]]]:
            nonlocal at
            out = []
            while at < until:
                if near[at].rows:
                    found = _result(near, at)
                    out += [(batch, i, found) for batch, i in near[at].rows]
                at += 1
            if at > NEIGHBOURS:
                del near[:at - NEIGHBOURS]
                at = NEIGHBOURS
            return out

        for batch in batches:
            for piece in pieces(batch, "html"):
                done = []
                held = pa.RecordBatch.from_arrays(piece.columns[:kept], names=piece.schema.names[:kept])
                places = zip(*(column(piece, c).to_pylist() for c in ("stretch", "host", "path", "pk")))
                html_, home = column(piece, "html"), column(piece, "home").to_pylist()
                for i, place in enumerate(places):
                    if not near or near[-1].place != place:
                        done += decided(len(near) - NEIGHBOURS)
                        near.append(_Page(place, page_lines(html_[i].as_py())))
                    if home[i] == 0:
                        near[-1].rows.append((held, i))
                yield from written(done)
        yield from written(decided(len(near)))

    return rows.mapInArrow(run, schema)


def _bounds(keys: DataFrame) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """Of every stretch of the different ``keys``: its first key, the last that the stretch before
    meets, and the first that the stretch after meets (none for the last stretch)."""
    ordered, n = sequential_ids(keys.distinct(), ["host", "path", "pk"], 0, "seq")
    size = max(STRETCH, -(-n // MOST))
    inside = F.col("seq") % size
    rows = ordered.where(inside.isin(0, NEIGHBOURS - 1, size - NEIGHBOURS)).orderBy("seq").collect()
    found = {r["seq"]: (r["host"], r["path"], r["pk"]) for r in rows}
    firsts = [found[k] for k in range(0, n, size)]
    heads = [found.get(k + NEIGHBOURS - 1, (chr(0x10FFFF),)) for k in range(0, n, size)]  # a short last stretch is met whole
    return firsts, heads, [found[k - NEIGHBOURS] for k in range(size, n, size)]


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` (without the html) with the columns ``ADDED``: every page is differenced, then checked."""
    url, page = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    host, path = host_path(url)
    kept = [f.name for f in pages.schema.fields if f.name not in (html_col, *ADDED)]
    # the input's columns go under numbers, so no name can clash
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)], F.xxhash64(url, page).alias("pk"),
                        host.alias("host"), path.alias("path"), page.alias("html"))
    firsts, heads, tails = _bounds(rows.select("host", "path", "pk"))

    @F.pandas_udf(ArrayType(IntegerType()))
    def stretches(host: pd.Series, path: pd.Series, pk: pd.Series) -> pd.Series:
        """The stretch a page is at home in, then those next to it that meet it."""
        out = []
        for key in zip(host, path, map(int, pk)):
            k = bisect_right(firsts, key) - 1
            out.append([k, *([k - 1] if k and key <= heads[k] else []), *([k + 1] if k < len(tails) and key >= tails[k] else [])])
        return pd.Series(out)

    dealt = rows.withColumn("at", stretches("host", "path", "pk"))
    dealt = dealt.select(*[c for c in dealt.columns if c != "at"], F.posexplode("at").alias("home", "stretch"))
    dealt = dealt.repartition("stretch").sortWithinPartitions("stretch", "host", "path", "pk")
    return _differenced(dealt, len(kept)).toDF(*kept, *ADDED)
