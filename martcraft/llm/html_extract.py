"""Main text of web pages by differencing each page with its nearest neighbour by URL.

1. *Lines.* A page is read tag by tag; each block of text is a line with its
   zone: ``main`` inside <article> or <main>, ``chrome`` inside an element that
   by its kind, role or class holds menus, headers, footers, sidebars, notices,
   adverts, forms or reader comments, else ``body``. Scripts, styles and markup
   are no lines.
2. *Pairs.* Pages are range-partitioned and sorted by host and URL path.
   Neighbours on a host that are nearly the same (the lines that they don't share
   hold at most a tenth of the words of one and half of the other; chrome doesn't
   count) are copies and form a group. A page's partner is the page next to its
   group (next to itself, if it has a main zone), on the same host, whose path has
   the longer common beginning with its own (ties: the one before). A host with a
   third of all pages is spread over many ranges; the first and the last page of
   a range are sent to the ranges beside it too. Ranges aim at ``RANGE_BYTES``;
   there are ``RANGES`` at most (larger ones then), since the driver holds two keys
   of each. A task reads its range as a stream; of a group that waits for the page
   behind it, what is over ``GROUP_BYTES`` waits in a file of the task's own. Where a
   group reaches over a border (the two pages beside it are compared first), the
   ranges beside it are read once more, for the keys of the pages before and behind
   the group, and these pages are sent to every range that the group reaches into. So
   partners don't depend on ranges or sizes.
3. *Difference.* The lines of the two pages are aligned by a longest common
   subsequence. A shared line is template and is deleted, unless it stands in
   the page's main zone. Without a partner no line is known to be template.
4. *Text.* If the page has a main zone with text, its lines, else the body lines
   that are left, or all of them if none is left; chrome is never text.

The plain method (delete every shared line, keep all else) can't give right
results alone: menus and adverts that differ from page to page would stay, and
articles published twice under neighbouring URLs would vanish. So the zones
protect articles and remove chrome, and the difference decides the rest.

Defined cases: a null or empty page has an empty text. A null or unparsable URL
has no host; such pages are neighbours of each other. Broken markup is read
as far as it goes: unknown end tags are skipped and open elements end with the
page. White space (as Unicode has it) inside a block becomes one space.
"""
from __future__ import annotations

import html
import pickle
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice
from tempfile import TemporaryFile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.line_dedup import longest_common
from martcraft.llm.tables import BATCH_ROWS, ship, text_bytes

MAIN, BODY, CHROME = 0, 1, 2

RANGE_BYTES = 16 << 20
RANGES = 4096
GROUP_BYTES = 16 << 20
PAGE_BYTES = 500  # of a page without its lines
OWN, NEAR, FAR = 0, 1, 2  # a range's own page; the page beside the range; the page before or behind a group that reaches over the border
COPIES_AT_ONCE = 16  # of a page that goes to many ranges

# Elements by their role in the layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
            " frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody"
            " td textarea tfoot th thead title tr ul".split())
HIDDEN = set("script style noscript template svg iframe object head title canvas audio video math".split())
CHROME_TAGS = set("nav header footer aside form menu dialog button select textarea fieldset input".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
CHROME_NAMES = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header"
                   " masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted related"
                   " responses share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split())
# A name after one of these tells of the layout around (has-sidebar, no-comments).
NOT_OWN = set("has have hide no show with without".split())
COMMENTS = set("comment comments disqus responses".split())
NOTICES = set("ad ads advert advertisement adverts consent cookie cookies modal newsletter notice notices notification popup promo promoted signup sponsor"
              " sponsored subscribe".split())
RAW = set("script style textarea title noscript iframe template".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[a-z0-9]+")
_CLOSES_P = BLOCK - {"body", "html", "head", "title", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "button"}


def _is_chrome(tag: str, attrs: str, zone: int) -> tuple[bool, bool, set[str] | None]:
    """Whether the element is chrome, whether it isn't shown, and, if only its names or a form's tag make it chrome,
    the names. Inside an article a header is the article's own."""
    names = CHROME_NAMES - {"header"} if zone == MAIN else CHROME_NAMES
    chrome, hidden = tag in CHROME_TAGS, tag in HIDDEN
    sure, found = chrome and tag != "form", set()
    if attrs.strip():
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
            elif name == "role":
                sure |= value.strip() in CHROME_ROLES
            elif name in ("id", "class") and tag not in ("html", "body", "main", "article"):
                for part in value.split():
                    words = _NAME.findall(part)
                    if words and words[0] not in NOT_OWN:
                        found.update(w for w in words if w in names)
    return chrome or sure or bool(found), hidden, None if sure else found


def page_lines(page: str) -> list[tuple[int, str]]:
    """The blocks of text of a page with their zones, in page order.

    On a page without a main zone, an element that is chrome by its names or as a
    form is a wrapper around the page, and no chrome, if it holds an <article> or
    <main> and most of the page's words, or nine tenths of them. Elements named
    after comments are never wrappers, those named after notices only around an
    <article> or <main>.
    """
    out, wrappers = _read(page, frozenset())
    return _read(page, wrappers)[0] if wrappers and all(z != MAIN for z, _ in out) else out


def _read(page: str, wrappers: frozenset[int]) -> tuple[list[tuple[int, str]], frozenset[int]]:
    """The lines with their zones, if the elements at ``wrappers`` are no chrome; and the elements that could be wrappers."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int, bool, tuple | None]] = []  # element, zone inside it, shown, and of a possible wrapper: place, names, words and articles before
    zone, shown = BODY, True
    text: list[str] = []
    n_words, n_articles = 0, 0
    held: list[tuple[int, set[str], int, bool]] = []  # closed possible wrappers: place, names, words, whether with an article

    def flush() -> None:
        nonlocal n_words
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line:
                out.append((zone, line))
                n_words += line.count(" ") + 1

    def close(depth: int) -> None:
        nonlocal zone, shown
        if any(e[0] in BLOCK for e in stack[depth:]):
            flush()
        held.extend((e[3][0], e[3][1], n_words - e[3][2], n_articles > e[3][3]) for e in stack[depth:] if e[3])
        del stack[depth:]
        zone, shown = (stack[-1][1], stack[-1][2]) if stack else (BODY, True)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        if m is None:  # a tag that never ends
            break
        place, at = at, m.end()
        slash, tag, attrs, plain = m.groups()
        if plain is not None:
            if shown:
                text.append(plain)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if tag == "p" and stack[depth][0] in ("article", "main", "div", "td", "section"):
                    break
            continue
        if tag == "br":
            if shown:
                text.append(" ")
            continue
        if tag in _CLOSES_P:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCK:
                    break
        for kinds, stops in ((("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("option",), ("select",)), (("td", "th"), ("tr", "table")), (("tr",), ("table", "tbody", "thead", "tfoot"))):
            if tag in kinds:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in kinds:
                        close(depth)
                        break
                    if stack[depth][0] in stops:
                        break
        if tag in BLOCK:
            flush()
        chrome, hidden, names = _is_chrome(tag, attrs, zone)
        chrome = chrome and place not in wrappers
        n_articles += tag in ("article", "main")
        inner = MAIN if tag in ("article", "main") and zone != CHROME else zone
        if chrome and not (tag == "header" and zone == MAIN):  # an article's own head belongs to it
            inner = CHROME
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:  # up to its end tag, whatever stands inside
            close_at = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close_at.end() if close_at else end
            continue
        stack.append((tag, inner, shown and not hidden, (place, names, n_words, n_articles) if chrome and names is not None else None))
        zone, shown = inner, shown and not hidden
    flush()
    close(0)
    return out, frozenset(i for i, names, n, article in held if not names & COMMENTS and (
        article and 2 * n > n_words or 10 * n >= 9 * n_words > 0 and not names & NOTICES))


def common_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` a longest common subsequence with ``b`` uses."""
    used = [False] * len(a)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        used[head] = True
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
        used[-tail] = True
    for i, _ in longest_common(a[head:len(a) - tail], b[head:len(b) - tail]):
        used[head + i] = True
    return used


def main_text(lines: list[tuple[int, str]], shared: list[bool]) -> str:
    main = [s for z, s in lines if z == MAIN]
    own = [s for (z, s), c in zip(lines, shared, strict=True) if z == BODY and not c]
    return "\n\n".join(main or own or [s for z, s in lines if z == BODY])


def difference_only(lines: list[tuple[int, str]], shared: list[bool]) -> str:
    """What the difference alone would leave, to compare with."""
    return "\n\n".join(s for (_, s), c in zip(lines, shared, strict=True) if not c)


@dataclass
class _Page:
    id: int | None
    url: str | None
    host: str
    path: str
    lines: list[tuple[int, str]]
    kind: int  # other than OWN: to be looked at only


def _alike(a: _Page, b: _Page | None) -> int:
    """Length of the common beginning of the paths, -1 for another host."""
    if b is None or a.host != b.host:
        return -1
    n = 0
    for x, y in zip(a.path, b.path, strict=False):
        if x != y:
            break
        n += 1
    return n


def _shared(a: _Page, b: _Page) -> list[bool]:
    return common_lines([x for _, x in a.lines], [x for _, x in b.lines])


def _copies(a: _Page, b: _Page) -> bool:
    """Whether two pages of one host are nearly the same."""
    if a.host != b.host:
        return False
    if a.lines == b.lines:
        return True
    part = []  # hundredths of the words that the other page doesn't share
    for x, y in ((a, b), (b, a)):
        words = [(len(s.split()), c) for (z, s), c in zip(x.lines, _shared(x, y), strict=True) if z != CHROME]
        part.append(100 * sum(n for n, c in words if not c) / max(1, sum(n for n, _ in words)))
    return min(part) <= 10 and max(part) <= 50


ORDER = ("host", "path", "page_id", "url")


def _key(host: str, path: str, page_id: int | None, url: str | None) -> tuple:
    """Sorts as Spark sorts ``ORDER``."""
    return host.encode(), path.encode(), (page_id is not None, page_id or 0), (url is not None, (url or "").encode())


def _range_ends(keys: DataFrame, n: int) -> list[tuple[tuple, tuple]]:
    """The keys of the first and the last page of about ``n`` ranges, in order (two rows a range, without the pages)."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows:
                if last is None:
                    yield batch.slice(0, 1)
                last = batch.slice(batch.num_rows - 1, 1)
        if last is not None:
            yield last

    if n == 1:
        return [(_key("", "", None, None),) * 2]
    dealt = keys.repartitionByRange(n, *ORDER[:3]).sortWithinPartitions(*ORDER)
    got = sorted(_key(*r) for r in dealt.mapInArrow(ends, keys.schema).collect())
    return list(zip(got[::2], got[1::2], strict=True)) or [(_key("", "", None, None),) * 2]


def _pages(batches: Iterable[pa.RecordBatch]) -> Iterator[_Page]:
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "host", "path", "zones", "lines", "kind")]
        for i, u, h, p, z, x, k in zip(*cols, strict=True):
            yield _Page(i, u, h, p, list(zip(z, x, strict=True)), k)


class _Group:
    """Waiting pages in order: about ``limit`` bytes of them in memory, the earlier ones in a file."""

    def __init__(self, limit: int):
        self.limit, self.last = limit, None
        self._waiting: list[_Page] = []
        self._held = self._dumps = 0
        self._file = None

    def add(self, page: _Page) -> None:
        size = PAGE_BYTES
        if self._waiting and page.lines == self.last.lines:
            page.lines = self.last.lines  # equal pages are held once
        else:
            size += sum(len(s) for _, s in page.lines)
        self._waiting.append(page)
        self.last = page
        self._held += size
        if self._held > self.limit:
            if self._file is None:
                self._file = TemporaryFile()
            pickle.dump(self._waiting, self._file)
            self._dumps += 1
            self._waiting, self._held = [], 0

    def __iter__(self) -> Iterator[_Page]:
        if self._file is not None:
            self._file.seek(0)
            for _ in range(self._dumps):
                yield from pickle.load(self._file)
            self._file.close()
        yield from self._waiting


_LINES = "part int, kind int, host string, path string, page_id long, url string, zones binary, lines array<string>"


def _read_lines(src: DataFrame, goes_to) -> DataFrame:
    """The pages' lines, for every ``(part, kind)`` that ``goes_to(key)`` names; a task sends a page that isn't OWN to a part once."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for batch in batches:
            for s in T.slices(batch, "html"):
                own, others = [], []
                for i, key in enumerate(map(_key, *(s.column(c).to_pylist() for c in ORDER))):
                    for part, kind in goes_to(key):
                        if kind == OWN:
                            own.append((i, part, kind))
                        elif (part, kind, key) not in sent:
                            sent.add((part, kind, key))
                            others.append((i, part, kind))
                pages = s.column("html")
                got = {i: page_lines(pages[i].as_py() or "") for i in {x[0] for x in chain(own, others)}}
                for some in (own, *(others[k:k + COPIES_AT_ONCE] for k in range(0, len(others), COPIES_AT_ONCE))):
                    if some:
                        row = [i for i, _, _ in some]
                        r = s.take(pa.array(row))
                        yield pa.RecordBatch.from_arrays([
                            pa.array([p for _, p, _ in some], pa.int32()), pa.array([k for _, _, k in some], pa.int32()), *(r.column(c) for c in ORDER),
                            pa.array([bytes(z for z, _ in got[i]) for i in row], pa.binary()), pa.array([[x for _, x in got[i]] for i in row], pa.list_(pa.string())),
                        ], names=["part", "kind", *ORDER, "zones", "lines"])

    return src.mapInArrow(lines, _LINES)


def _dealt(src: DataFrame, ends: list[tuple[tuple, tuple]], far: dict[tuple, list[int]], only: set[int] | None = None) -> DataFrame:
    """The pages' lines by ranges, in order, with the pages from other ranges; of ``only`` some ranges, their own pages."""
    lasts = [b[:3] for _, b in ends]

    def goes_to(key: tuple) -> list[tuple[int, int]]:
        r = min(bisect_left(lasts, key[:3]), len(ends) - 1)
        if only is not None:
            return [(r, OWN)] if r in only else []
        near = [(r - 1, NEAR)] if r and key == ends[r][0] else []
        near += [(r + 1, NEAR)] if r + 1 < len(ends) and key == ends[r][1] else []
        return [(r, OWN), *near, *((to, FAR) for to in far.get(key, ()))]

    return _read_lines(src, goes_to).repartitionById(len(ends), F.col("part")).sortWithinPartitions(*ORDER)


def _open_borders(src: DataFrame, ends: list[tuple[tuple, tuple]]) -> set[int]:
    """The ranges whose last page and the next range's first page are copies; only these pages are read."""
    if len(ends) == 1:
        return set()
    beside = defaultdict(list)
    for r in range(len(ends) - 1):
        beside[ends[r][1]].append((r, OWN))
        beside[ends[r + 1][0]].append((r, OWN))
    plain = [(h.decode(), p.decode(), i if has_id else None, u.decode() if has_url else None) for h, p, (has_id, i), (has_url, u) in beside]
    keys = src.sparkSession.createDataFrame(plain, "_host string, _path string, _page_id long, _url string")
    same = [src[c].eqNullSafe(keys[f"_{c}"]) for c in ORDER]
    read = _read_lines(src.join(F.broadcast(keys), same[0] & same[1] & same[2] & same[3], "left_semi"), lambda key: beside.get(key, ()))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for part, page in zip(batch.column("part").to_pylist(), _pages([batch]), strict=True):
                first = _key(page.host, page.path, page.id, page.url) != ends[part][1]  # of the next range
                if before and before[0] == part and first and not before[1] and _copies(before[2], page):
                    yield pa.RecordBatch.from_pydict({"part": [part]}, schema=pa.schema([("part", pa.int32())]))
                before = part, first, page

    return {r.part for r in read.repartition("part").sortWithinPartitions("part", *ORDER).mapInArrow(copies, "part int").collect()}


def _beyond(src: DataFrame, ends: list[tuple[tuple, tuple]], open_: set[int]) -> dict[tuple, list[int]]:
    """The keys of the pages before and behind groups that reach over borders, with the ranges that need them."""
    if not open_:
        return {}
    only = open_ | {r + 1 for r in open_}

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a range with several groups: the last page before its last group, the first page behind its first group."""
        before = pre = post = part = None
        for batch in batches:
            for part, page in zip(batch.column("part").to_pylist(), _pages([batch]), strict=True):
                if before and not _copies(before, page):
                    pre, post = before, post or page
                before = page
        if post:
            yield pa.RecordBatch.from_pylist([{"part": part, "behind": x is post, "host": x.host, "path": x.path, "page_id": x.id, "url": x.url} for x in (pre, post)], schema=_EDGES)

    found = _dealt(src, ends, {}, only).mapInArrow(edges, "part int, behind boolean, host string, path string, page_id long, url string").collect()
    pre, post = ({r.part: _key(r.host, r.path, r.page_id, r.url) for r in found if r.behind == side} for side in (False, True))
    out = defaultdict(list)
    for step, inner, end in ((1, pre, 1), (-1, post, 0)):
        beyond = None
        for r in range(len(ends))[::step]:
            border = r - 1 if step == 1 else r  # the one that the group has come over
            came = border in open_
            if came and beyond:
                out[beyond].append(r)
            if r in inner:
                beyond = inner[r]
            elif not came:  # the range is one group, that begins at its border, or no group of it reaches over the next one
                beyond = ends[r - step][end] if 0 <= r - step < len(ends) else None
    return dict(out)


_EDGES = pa.schema([("part", pa.int32()), ("behind", pa.bool_()), ("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string())])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", pick=main_text) -> DataFrame:
    """``page_id long, url string, text string, n_chars long`` for every row."""
    spark = pages.sparkSession
    ship(spark)
    url = F.col(url_col).cast("string")
    rest = F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), r"[?#].*$", "")
    place = [F.coalesce(F.lower(F.regexp_extract(rest, r"^[^/]*", 0)), F.lit("")).alias("host"), F.coalesce(F.regexp_extract(rest, r"/.*$", 0), F.lit("")).alias("path"),
             F.col(id_col).cast("long").alias("page_id"), url.alias("url")]
    src = pages.select(*place, F.col(html_col).cast("string").alias("html"))
    ends = _range_ends(pages.select(*place), min(RANGES, max(1, text_bytes(pages, html_col) // RANGE_BYTES)))
    far = _beyond(src, ends, _open_borders(src, ends))
    limit = GROUP_BYTES

    def texts(group: Iterable[_Page], before: _Page | None, after: _Page | None) -> Iterator[dict]:
        prev, own = before, None
        for page in chain(group, [after]):
            if own and own.kind == OWN:
                # A page with a main zone is safe from the difference.
                a, b = (prev, page) if any(z == MAIN for z, _ in own.lines) else (before, after)
                partner = a if _alike(own, a) >= max(0, _alike(own, b)) else b
                shared = _shared(own, partner) if partner and partner.host == own.host else [False] * len(own.lines)
                text = pick(own.lines, shared)
                yield {"page_id": own.id, "url": own.url, "text": text, "n_chars": len(text)}
            prev, own = own or before, page

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        before: _Page | None = None
        group = _Group(limit)
        for page in _pages(batches):
            if page.kind == FAR:  # it stands before the range's first group or behind its last one
                yield from texts(group, before, page)
                before, group = page, _Group(limit)
                continue
            if group.last and not _copies(group.last, page):
                yield from texts(group, before, page)
                before, group = group.last, _Group(limit)
            group.add(page)
        yield from texts(group, before, None)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = rows(batches)
        while out := list(islice(got, BATCH_ROWS)):
            yield pa.RecordBatch.from_pylist(out, schema=_TEXT)

    return _dealt(src, ends, far).mapInArrow(differ, "page_id long, url string, text string, n_chars long")


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
