"""Main text of web pages by differencing each page with its nearest URLs.

A page becomes text lines, one per block.  The pages of a host are put in the order of their URL
paths (numbers in a path compare as numbers), and each page is aligned with the page before and
the page after it by a longest common subsequence of lines.  Lines that a neighbour shares are
the host's template and are deleted, unless the neighbour is a copy: one that shares more than
``COPY_SHARE`` of the page's own text tells nothing about templates.

Markup adds what differencing cannot know from two pages alone: lines inside an element that the
page itself marks as its article (article, main, role or itemprop) are its content, shared or
not, and if there is such an element only its lines count; lines inside navigation, footers,
asides, page headers and controls never count.  Forms, and elements whose class or id *is* furniture
(a whole name, or a compound whose head is the word: ``cookie-bar``, not ``has-sidebar`` or
``side-note``), are suspects.  Inside the article a suspect's lines go; outside it they go unless the
suspect holds the page's article, or, on a page that marks none, over half of its text: page-wide
forms and wrappers are seen through, comments never are.

Pages are dealt to ranges of the order (cut points from a sample of keys), and the first and last
page of a range also travel to the ranges beside it, so a host of any size is spread over tasks
that hold three pages at a time.

Defined results: a null or empty page has an empty text; a page without URL or alone on its host
has no neighbour; repeated rows are each other's copies; ties in the order are broken by URL, id.
Very long pages are parsed whole, in time that follows their length.  An empty table gives no rows;
only id, URL and source are read, so other columns may have any name.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyfig.llm.common import shuffle_parts

COPY_SHARE = 0.9
#: Keys that the cut points are taken from, per range.
SAMPLED = 32

OUT, FREE, MAIN = 0, 1, 2

_BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
option p pre section summary table tbody td tfoot th thead title tr ul""".split())
#: Elements whose content never is text, and elements whose content never is the article's.
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp math svg object".split())
_OUTSIDE = frozenset("nav footer aside button select dialog menu head".split())
_TRACKED = _OUTSIDE | frozenset("form header article main section div ul ol li table tbody tr td th figure blockquote dl details fieldset span center body".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset("navigation banner contentinfo complementary menu menubar".split())
_SUSPECT_ROLES = frozenset("search form alert dialog alertdialog".split())
#: Words (fixed) that name furniture, comments, page heads; words that only hold or place what they
#: are joined to; words that tell a state, so that the name is not the element's.
_WORD = re.compile(r"""ads?|advert\w*|adsense|banner|sidebar|side|menu|nav\w*|topnav|breadcrumbs?|cookies?|consent|gdpr|notice|alert|popup|
modal|overlay|newsletter|subscribe|subscription|signup|promo\w*|sponsor\w*|share|sharing|social|related|recommend\w*|footer|footnav|
copyright|widgets?|toolbar|pagination|pager|login|search|skip|toc|teasers?|tags""".replace("\n", ""))
_COMMENT = re.compile(r"comments?|commentlist|replies|reply|disqus|respond")
_HEADER = re.compile(r"header|masthead|topbar|hero")
_HOLDS = frozenset("""list container wrapper wrap box bar area block section panel item items link links button buttons form inner
outer left right top bottom body text title row column col group holder slot unit zone main primary secondary content post posts article articles stories""".split())
_STATE = frozenset("no not non has have with without is are can hide hidden show shown open closed enabled disabled on off".split())
_PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*)(?:>|$)""", re.S)
_NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _furniture(names: str, inside: bool) -> str:
    """What the class names and ids of an element make it: comment, other furniture, or nothing."""
    for name in names.split():
        parts = [p for p in _PART.split(name) if p and not p.isdigit()]
        parts = [p.lower() for p in parts]
        if _STATE.intersection(parts):
            continue
        while len(parts) > 1 and parts[-1] in _HOLDS:
            parts.pop()
        if parts and _COMMENT.fullmatch(parts[-1]):
            return "comment"
        if parts and (_WORD.fullmatch(parts[-1]) or not inside and _HEADER.fullmatch(parts[-1])):
            return "other"
    return ""


def _zone(tag: str, attributes: str, now: int) -> tuple[int, str]:
    """The zone inside an element that opens within zone ``now``, and what it is suspected to be."""
    if now == OUT or tag in _OUTSIDE:
        return OUT, ""
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes)} if "=" in attributes else {}
    role = named.get("role", "").lower()
    if tag == "body":
        return (MAIN if role in ("main", "article") else now), ""
    if role in _ROLES or tag == "header" and now != MAIN:
        return OUT, ""
    names = f"{named.get('class', '')} {named.get('id', '')}"
    kind = _furniture(names, now == MAIN or tag in ("article", "main")) if names != " " else ""
    if not kind and (tag == "form" or role in _SUSPECT_ROLES):
        kind = "other"
    if not kind and (tag in ("article", "main") or role in ("main", "article") or "articlebody" in named.get("itemprop", "").lower()):
        return MAIN, ""
    return now, kind


def parse(page: str | None) -> list[tuple[str, int]]:
    """(text, zone) of every block that has text, in page order."""
    page, text, at = page or "", [], 0
    blocks: list[tuple[str, int, tuple[int, ...]]] = []  # text, zone, suspects around it
    kinds: list[tuple[str, bool]] = []  # of suspects: what they are, and whether they are inside the article
    stack: list[tuple[str, int, tuple[int, ...]]] = []
    opened: dict[str, int] = {}
    zone, suspects = FREE, ()

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                blocks.append((line, zone, suspects))
            text.clear()

    while True:
        m = _TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece:
            text.append(html.unescape(piece))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in _BLOCKS:
            flush()
        if m[1]:
            if opened.get(tag):
                flush()
                while True:
                    last, zone, suspects = stack.pop()
                    opened[last] -= 1
                    if last == tag:
                        break
        elif tag in _RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)", re.I).search(page, at)
                at = end.start() if end else len(page)
        elif tag in _TRACKED and tag not in _VOID:
            inside, kind = _zone(tag, m[3], zone)
            if inside != zone or kind:
                flush()
            stack.append((tag, zone, suspects))
            opened[tag] = opened.get(tag, 0) + 1
            if kind:
                kinds.append((kind, zone == MAIN))
                suspects = (*suspects, len(kinds) - 1)
            zone = inside
    flush()
    return _resolved(blocks, kinds)


def _resolved(blocks: list[tuple[str, int, tuple[int, ...]]], kinds: list[tuple[str, bool]]) -> list[tuple[str, int]]:
    """The blocks' zones, once it is known what the suspects hold."""
    clear: set[int] = set()
    outer = {i for i, (kind, inside) in enumerate(kinds) if kind != "comment" and not inside}
    marked: dict[tuple[int, ...], int] = {}
    held: dict[int, int] = {}
    total = 0
    for line, zone, around in blocks if kinds else ():
        if zone == OUT:
            continue
        total += len(line)
        if zone == MAIN and outer.issuperset(around):
            marked[around] = marked.get(around, 0) + len(line)
        for i in around:
            held[i] = held.get(i, 0) + len(line)
    if marked and () not in marked:  # the article is inside suspects
        clear = set(max(marked, key=lambda k: marked[k]))
    elif not marked:
        clear = {i for i in outer if 2 * held.get(i, 0) > total}
    return [(line, zone if clear.issuperset(around) else OUT) for line, zone, around in blocks]


def common_lines(a: list[str], b: list[str], keep: int = 256) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    A row of the table is one integer with a bit per line of ``b``, and a line of ``a`` a few
    operations on it, however many pairs are equal.  Every ``keep``-th row is kept, the rows
    between two of them are made again for the way back."""
    where: dict[str, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1

    def step(row: int, line: str) -> int:
        hit = row & where.get(line, 0)
        return ((row + hit) | (row - hit)) & full

    row, kept = full, []
    for i, line in enumerate(a):
        if i % keep == 0:
            kept.append(row)
        row = step(row, line)
    out, j = [], len(b)
    for start in range((len(kept) - 1) * keep, -1, -keep):
        stop = min(start + keep, len(a))
        rows = [kept[start // keep]]
        for line in a[start:stop]:
            rows.append(step(rows[-1], line))
        i = stop
        while i > start and j:
            if rows[i - start] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if i == 0 or rows[i - start] >> (j - 1) & 1:
                out.append(i)
                j -= 1
    return out[::-1]


def template(page: list[str], neighbour: list[str], own: list[bool]) -> set[int] | None:
    """Places of the lines shared with a neighbour; None if it is a copy of the page's own text."""
    shared = set(common_lines(page, neighbour))
    size = sum(len(x) for x, o in zip(page, own, strict=True) if o)
    copied = sum(len(x) for k, x in enumerate(page) if own[k] and k in shared)
    return None if size and copied > COPY_SHARE * size else shared


def key_of(url: str | None, page_id: object) -> str:
    """A string whose order is that of host, path, URL, id; pages without URL come first."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "", re.I)
    host, path = (m[1].lower(), m[2]) if m else ("", url or "")
    path = re.sub(r"\d+", lambda x: f"{len(x[0].lstrip('0')):04d}{x[0].lstrip('0')}", path.removesuffix("/").removesuffix(".html"))
    return f"{host}\0{path}\0{url or ''}\0{'' if page_id is None else page_id:>20}"


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, lines of the page, lines shared with a neighbour."""
    spark, parts = pages.sparkSession, shuffle_parts(pages.sparkSession)
    sent = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{source}`").cast("string").alias("html"))
    urls = sent.select("page_id", "url")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(key_of, batch.column(1).to_pylist(), batch.column(0).to_pylist()), pa.string())], names=["key"])

    n = urls.count()
    every = max(1, n // (SAMPLED * parts))
    sample = sorted(r["key"] for r in urls.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(every)) == 0).mapInArrow(keys, "key string").collect())
    cuts = sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, str] = {}
        high: dict[int, str] = {}
        for batch in batches:
            for k in map(key_of, batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                p = bisect_right(cuts, k)
                low[p], high[p] = min(k, low.get(p, k)), max(k, high.get(p, k))
        yield pa.RecordBatch.from_arrays([pa.array(low.keys(), pa.int32()), pa.array(low.values(), pa.string()), pa.array(high.values(), pa.string())], names=["part", "low", "high"])

    # a row a range: its first and last key
    found = urls.mapInArrow(ends, "part int, low string, high string").groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    edges = sorted((r["part"], r["low"], r["high"]) for r in found)
    to: dict[str, set[int]] = {}
    for (p, _, high), (q, low, _) in zip(edges, edges[1:], strict=False):
        to.setdefault(high, set()).add(q)
        to.setdefault(low, set()).add(p)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                rows = []
                for i, u, h in zip(*(c.to_pylist() for c in batch.slice(a, 500).columns), strict=True):
                    k = key_of(u, i)
                    lines = parse(h)
                    own = bisect_right(cuts, k)
                    rows += [(p, k, int(p != own), i, u, [x for x, _ in lines], bytes(z for _, z in lines)) for p in (own, *to.get(k, ()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _DEALT.types, strict=True)], schema=_DEALT)

    _DEALT = pa.schema([("part", pa.int32()), ("key", pa.string()), ("extra", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("lines", pa.list_(pa.string())), ("zones", pa.binary())])
    dealt = (sent.withColumn("page_id", F.col("page_id").cast("long"))
             .mapInArrow(deal, "part int, key string, extra int, page_id long, url string, lines array<string>, zones binary")
             .repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "extra"))
    return dealt.mapInArrow(_walk, "page_id long, url string, text string, n_chars long, n_lines long, n_shared long")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages of ranges: each page between the ones before and the one after it.

    Where the page before is a copy, the last page before its run of copies stands in for it."""
    def rows() -> Iterator[dict | None]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                yield from batch.slice(a, 500).to_pylist()
        yield None

    out: list[tuple] = []
    earlier = before = page = None
    for after in rows():
        if page is not None:
            near = [x["lines"] if x is not None and _same_host(x, page) else None for x in (before, earlier, after)]
            made, copied = _result(page, *near)
            if not page["extra"]:
                out.append(made)
                if len(out) >= 500:
                    yield _made(out)
                    out = []
            earlier = earlier if copied else before
        before, page = page, after
    if out:
        yield _made(out)


def _made(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["page_id", "url", "text", "n_chars", "n_lines", "n_shared"])


def _same_host(a: dict, b: dict) -> bool:
    host = b["key"].split("\0", 1)[0]
    return a["part"] == b["part"] and host != "" and a["key"].split("\0", 1)[0] == host


def _result(page: dict, before: list[str] | None, earlier: list[str] | None, after: list[str] | None) -> tuple[tuple, bool]:
    """A page's row, and whether the page before it is a copy."""
    lines, zones = page["lines"], page["zones"]
    content = MAIN if MAIN in zones else FREE
    own = [z == content for z in zones]
    found = None if before is None else template(lines, before, own)
    copied = before is not None and found is None
    if copied and earlier is not None:
        found = template(lines, earlier, own)
    shared = (found or set()) | ((template(lines, after, own) if after is not None else None) or set())
    text = "\n".join(x for k, x in enumerate(lines) if own[k] and (content == MAIN or k not in shared))
    return (page["page_id"], page["url"], text, len(text), len(lines), len(shared)), copied
