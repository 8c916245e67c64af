"""Main text of web pages: block structure, and differencing against the page with the nearest URL of the same host."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import cut_lineage
from .common import table
from .registry import query

# Elements whose content is never text, and elements and roles that are not part of an article.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "select", "head", "title", "annotation", "annotation-xml")
OUTSIDE = ("nav", "footer", "aside", "form", "dialog", "menu", "button")
CONTENT = ("article", "main")
BLOCK = (
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
).split()
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
OUTSIDE_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alertdialog")
# Class and id values that mark what is not part of an article, as a whole or with companions ("cookie-notice", "share_buttons").
READER_NAMES = frozenset("comment comments commentlist disqus replies reply".split())
SMALL_NAMES = frozenset((
    "ad ads advert adverts advertisement advertisements consent cookie cookies newsletter notice promo promos sponsor sponsored sponsors"
).split())
OUTSIDE_NAMES = READER_NAMES | SMALL_NAMES | frozenset((
    "banner breadcrumb breadcrumbs footer masthead menu nav navbar navbox navigation popup related share sharing sidebar social subscribe widget"
).split())
# Words that leave a name's meaning as it is; any other word beside one ("related-work", "social-history") speaks of content.
COMPANIONS = frozenset((
    "area articles bar block body bottom box button buttons container content fixed form global icons inner item items left links list main "
    "media modal outer overlay page panel policy post posts primary right secondary section signup site slot stories text thread top tray unit "
    "wrap wrapper"
).split())
# Elements that are judged by all names, and small ones that only names of adverts and notices take away.
NAMED = ("div", "section", "ul", "ol", "dl", "table", "header", "details")
SMALL = ("p", "span", "a", "ins", "li", "figure", "center", "h2", "h3", "h4", "h5", "h6")
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$|[\"'][^>]*$)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACE = re.compile(r"\s+")
PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
# A block as it comes from the page: inside an article or main element, elsewhere, or in a menu, footer, advert and the like.
INNER, OUTER, ASIDE = 1, 0, 2


def _outside(name: str, attributes: str, within: bool) -> bool:
    if name in OUTSIDE or name == "header" and not within:
        return True
    if not attributes:
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "role" and (a or b or c).lower() in OUTSIDE_ROLES or key == "hidden" or key == "aria-hidden" and (a or b or c).lower() == "true":
            return True
    return False


def _named_outside(name: str, attributes: str) -> bool:
    if not attributes:
        return False
    if name in NAMED:
        known = OUTSIDE_NAMES
    elif name in SMALL:
        known = SMALL_NAMES
    elif name == "article":
        known = READER_NAMES
    else:
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id"):
            for value in (a or b or c).split():
                if value.lower() in known:
                    return True
                words = {w.lower() for w in PARTS.split(value) if w}
                if not known.isdisjoint(words) and words <= OUTSIDE_NAMES | COMPANIONS:
                    return True
    return False


def _is_readers(attributes: str) -> bool:
    return any(
        key.lower() in ("class", "id") and not READER_NAMES.isdisjoint(w.lower() for value in (a or b or c).split() for w in PARTS.split(value))
        for key, a, b, c in ATTRIBUTE.findall(attributes)
    )


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(INNER or OUTER, text) for each block of visible text outside menus, footers, adverts and the like.

    Character references are decoded, white space becomes one blank.  Tags
    that are cut off or not closed are taken as they stand: a closing tag ends
    all that was opened since its opening tag, and one without it is ignored.

    A class or id never takes a main element with it.  Articles that names
    hide are shown if the page has no other article and they hold more text
    than all that is seen without them; those among reader comments only if
    nothing else is seen.
    """
    return [b for b in visible_blocks(page) if b[0] != ASIDE]


def visible_blocks(page: str | None) -> list[tuple[int, str]]:
    """(INNER, OUTER or ASIDE, text): `blocks`, and where they stand those of menus, footers, adverts and the like."""
    page = page or ""
    spared: set[int] = set()
    out, hidden, found = _blocks(page, spared)
    if hidden["main"]:
        spared |= hidden["main"]
        out, hidden, found = _blocks(page, spared)
    if found:
        return out
    for kind in ("article", "reader"):
        if hidden[kind] and not (kind == "reader" and any(k != ASIDE for k, _ in out)):
            shown = _blocks(page, spared | hidden[kind])[0]
            inner = sum(len(text) for k, text in shown if k == INNER)
            if inner > sum(len(text) for k, text in out if k != ASIDE):
                return shown
    return out


def _blocks(page: str, spared: set[int]) -> tuple[list[tuple[int, str]], dict[str, set[int]], bool]:
    """The blocks, where the tags start whose names hide content, and whether an article was seen.

    Hidden content is told apart as main elements, articles, and articles
    among reader comments.  `spared` are starts of tags that are not judged by
    their names.  Time is linear in the page, whatever its nesting.
    """
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    aside: list[str] = []  # text of what is outside
    open_tags: list[str] = []
    dropped_at = 0  # depth at which what is outside began, 0 for none
    opened: Counter[str] = Counter()  # open elements by name
    open_blocks: list[int] = []  # places of block elements in open_tags
    named: list[tuple[int, int]] = []  # depths and starts of open elements that are outside by name
    readers = 0  # how many of them hold reader comments
    reader_starts: set[int] = set()
    content: list[int] = []  # depths of open article and main elements
    hidden: dict[str, set[int]] = {"main": set(), "article": set(), "reader": set()}
    told: dict[str, int] = {}  # how many of the named are in hidden already
    found = False
    raw_end: str | None = None

    def flush() -> None:
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((INNER if content else OUTER, text))

    def flush_aside() -> None:
        if aside:
            text = SPACE.sub(" ", entities.unescape("".join(aside))).strip()
            aside.clear()
            if text:
                out.append((ASIDE, text))

    def flush_here() -> None:
        if dropped_at or named:
            flush_aside()
        else:
            flush()

    def close() -> str:
        nonlocal dropped_at, readers
        gone = open_tags.pop()
        opened[gone] -= 1
        depth = len(open_tags)
        if open_blocks and open_blocks[-1] == depth:
            open_blocks.pop()
        if content and content[-1] > depth:
            flush()
            content.pop()
        if dropped_at > depth:
            dropped_at = 0
        if named and named[-1][0] > depth:
            readers -= named.pop()[1] in reader_starts
            for kind in told:
                told[kind] = min(told[kind], len(named))
        if not (dropped_at or named):
            flush_aside()
        return gone

    at = 0
    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if raw_end is not None:
            # Only its own closing tag ends raw content.
            end = re.compile(rf"</{raw_end}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            raw_end = None
            if not end:
                break
            at = end.end()
            continue
        if not m:
            (aside if dropped_at or named else parts).append(page[at:])
            break
        if m.start() > at:
            (aside if dropped_at or named else parts).append(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:  # closing
            if opened[name]:
                if name in BLOCK:
                    flush_here()
                while close() != name:
                    pass
            elif name in BLOCK:
                flush_here()
            continue
        if name in BLOCK:
            flush_here()
        if name in VOID or m[3].endswith("/"):
            continue
        if name in RAW:
            raw_end = name if name != "head" else None
            if name != "head":
                continue
        if name == "body" and opened["head"]:
            while open_tags:
                close()
        # An open paragraph ends where a block begins; list items and cells end where the next begins.
        if name in BLOCK and open_blocks and open_tags[open_blocks[-1]] == "p" and name not in ("br", "option"):
            while close() != "p":
                pass
        if name in ("li", "dd", "dt", "td", "th", "tr", "option") and open_tags and open_tags[-1] == name:
            close()
        if name in BLOCK:
            open_blocks.append(len(open_tags))
        open_tags.append(name)
        opened[name] += 1
        if dropped_at:
            continue
        outside_by_name = m.start() not in spared and _named_outside(name, m[3])
        if name in CONTENT and not (name == "article" and outside_by_name):
            if not named:
                content.append(len(open_tags))
                found = found or name == "article"
            else:
                kind = "main" if name == "main" else "reader" if readers else "article"
                hidden[kind].update(start for _, start in named[told.get(kind, 0) :])
                told[kind] = len(named)
        elif name == "head" or _outside(name, m[3], bool(content)):
            dropped_at = len(open_tags)
        elif outside_by_name:
            named.append((len(open_tags), m.start()))
            if name == "article" or _is_readers(m[3]):
                readers += 1
                reader_starts.add(m.start())
    flush_here()
    return out, hidden, found


def _rises(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By how much each code of `b` lengthens the longest common subsequence of `a` with the codes up to it (0 or 1).

    One integer holds a bit for each code of `b`, and each code of `a` is one
    addition on it.  The bits of codes that are frequent in `b` are kept,
    those of the others are set when they are needed.
    """
    size = len(b)
    places: dict[int, list[int]] = {}
    for j, code in enumerate(b.tolist()):
        places.setdefault(code, []).append(j)
    often = max(64, int(size**0.5))
    kept: dict[int, int] = {}
    full = (1 << size) - 1
    state = full
    for code in a.tolist():
        at = places.get(code)
        if at is None:
            continue
        bits = kept.get(code)
        if bits is None:
            if len(at) == 1:
                bits = 1 << at[0]
            else:
                row = np.zeros(size, np.uint8)
                row[at] = 1
                bits = int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little")
            if len(at) >= often:
                kept[code] = bits
        hit = state & bits
        state = ((state + hit) | (state - hit)) & full
    raw = np.frombuffer(state.to_bytes(-(-size // 8), "little"), np.uint8)
    return 1 - np.unpackbits(raw, bitorder="little")[:size]


def shared_lines(a: Sequence, b: Sequence) -> list[bool]:
    """Which lines of `a` are in a longest common subsequence with `b`.

    Equal ends are taken off, then `a` is halved and `b` is cut where the
    halves have most in common with its parts, and so on.  Memory is linear
    in the lines but for the bits of frequent ones, of which there are at most
    the root of their number.
    """
    codes: dict = {}
    x = np.array([codes.setdefault(line, len(codes)) for line in a], np.int64)
    y = np.array([codes.setdefault(line, len(codes)) for line in b], np.int64)
    shared = np.zeros(len(x), bool)
    # Lines that only one side has take no part.
    left = np.flatnonzero(np.isin(x, y))
    x, y = x[left], y[np.isin(y, x)]
    todo = [(0, len(x), 0, len(y))]
    while todo:
        low, high, start, end = todo.pop()
        most = min(high - low, end - start)
        differ = np.flatnonzero(x[low : low + most] != y[start : start + most])
        same = int(differ[0]) if len(differ) else most
        shared[left[low : low + same]] = True
        low, start, most = low + same, start + same, most - same
        differ = np.flatnonzero(x[high - most : high][::-1] != y[end - most : end][::-1])
        same = int(differ[0]) if len(differ) else most
        shared[left[high - same : high]] = True
        high, end = high - same, end - same
        if low == high or start == end:
            continue
        if high - low == 1:
            shared[left[low]] = bool((y[start:end] == x[low]).any())
            continue
        middle = (low + high) // 2
        before = np.concatenate([[0], np.cumsum(_rises(x[low:middle], y[start:end]), dtype=np.int64)])
        after = np.concatenate([[0], np.cumsum(_rises(x[middle:high][::-1], y[start:end][::-1]), dtype=np.int64)])[::-1]
        cut = start + int(np.argmax(before + after))
        todo += [(low, middle, start, cut), (middle, high, cut, end)]
    return shared.tolist()


def _codes(found: list[tuple[int, str]]) -> list[int]:
    """A number for each block: a hash of the text, its last two bits say where it stands."""
    return [(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) & ~3 | kind) - (1 << 63) for kind, text in found]


def with_codes(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, codes): a number for each visible block of the page, in page order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = pa.array([_codes(visible_blocks(t.as_py())) for t in b.column(2)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), codes], ["id", "url", "codes"])

    schema = T.StructType([
        T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()), T.StructField("codes", T.ArrayType(T.LongType())),
    ])
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, schema)


def with_blocks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, codes, lines): the visible blocks of each page; those of menus and the like come as their codes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [visible_blocks(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([_codes(f) for f in found], pa.list_(pa.int64())),
                pa.array([[None if k == ASIDE else t for k, t in f] for f in found], pa.list_(pa.string())),
            ], ["id", "url", "codes", "lines"])

    schema = T.StructType([
        T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()),
        T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("lines", T.ArrayType(T.StringType())),
    ])
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, schema)


def nearest_by_url(pages: DataFrame) -> DataFrame:
    """(id, partner): each page with the one before it in the order of URL paths within its host, the first with the next.

    `pages` has id and url.  The order is made by ranges of (host, path, id),
    so a host of any size is many tasks.  Neighbours across the border of two
    ranges are found from the first and last row of every range, a table of
    one row per task.  Pages without a URL or id, and the only page of a host,
    have no partner.
    """
    keys = pages.filter(F.col("id").isNotNull() & F.col("url").isNotNull()).select(
        "id", F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
    )
    ordered = keys.repartitionByRange("host", "path", "id").sortWithinPartitions("host", "path", "id")
    ordered = cut_lineage(ordered.select("host", "path", "id", F.spark_partition_id().alias("part")))
    row = F.struct("host", "path", "id")
    ends = ordered.groupBy("part").agg(F.min(row).alias("low"), F.max(row).alias("high"))
    # One row per range: the window over them is small.
    over = Window.orderBy("low")
    ends = ends.select("part", F.lag("high").over(over).alias("_before"), F.lead("low").over(over).alias("_after"))
    within = Window.partitionBy("part").orderBy("host", "path", "id")
    near = ordered.join(F.broadcast(ends), "part").select(
        "host", "id",
        F.coalesce(F.lag(row).over(within), "_before").alias("_b"), F.coalesce(F.lead(row).over(within), "_after").alias("_a"),
    )
    partner = F.when(F.col("_b.host") == F.col("host"), F.col("_b.id")).when(F.col("_a.host") == F.col("host"), F.col("_a.id"))
    return near.select("id", partner.alias("partner")).filter("partner IS NOT NULL AND partner != id")


def template_blocks(codes: list[int], theirs: list[int]) -> list[bool]:
    """Which blocks of a page are shared with the other: a longest common subsequence of those inside articles, one of those
    in menus and the like, and one of the others."""
    shared = [False] * len(codes)
    for kind in (INNER, OUTER, ASIDE):
        at = [i for i, c in enumerate(codes) if c & 3 == kind]
        for i, s in zip(at, shared_lines([codes[i] for i in at], [c for c in theirs if c & 3 == kind])):
            shared[i] = s
    return shared


def differenced(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_blocks, n_shared): every page aligned with the page of the nearest URL path on the same host.

    All visible blocks take part, and those that a longest common subsequence
    shares are deleted as template; structure then says what of the page is
    its article: of a page with blocks inside an article or main element these
    are the text, of another what is left outside of menus and the like.
    Blocks of the article are taken back where they were deleted, for articles
    may share sentences.  `n_shared` counts the deleted ones of `n_blocks`.

    The partners are found and sent as hashes of the blocks; the pages are
    read again for the texts, which travel once.
    """
    seen = cut_lineage(with_codes(pages, id_col, url_col, html_col))
    near = nearest_by_url(seen.select("id", "url")).groupBy("id").agg(F.min("partner").alias("partner"))
    others = seen.filter("id IS NOT NULL AND size(codes) > 0").groupBy(F.col("id").alias("partner")).agg(F.max("codes").alias("theirs"))
    pairs = near.join(others, "partner").select(F.col("id").alias("_id"), "theirs")
    rows = with_blocks(pages, id_col, url_col, html_col)
    joined = rows.join(pairs, rows["id"] == pairs["_id"], "left").select("id", "url", "codes", "lines", "theirs")

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, sizes, gone = [], [], []
            for codes, lines, theirs in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                shared = template_blocks(codes, theirs or [])
                kinds = [c & 3 for c in codes]
                if INNER in kinds:
                    kept = [t for t, k in zip(lines, kinds) if k == INNER]
                else:
                    kept = [t for t, k, s in zip(lines, kinds, shared) if k == OUTER and not s]
                texts.append("\n".join(kept))
                sizes.append(len(codes))
                gone.append(sum(shared))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(gone, pa.int32())],
                ["id", "url", "text", "n_blocks", "n_shared"],
            )

    schema = T.StructType([
        rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_blocks", T.IntegerType()),
        T.StructField("n_shared", T.IntegerType()),
    ])
    return joined.mapInArrow(difference, schema)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): the article of every page by `differenced`, blocks joined by line ends.

    Null and empty pages have the empty text.  Pages that share an id are each
    taken by themselves, with one partner.
    """
    return differenced(pages, id_col, url_col, html_col).select("id", "url", "text")


# What the blocks come to on the given pages: one article of headings and paragraphs each, with line breaks.
OP2_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS body FROM pages),
b AS (SELECT page_id, url, unnest(string_split_regex(body, '<(?:/?p|br|/?h1)>')) AS block,
  generate_subscripts(string_split_regex(body, '<(?:/?p|br|/?h1)>'), 1) AS i FROM a),
t AS (SELECT page_id, url, i, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  block, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS block FROM b),
n AS (SELECT page_id, url, i, trim(regexp_replace(block, '\s+', ' ', 'g')) AS block FROM t),
j AS (SELECT page_id, url, coalesce(string_agg(block, chr(10) ORDER BY i) FILTER (block <> ''), '') AS text FROM n GROUP BY page_id, url)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM j
"""


@query("op2_main_text", OP2_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(table(spark, sf, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )
