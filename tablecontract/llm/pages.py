"""Main text of web pages by differencing each page with the page of the nearest URL on its host."""

from __future__ import annotations

import bisect
import builtins
import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import name_in, saved
from .urls import host_of, path_of

#: Bytes of pages that one task reads, about, and the number of tasks beyond which they get more.
RANGE_BYTES, MOST_RANGES = 128 << 20, 16_384
#: What pages are put in order by.
KEY = ["host", "path", "tie", "hash"]
#: Elements whose content is never text of the page.
RAW = "script style noscript template iframe object svg canvas textarea title xmp noembed noframes".split()
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-z][^>]*>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that never have content, and those whose end is often left out; neither opens a container.
_FLAT = frozenset("area base br col embed hr img input link meta param source track p li dt dd tr td th thead tbody tfoot option".split())
#: Flat elements with content, and the flat ones whose begin ends them; a paragraph also ends where a container begins.
_ENDS = {
    "p": frozenset("p li dt dd tr td th thead tbody tfoot hr".split()), "li": frozenset(("li",)), "option": frozenset(("option",)),
    **dict.fromkeys(("dt", "dd"), frozenset(("dt", "dd"))), **dict.fromkeys(("td", "th"), frozenset("td th tr thead tbody tfoot".split())),
    "tr": frozenset("tr thead tbody tfoot".split()), **dict.fromkeys(("thead", "tbody", "tfoot"), frozenset("thead tbody tfoot".split())),
}
SIDE_ELEMENTS = frozenset("head nav header footer aside form dialog menu select button fieldset datalist".split())
MAIN_ELEMENTS = frozenset(("article", "main"))
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog status menu menubar toolbar".split())
#: Words in the class or id of what is no part of an article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs"
    " header masthead footer sidebar aside widget widgets comment comments respond disqus cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended pagination pager toolbar search".split())
#: Of those, the ones that make an article element another story or a reader's comment.
_OTHER_ARTICLES = frozenset("comment comments related recommended promo promotion sponsored ad ads advert advertisement".split())
_OF_ARTICLE = frozenset("article entry post story content".split())


@dataclass
class Page:
    """The text lines of a page, in order: each block's text, whether it stands in an article, aside, or neither, and the innermost article's number (0: none)."""

    lines: list[str] = field(default_factory=list)
    zones: list[str] = field(default_factory=list)
    stories: list[int] = field(default_factory=list)


def parse(source: str) -> Page:
    """Blocks of text with character references decoded and runs of white space as one space; empty blocks are left out."""
    page, text, stack, side, at = Page(), [], [], 0, 0
    inside, stories = [0], 0  # the articles around a place, by number, and how many have begun
    flat = None  # a flat element that is no part of an article, and the number of containers around it

    def flush() -> None:
        if line := " ".join(references.unescape("".join(text)).split()):
            page.lines.append(line)
            page.zones.append("side" if side or flat else "main" if inside[-1] else "body")
            page.stories.append(inside[-1])
        text.clear()

    for m in _TOKEN.finditer(source):
        text.append(source[at : m.start()])
        at = m.end()
        name = (m["name"] or m["raw"] or "").lower()
        if m[0].startswith("<![CDATA["):
            text.append(references.escape(m[0][9:].removesuffix("]]>")))
        if not name or name in INLINE:
            continue
        flush()
        if m["raw"] or name[-1] == "/" or (m["attributes"] or "").endswith("/"):
            continue
        if name in _FLAT:
            if flat and flat[1] == len(stack) and (name == flat[0] if m["close"] else name in _ENDS[flat[0]]):
                flat = None
            if not flat and not m["close"] and name in _ENDS and _kind(name, m["attributes"]) == "side":
                flat = name, len(stack)
            continue
        if not m["close"]:
            if flat == ("p", len(stack)):
                flat = None
            kind = _kind(name, m["attributes"])
            stack.append((name, kind))
            side += kind == "side"
            if kind == "main":
                inside.append(stories := stories + 1)
        elif any(n == name for n, _ in stack):
            while True:
                n, kind = stack.pop()
                side -= kind == "side"
                if kind == "main":
                    inside.pop()
                if n == name:
                    break
            if flat and flat[1] > len(stack):
                flat = None
    text.append(source[at:])
    flush()
    return page


def _kind(name: str, attributes: str) -> str:
    if name in SIDE_ELEMENTS:
        return "side"
    words, role = set(), ""
    for m in _ATTRIBUTE.finditer(attributes or ""):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return "side"
        if key == "role":
            role = value
        elif key in ("class", "id"):
            words.update(re.split(r"[^a-z0-9]+", value))
    if role in SIDE_ROLES:
        return "side"
    if name in MAIN_ELEMENTS or role in MAIN_ELEMENTS:
        return "side" if words & _OTHER_ARTICLES else "main"
    if name in ("html", "body") or name[0] == "h" and name[1:].isdigit():
        return ""
    return "side" if words & (SIDE_WORDS - ({"header"} if words & _OF_ARTICLE else set())) else ""


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of both lists.

    One bit of a number stands for each line of ``a``, so a step over a line of ``b``
    is a few operations on whole numbers; lines that only one list has are left out first.
    """
    both = set(a) & set(b)
    places, other = [i for i, x in enumerate(a) if x in both], [x for x in b if x in both]
    match: dict[str, int] = {}
    for k, i in enumerate(places):
        match[a[i]] = match.get(a[i], 0) | 1 << k
    full = (1 << len(places)) - 1
    row, rows = full, []
    for x in other:
        hit = row & match[x]
        row = (row + hit | row - hit) & full
        rows.append(row)
    shared, j, k = set(), len(other), len(places)
    while j and k:
        if rows[j - 1] >> k - 1 & 1:
            k -= 1
            continue
        j -= 1
        if not j or rows[j - 1] >> k - 1 & 1:
            k -= 1
            shared.add(places[k])
    return shared


def _difference(page: Page, near: Page) -> set[int] | None:
    """Places of lines that only ``page`` has and that no menu, notice or the like holds; None if the other page is a copy in this sense, which tells nothing."""
    own = set(_text_of(page)) - common_lines(page.lines, near.lines)
    return own if own or [page.lines[i] for i in _text_of(page)] != [near.lines[i] for i in _text_of(near)] else None


def _text_of(page: Page) -> list[int]:
    return [i for i, zone in enumerate(page.zones) if zone != "side"]


def main_text(page: Page, near: Page | None, other: Page | None = None) -> str:
    """What is left of a page when the lines that the near page shares are deleted, checked against its markup.

    A near page that is a copy but for menus, notices and the like tells nothing apart: the other page takes its
    place, and if that is one too, or missing, all lines count as the page's own.

    Without an article, the page's own lines are the text. With articles, the text is those that have lines of their own,
    and the check makes them whole: a line the near page happens to have as well (a heading, a passage repeated) is put
    back. An article that has none stands on the near page too (a teaser, a notice in an article's tags) and goes, unless
    no article has any. Own lines outside of articles, and all lines in menus, notices and the like, go.
    """
    own = next((d for x in (near, other) if x and (d := _difference(page, x)) is not None), None)
    own = set(_text_of(page)) if own is None else own
    if "main" in page.zones:
        kept = {page.stories[i] for i in own} - {0} or set(page.stories) - {0}
        own = {i for i in _text_of(page) if page.stories[i] in kept}
    return " ".join(page.lines[i] for i in sorted(own))


def extract(
    pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", range_bytes: int = RANGE_BYTES, most_ranges: int = MOST_RANGES
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; the text is empty if there is none.

    Pages are put in the order of host and path over the whole cluster, and each is
    compared with its neighbour on the same host whose path begins like its own for longest, the
    one before it if both do. Copies of a page that follow each other count as one page, so a
    neighbour is always another page; if it still has the same text, under other menus, the neighbour on
    the other side is taken. See ``main_text`` for what the difference decides and what the markup checks.

    The order is cut into ranges of about ``range_bytes`` by a sample of the keys, each range being one
    task's. The keys, which end in a hash of the page, are written once (some 100 bytes a page); from them the
    driver learns a few pages at the ends of each range, and these visit the ranges that need them as
    neighbours, so the cuts change no result. Rows with one key, however many, are dealt in
    turn over the ranges between whose cuts the key lies, and each of those gets the same neighbours.
    A task holds three different pages at a time, and ids and URLs of the copies of two. Pages themselves are shuffled once.

    Null html is empty, a null URL has an empty host and path; repeated rows come out as often as they
    came in; no pages give no rows; other columns are not carried. The rows of a partition have to come in the
    same order each time it is read, as those of files do.
    """
    spark = pages.sparkSession
    rows = pages.select(
        name_in(pages, id).alias("page_id"), name_in(pages, url).cast("string").alias("url"), F.coalesce(name_in(pages, html).cast("string"), F.lit("")).alias("html"))
    tie = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "tie": tie, "hash": F.xxhash64("html")})
    size = F.octet_length("html") + F.coalesce(F.octet_length("url"), F.lit(0)) + 16
    keys = saved(rows.select(*KEY, size.cast("long").alias("size")), "page_keys")
    whole = keys.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size")).first()
    ranges = min(most_ranges, max(2 * spark.sparkContext.defaultParallelism, -(-(whole["size"] or 0) // range_bytes)))
    share = min(1.0, 20 * ranges / max(1, whole["rows"]))  # about 20 keys a range
    sample = sorted(tuple(r) for r in keys.select(*KEY).sample(share, seed=1).collect())
    cuts = sample[:: -(-len(sample) // ranges)][1:] if sample else []

    def place(*key: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(cuts, k) for k in zip(*key, strict=True)], dtype="int32")

    visits = _visits(keys.withColumn("range", F.pandas_udf(place, "int")(*KEY)), cuts)

    def deal(series: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        dealt: Counter[tuple] = Counter()
        for key in series:
            ranges = []
            for k in zip(*key, strict=True):
                at = bisect.bisect_right(cuts, k)
                before = _begins(cuts, at) if at and cuts[at - 1] == k else at
                if before < at:
                    dealt[k] += 1
                    at -= dealt[k] % (at - before + 1)
                ranges.append(at)
            yield pd.Series(ranges, dtype="int32")

    rows = rows.select("*", F.lit(False).alias("visit"), F.pandas_udf(deal, "int")(*KEY).alias("range"))
    if visits:
        called = spark.createDataFrame([(*k, sorted(to)) for k, to in visits.items()], "host string, path string, tie string, hash long, ranges array<int>")
        # One row of each key visits, however many have it.
        guests = rows.join(F.broadcast(called), KEY).groupBy(*KEY).agg(*[F.first(c).alias(c) for c in ("page_id", "url", "html", "ranges")])
        guests = guests.select("page_id", "url", "html", *KEY, F.lit(True).alias("visit"), F.explode("ranges").alias("range"))
        rows = rows.unionByName(guests)
    rows = rows.repartitionById(max(1, len(cuts) + 1), "range").sortWithinPartitions(*KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = None, None
        for after in _runs(batches):
            if now:
                yield from told(before, now, after)
                now.rows = []
            before, now = now, after
        if now:
            yield from told(before, now, None)

    def told(before: _Run | None, now: _Run, after: _Run | None) -> Iterator[pa.RecordBatch]:
        texts: dict[int, str] = {}
        before, after = (x if x and x.host == now.host else None for x in (before, after))
        for path, ids, urls in now.rows:
            near, other = before, after
            if not before or after and _begin(after.first, path) > _begin(before.last, path):
                near, other = after, before
            if id_of(near) not in texts:
                texts[id_of(near)] = main_text(now.page, near and near.page, other and other.page)
            text = texts[id_of(near)]
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array([text] * len(ids), pa.string()), pa.array([len(text)] * len(ids), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    id_of = builtins.id
    schema = T.StructType([rows.schema["page_id"], *[T.StructField(n, t) for n, t in (("url", T.StringType()), ("text", T.StringType()), ("n_chars", T.LongType()))]])
    return rows.select("page_id", "url", "html", "host", "path", "visit").mapInArrow(run, schema)


def _begins(cuts: list[tuple], at: int) -> int:
    """The first of the ranges over which rows with the key of the cut before range ``at`` are dealt."""
    first = bisect.bisect_left(cuts, cuts[at - 1]) + 1
    return first if first < at else at


def _visits(keys: DataFrame, cuts: list[tuple]) -> dict[tuple, set[int]]:
    """Keys of the pages that other ranges than their own need as neighbours, and those ranges.

    Four keys of each range come to the driver: the first, the last, and those next to them that are another page.
    """
    key = F.struct(*KEY)
    ends = keys.groupBy("range").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    other = lambda end: (F.col("host") != F.col(f"{end}.host")) | (F.col("hash") != F.col(f"{end}.hash"))
    # Each side of the join is as many rows as there are ranges, or comes from the written keys.
    found = keys.join(F.broadcast(ends), "range").groupBy("range").agg(
        F.first("first").alias("first"), F.first("last").alias("last"),
        F.min(F.when(other("first"), key)).alias("second"), F.max(F.when(other("last"), key)).alias("before_last"))
    ends = [(r["range"], *[r[c] and tuple(r[c]) for c in ("first", "second", "before_last", "last")]) for r in found.orderBy("range").collect()]
    page = lambda k: (k[0], k[3])
    earlier, later = [None] * len(ends), [None] * len(ends)
    for i in range(1, len(ends)):
        (_, _, _, other_page, last), first = ends[i - 1], ends[i][1]
        earlier[i] = last if page(last) != page(first) else other_page or earlier[i - 1]
    for i in reversed(range(len(ends) - 1)):
        last, (_, first, other_page, _, _) = ends[i][4], ends[i + 1]
        later[i] = first if page(first) != page(last) else other_page or later[i + 1]
    visits: dict[tuple, set[int]] = {}
    for i, (at, first, second, _, last) in enumerate(ends):
        begin = _begins(cuts, at) if at and cuts[at - 1] == first else at
        for k, of, to in ((earlier[i], first, range(begin, at + 1)), (later[i], last, (at,)), (second or later[i], first, range(begin, at))):
            if k and k[0] == of[0] and len(to):
                visits.setdefault(k, set()).update(to)
    return visits


def _begin(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


@dataclass
class _Run:
    """Rows that follow each other with one host and html: the paths of the first and last, and path, ids and URLs of those that do not visit."""

    host: str
    source: str
    page: Page
    first: str
    last: str
    rows: list[tuple[str, pa.Array, pa.Array]] = field(default_factory=list)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Run]:
    now = None
    for batch in batches:
        host, path, html, visit = (batch.column(n).to_pylist() for n in ("host", "path", "html", "visit"))
        begin = 0
        for i in range(1, len(batch) + 1):
            if i < len(batch) and (html[i], host[i], path[i], visit[i]) == (html[begin], host[begin], path[begin], visit[begin]):
                continue
            if not now or (now.source, now.host) != (html[begin], host[begin]):
                if now:
                    yield now
                now = _Run(host[begin], html[begin], parse(html[begin]), path[begin], path[begin])
            now.last = path[begin]
            if not visit[begin]:
                # Taken, not sliced: a slice would keep the whole batch, pages and all.
                places = pa.array(range(begin, i))
                now.rows.append((path[begin], batch.column("page_id").take(places), batch.column("url").take(places)))
            begin = i
    if now:
        yield now
