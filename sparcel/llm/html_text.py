"""Main text of web pages: differences to the nearest page of the site, and what the markup says.

A page is cut into lines, one per block element. Pages of a host are ordered by URL path; the nearer
of two pages is the one whose path shares the longer prefix with that of the page. The lines of a page
and of those nearest to it are aligned by longest common subsequence; what recurs is template and is deleted.

Differencing cannot see menus, adverts or comments that differ from page to page. So markup is heard
as well: lines inside navigation, headers, footers, asides, forms, adverts, notices and comments go in
any case (but an element that its class sets apart stays if it holds the article or most of the text),
and if the page marks its article (or main part), the text is what stands in it. There, a
line has to recur on several of the pages, as two articles may quote alike. A template may be longer
than the text, so pages that share more than half of it count if several do. Pages with next to
nothing of their own are copies of each other; the search goes on past them.

Pages are parsed where they stand. Ordering and aligning work on line hashes; the numbers of deleted
lines go to the pages while there are few of them, else both are shuffled.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from itertools import groupby, islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm.common import checked_broadcast, stored

#: Elements that begin a line, that hold no text, and that hold no main text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = "script style noscript template svg math iframe object canvas textarea select button audio video title"
APART = frozenset("nav footer aside head dialog menu fieldset".split())
#: Words of class, id and role that mark what is no main text.
WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs masthead footer footers comment comments disqus reply replies respond "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended recommendations widget widgets toolbar pagination pager skip copyright contentinfo complementary dialog".split()
)
#: Words that may stand beside them in a class, and those of them that are of readers.
FRAME = frozenset(
    "list lists item items box boxes area block blocks bar wrap wrapper container section group panel region slot unit inner outer content body title header form "
    "google posts articles stories news button buttons link links icon icons text top bottom left right main primary secondary global site page post article entry thread".split()
)
TALK = frozenset("comment comments disqus reply replies respond".split())
#: Elements that never close, and elements that take part in nesting here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NESTED = frozenset(
    "article aside body div dialog fieldset footer form head header html main menu nav section ul ol dl table td th tr li figure details blockquote p span a h1 h2 h3 h4 h5 h6".split()
)

_GONE = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW.replace(' ', '|')})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
_MARK = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I)
_WORD = re.compile(r"[a-z]+")

ARTICLE, PLAIN, APART_LINE = 2, 1, 0
KEPT, GOES, GUESSED, SAID = range(4)
#: Pages that a page is compared with, and how many of them must have a line for it to be template.
PAGES, AGREE = 3, 2
#: The same for pages that share more than half of the text; what copies have at most to themselves (one part in OWN); pages around that outweigh copies.
ALIKE, MANY, OWN, ENOUGH = 4, 3, 10, 16
#: Pages of a host at either side, in the order of paths, that may be tried; pages of a block.
REACH, BLOCK = 32, 256
#: Most pages with deleted lines that are sent to where the pages are; beyond it the pages are shuffled.
NARROW = 100_000


def _marked(key: str, value: str) -> set[str]:
    """Words of WORDS that a class, id or role is made of; FRAME words beside them do not matter, others do."""
    found = set()
    for token in value.split():
        parts = set(_WORD.findall(token))
        if parts <= WORDS | FRAME:
            found |= parts & WORDS
    return found


def _apart(name: str, attributes: str, inside_article: bool) -> int:
    """Whether an element holds no main text: KEPT, GOES, or by its class or as a form GUESSED, as readers' words SAID."""
    if name in APART or (name == "header" and not inside_article):
        return GOES
    found = GUESSED if name == "form" else KEPT
    if not attributes or name in ("html", "body", "main"):
        return found
    for key, value in _MARK.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return GOES
        words = _marked(key, value) if key in ("class", "id", "role") else set()
        if words or (key == "class" and "header" in value.split() and not inside_article):
            found = SAID if found == SAID or words & TALK else GUESSED
    return found


def lines(page: str) -> list[tuple[str, int]]:
    """(text, ARTICLE, PLAIN or APART_LINE) of the blocks of a page, in order; blank ones are left out.

    An element that its class sets apart, or a form, stays if it holds most of the text, or the article
    where none is marked outside of such elements (not teasers shorter than the text beside them).
    What readers say is set apart unless it is all of the text.
    """
    page = _GONE.sub(lambda m: " " if m[0].startswith(("<!", "<?")) and not m[0].startswith("<!--") else "", page)
    out: list[tuple[str, bool, tuple[int, ...], tuple[tuple[int, ...], ...]]] = []
    top = ("", False, (), ())
    stack = [top]  # (element, goes, guesses around, guesses around each article around)
    guesses: list[int] = []  # kinds of the guessed elements
    held: list[str] = []
    now = top
    at = 0

    def end_line() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((text, *now[1:]))
            held.clear()

    for m in _TAG.finditer(page):
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        name = m[2].lower()
        if name in BLOCKS:
            end_line()
        elif name == "br":
            held.append(" ")
        if name not in NESTED or name in VOID:
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    end_line() if now[1:3] != stack[depth - 1][1:3] else None
                    del stack[depth:]
                    now = stack[-1]
                    break
        elif not m[3].endswith("/"):
            if name == "p":  # a paragraph ends where the next begins
                while stack[-1][0] in ("p", "span", "a"):
                    stack.pop()
                now = stack[-1]
            kind = _apart(name, m[3], bool(now[3]))
            if kind != KEPT and not now[1]:
                end_line()
            goes, around, articles = now[1] or kind == GOES, now[2], now[3]
            if kind in (GUESSED, SAID) and not goes:
                around = (*around, len(guesses))
                guesses.append(kind)
            if name in ("article", "main") and not goes:
                articles = (*articles, around)
            now = (name, goes, around, articles)
            stack.append(now)
    if at < len(page):
        held.append(page[at:])
    end_line()
    return _settled(out, guesses)


def _settled(found: list[tuple], guesses: list[int]) -> list[tuple[str, int]]:
    """Lines with their kinds, once it is known which of the guessed elements hold the text of the page."""
    stays: set[int] = set()
    if guesses:
        total = outside = whole = 0
        sizes, in_articles, inner = [0] * len(guesses), [0] * len(guesses), set()
        open_article = False  # an article outside of all guessed elements
        for t, goes, around, articles in found:
            if goes:
                continue
            total += len(t)
            outside += 0 if around else len(t)
            if () in articles:
                open_article = True
                inner.update(around)
            for g in around:
                sizes[g] += len(t)
            if articles and not any(guesses[g] == SAID for g in around):
                whole += len(t)
                for g in around:
                    in_articles[g] += len(t)
        stays = {g for g, kind in enumerate(guesses) if total and (sizes[g] == total or (kind == GUESSED and 2 * sizes[g] > total))}
        if open_article:
            stays &= inner
        elif whole and whole >= outside:
            stays |= {g for g, kind in enumerate(guesses) if kind == GUESSED and 2 * in_articles[g] > whole}
    out = []
    for t, goes, around, articles in found:
        if goes or not stays.issuperset(around):
            out.append((t, APART_LINE))
        else:
            out.append((t, ARTICLE if any(stays.issuperset(x) for x in articles) else PLAIN))
    return out


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in ``a`` of a longest common subsequence of two arrays, in space linear in their lengths."""
    places = np.flatnonzero(np.isin(a, b))
    a, b = a[places], b[np.isin(b, a)]
    return places[_lcs(a, b)]


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and every beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def _lcs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n, m = len(a), len(b)
    if not n or not m:
        return np.zeros(0, np.int64)
    start = 0
    while start < min(n, m) and a[start] == b[start]:
        start += 1
    if start:
        return np.concatenate([np.arange(start), start + _lcs(a[start:], b[start:])])
    if n == 1:
        return np.zeros(1 if (b == a[0]).any() else 0, np.int64)
    half = n // 2
    left, right = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])[::-1]
    cut = int((left + right).argmax())
    return np.concatenate([_lcs(a[:half], b[:cut]), half + _lcs(a[half:], b[cut:])])


def deleted_lines(own: np.ndarray, near: Sequence[np.ndarray]) -> list[int]:
    """Numbers of the text lines of a page that are template, from the pages around it, nearest first.

    Pages are tried until PAGES of them share at most half of the text, or ALIKE share more; copies of
    the page, or of a page that was tried, are passed over. A line goes if it is aligned with a line
    of AGREE of the first kind, or of MANY of both kinds; where no article is marked, also if the
    first of the first kind alone has it. If copies were met, what at least half of ENOUGH or more
    pages around have is template as well, unless nothing would be left. Lines that the markup leaves
    out are not listed. In a marked article only what stands at the same end of most articles around goes,
    see ``_at_same_end``.
    """
    text, plain = _text(own), not (own["kind"] == ARTICLE).any()
    agree, alike, gone = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.zeros(len(own), bool)
    tried, n_apart, n_alike, met_copy = [], 0, 0, False
    for other in near:
        if n_apart == PAGES or n_alike == ALIKE:
            break
        if not (text & np.isin(own["hash"], other["hash"])).any():
            n_apart += 1
            continue
        if _copies(own, other):
            met_copy = True
            continue
        if any(_copies(x, other) for x in tried):
            continue
        tried.append(other)
        shared = common_lines(own["hash"], other["hash"])
        share = text & np.isin(np.arange(len(own)), shared)
        there = _text(other) & np.isin(other["hash"], own["hash"][shared])
        if 2 * own["size"][share].sum() > own["size"][text].sum() or 2 * other["size"][there].sum() > other["size"][_text(other)].sum():
            n_alike += 1
            alike[share] += 1
            continue
        n_apart += 1
        agree[share] += 1
        if plain and n_apart == 1:
            gone |= share
    gone |= (agree >= AGREE) | (agree + alike >= MANY)
    if met_copy and len(near) >= ENOUGH:
        common = gone | (text & (2 * sum(np.isin(own["hash"], x["hash"]).astype(np.int64) for x in near) >= len(near)))
        gone = common if (text & ~common).any() else gone
    if gone.any() and not plain:
        gone = _at_same_end(own, near, gone)
    return np.flatnonzero(gone).tolist()


def _at_same_end(own: np.ndarray, near: Sequence[np.ndarray], gone: np.ndarray) -> np.ndarray:
    """Those of the lines of a marked article that most of the pages around have as many lines from its start, or from its end.

    An article may quote what others say; a template stands in one place. Lines go only if no equal line stays.
    """
    places = np.flatnonzero(_text(own))
    mine, votes, pages = own["hash"][places], np.zeros(len(places), np.int64), 0
    for other in near:
        if _copies(own, other):
            continue
        theirs, pages = other["hash"][_text(other)], pages + 1
        n = min(len(mine), len(theirs))
        same = np.zeros(len(mine), bool)
        same[:n] = mine[:n] == theirs[:n]
        same[len(mine) - n:] |= mine[len(mine) - n:] == theirs[len(theirs) - n:]
        votes += same
    out = np.zeros(len(own), bool)
    out[places] = gone[places] & (2 * votes > pages)
    return out & ~np.isin(own["hash"], own["hash"][_text(own) & ~out])


def _copies(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether each of two pages has less than one part in OWN of its text to itself."""

    def own(x, y):
        return OWN * int(x["size"][_text(x) & ~np.isin(x["hash"], y["hash"])].sum()) < int(x["size"][_text(x)].sum())

    return own(a, b) and own(b, a)


def _text(page: np.ndarray) -> np.ndarray:
    """Which lines are text, as the markup has it."""
    return page["kind"] == (ARTICLE if (page["kind"] == ARTICLE).any() else PLAIN)


def main_text(page: str | None, deleted: list[int] | None) -> str:
    found = lines(page or "")
    gone = set(deleted or ())
    own = ARTICLE if any(k == ARTICLE for _, k in found) else PLAIN
    return " ".join(t for i, (t, k) in enumerate(found) if k == own and i not in gone)


_LINE = np.dtype([("hash", "<u8"), ("size", "<u4"), ("kind", "u1")])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, path, html) -> (key, unit, host, path, lines): a unit is a host with a list of lines."""
    for batch in batches:
        out = []
        for key, host, path, page in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            rows = [(xxhash.xxh64_intdigest(t.encode()), min(len(t), 0xFFFFFFFF), k) for t, k in lines(page or "")]
            packed = np.array(rows, _LINE).tobytes()
            out.append((key, xxhash.xxh128_hexdigest((host or "").encode() + b"\0" + packed), host, path, packed))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.string()] * 4 + [pa.binary()], strict=True)],
                names=["key", "unit", "host", "path", "lines"],
            )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the number of the partition and of the row in it."""
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        numbers = [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(n, n + batch.num_rows))]
        n += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=[*batch.schema.names, "part", "nth"])


def blocks(units: DataFrame) -> DataFrame:
    """(block, place, unit, host, path, lines): the units in the order of host and path, in blocks.

    Units are ordered by ranges and numbered through, so a host may be spread over many tasks. A block
    has BLOCK units, and REACH more at either side that belong to the blocks beside it.
    """
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored(
        units.select("unit", "host", "path", "lines").repartitionByRange(parts, "host", "path", "unit").sortWithinPartitions("host", "path", "unit")
        .mapInArrow(_numbered, "unit string, host string, path string, lines binary, part int, nth long"),
        "ordered",
    )
    starts, total = {}, 0
    for part, n in sorted(ordered.groupBy("part").count().collect()):
        starts[part] = total
        total += n

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(5).to_numpy() + np.array([starts[p] for p in batch.column(4).to_pylist()], np.int64)
            for shift in (0, -REACH, REACH):
                block = (place + shift) // BLOCK
                to = np.flatnonzero((block >= 0) & (block * BLOCK < total) & ((block != place // BLOCK) | (shift == 0)))
                if len(to):
                    rows = batch.take(pa.array(to))
                    yield pa.RecordBatch.from_arrays([pa.array(block[to]), pa.array(place[to]), *rows.columns[:4]], names=["block", "place", "unit", "host", "path", "lines"])

    dealt = ordered.mapInArrow(deal, "block long, place long, unit string, host string, path string, lines binary")
    return dealt.repartition("block").sortWithinPartitions("block", "place")


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[int]]]:
    """For each block its rows in order, and the places in them of those that belong to it."""
    one_by_one = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for block, rows in groupby(one_by_one, key=lambda row: row[0]):
        rows = list(rows)
        yield rows, [i for i, row in enumerate(rows) if row[1] // BLOCK == block]


def _outward(rows: list[tuple], i: int) -> Iterator[int]:
    """Rows of the host of row ``i``, up to REACH at either side, nearest first: the longer the path they share, the nearer; ties go to those before."""

    def shared(j: int) -> int:
        if not 0 <= j < len(rows) or abs(i - j) > REACH or rows[j][3] != rows[i][3]:
            return -1
        return len(commonprefix([rows[i][4], rows[j][4]]))

    before, behind = i - 1, i + 1
    a, b = shared(before), shared(behind)
    while max(a, b) >= 0:
        if a >= b:
            yield before
            before, a = before - 1, shared(before - 1)
        else:
            yield behind
            behind, b = behind + 1, shared(behind + 1)


def nearest(units: DataFrame) -> DataFrame:
    """(unit, near) for the units (unit, host, path): the first of the pages that are tried; a unit alone on its host has none."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, own in _around(batches):
            pairs = [(rows[i][2], rows[j][2]) for i in own for j in islice(_outward(rows, i), 1)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*pairs, strict=True)], names=["unit", "near"])

    return blocks(units.withColumn("lines", F.lit(None).cast("binary"))).mapInArrow(first, "unit string, near string")


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks -> (unit, deleted) where there is something to delete."""
    for rows, own in _around(batches):
        pages = [np.frombuffer(row[5], _LINE) for row in rows]
        found = [(rows[i][2], deleted_lines(pages[i], [pages[j] for j in _outward(rows, i)])) for i in own]
        out = [(unit, gone) for unit, gone in found if gone]
        if out:
            u, d = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(d, pa.list_(pa.int32()))], names=["unit", "deleted"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    * A null or empty page, and one without main text, has the empty text. White space of any kind
      inside a block becomes one space; blocks are joined by one space.
    * Pages of a host with the same lines are one page when pairs are made, so copies never delete
      each other. A page without a url, or alone on its host, is judged by its markup.
    * Broken markup is read as far as it goes: what is not closed ends with the page.
    * Rows that repeat are extracted one by one, with the same result. Other columns are ignored. An
      empty table gives no rows.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
        F.md5(F.concat_ws("|", F.coalesce(F.col(url), F.lit("\n")), html)).alias("key"),
        F.lower(F.regexp_extract(bare, r"^[^/]*", 0)).alias("host"), F.regexp_replace(bare, r"^[^/]*", "").alias("path"),
    )
    parsed = stored(rows.where("url IS NOT NULL AND html <> ''").select("key", "host", "path", "html").mapInArrow(
        _line_rows, "key string, unit string, host string, path string, lines binary"), "lines")
    units = stored(parsed.groupBy("unit").agg(F.first("host").alias("host"), F.min("path").alias("path"), F.first("lines").alias("lines")), "units")
    deleted = blocks(units).mapInArrow(_deletions, "unit string, deleted array<int>")
    by_page = stored(parsed.select("key", "unit").distinct().join(deleted, "unit").select(F.col("key").alias("page_key"), "deleted"), "deleted")
    by_page = checked_broadcast(by_page, NARROW)
    met = rows.select("page_id", "url", "html", "key").join(by_page, F.col("key") == F.col("page_key"), "left")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], *T.StructType.fromDDL("text string, n_chars long").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, d) for p, d in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return met.select("page_id", "url", "html", "deleted").mapInArrow(run, schema)
