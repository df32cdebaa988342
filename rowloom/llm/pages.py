"""HTML extraction: the main text of web pages, with boilerplate found by host suffix arrays.

A page is read as blocks of text. Elements that mark boilerplate (menus, footers, forms,
adverts, comments and so on) are set apart, by tag or by a whole class name; an article or
main element is never set apart by its names, nor by those of elements around it. Blocks
inside such an element are the main text. The rest, on pages that mark no article, is judged by repetition: the streams of
words outside articles are concatenated, sorted as a suffix array to a depth of eight words,
and runs shared by distinct pages of one host are boilerplate. What no such run covers stays.

Each task sorts the suffixes of its own pages, host by host, and passes on one row for each
distinct prefix; equal prefixes of other tasks meet in one aggregation, so a host that fills
the table needs no task of its own.

A depth of eight words finds all that longer substrings would cover: every word of a repeated
substring of eight words or more lies in a repeated one of exactly eight.

Inside articles whole blocks are the units: a block of eight words or more that recurs on ten
distinct pages of its host is boilerplate too. Runs of words are not cut there, since pages
quote each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import staged

DEPTH = 8
# Up to so many blocks that pages lose, their numbers are sent to every task; beyond, all pages are shuffled.
GONE_BLOCKS = 500_000
# From how many distinct pages of a host on a block of an article is boilerplate, whatever the host's size.
BLOCK_PAGES = 10

# Elements of HTML by their part in a page.
RAW = "script style noscript template iframe object canvas annotation annotation-xml desc metadata select textarea button audio video datalist"
MARKED = "head title nav footer aside form menu dialog"
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul"
)
VOID = "area base br col embed hr img input link meta param source track wbr"
# Marked elements that wrap whole pages at times: an article inside one shows that it marks no boilerplate.
WRAPPING = "head header form dialog"
# Whole names in class, id and role that name boilerplate, without what parts their words.
NAMES = (
    "ad ads adbox adbanner adcontainer adslot adunit adwrapper adsbygoogle advert adverts advertisement advertisements "
    "advertising sponsor sponsored sponsoredcontent promo promotion banner cookie cookies cookiebanner cookiebar "
    "cookieconsent cookienotice consent gdpr notice alert popup modal overlay newsletter newslettersignup subscribe "
    "subscription signup login loginform share sharebar sharebuttons sharelinks sharing socialshare socialshares social "
    "socialicons sociallinks socialmedia socialbuttons related relatedarticles relatedcontent relatedlinks relatedposts "
    "relatedstories recommended recommendations trending sidebar sidebarleft sidebarright leftsidebar rightsidebar "
    "primarysidebar secondarysidebar sidebarwidget widgetarea comments comment commentlist commentform commentsarea "
    "commentssection commentsection usercomments postcomments readercomments articlecomments respond replies disqus disqusthread breadcrumb breadcrumbs menu mainmenu mobilemenu "
    "topmenu sidemenu dropdownmenu nav navbar navmenu navlinks topnav mainnav sitenav sidenav primarynav navigation "
    "mainnavigation sitenavigation postnavigation navigations footer sitefooter pagefooter mainfooter footernav "
    "footerlinks masthead siteheader topbar toolbar pagination pager search searchbar searchbox searchform skip skiplink "
    "skiptocontent skiplinks contentinfo complementary"
)
_RAW, _MARKED, _BLOCKS, _VOID, _WRAPPING, _NAMES = (
    frozenset(x.split()) for x in (RAW, MARKED, BLOCKS, VOID, WRAPPING, NAMES)
)
_APART = re.compile(r"[\W\d_]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)|\Z", re.I) for tag in _RAW}
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")

MAIN, LOOSE, SET_APART = 0, 1, 2


# Marks of boilerplate; a firm one is lifted by a main element inside it only, a loose one by an article too.
FIRM, SOFT = 2, 1


def _mark(tag: str, attributes: str, in_main: bool) -> int:
    """FIRM, SOFT or 0: how an element marks boilerplate. Articles and main elements never do."""
    if tag in ("html", "body", "article", "main"):
        return 0
    if tag in _MARKED or tag == "header" and not in_main:
        return SOFT if tag in _WRAPPING else FIRM
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value = next((v for v in values if v), "").lower()
        if name.lower() == "hidden" or name.lower() == "aria-hidden" and value == "true":
            return SOFT
        if any(_APART.sub("", word) in _NAMES for word in value.split()):
            return SOFT
    return 0


class _Part:
    """An element that marks boilerplate or main text, within another one."""

    __slots__ = ("above", "tag", "mark", "lifted", "in_main", "in_article", "zone")

    def __init__(self, above: _Part | None, tag: str, mark: int):
        self.above, self.tag, self.mark, self.lifted = above, tag, mark, 0
        self.in_main = not mark or above is not None and above.in_main
        self.in_article = tag == "article" or above is not None and above.in_article
        self.zone = LOOSE

    def lift(self, by: int) -> None:
        """Take back the marks around an article or main element.

        Marks within an article stay: articles in an article are comments on it or teasers
        of others. So do those around a menu, footer or aside that has the article.
        """
        part = None if self.in_article else self
        while part is not None and part.lifted < by and part.mark <= by:
            part.lifted = by
            part = part.above

    def settle(self) -> None:
        """The zone, after that of the part above."""
        zone = self.above.zone if self.above is not None else LOOSE
        if zone != SET_APART and self.mark > self.lifted:
            self.zone = SET_APART
        elif zone == LOOSE and not self.mark:
            self.zone = MAIN
        else:
            self.zone = zone


def blocks(html: str | None) -> list[tuple[int, str]]:
    """Blocks of a page in order, each with its part: MAIN, LOOSE or SET_APART."""
    html = html or ""
    out: list[tuple[_Part | None, str]] = []
    held: list[str] = []
    stack: list[tuple[str, _Part | None]] = []
    parts: list[_Part] = []
    part: _Part | None = None
    at, end = 0, len(html)

    def close() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append((part, text))
        held.clear()

    while at < end:
        token = _TOKEN.match(html, at)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            if token[0][0] != "<" or token[0] == "<":
                held.append(unescape(token[0]))
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in _RAW and not token["close"]:
            held.append(" ")
            if not token["attributes"].endswith("/"):
                at = _ENDS[tag].search(html, at).end()
            continue
        if tag in _BLOCKS:
            close()
        if tag in _VOID or tag in _RAW:
            continue
        if token["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                before = stack[depth][1]
                if before is not part:
                    close()
                part = before
                del stack[depth:]
        else:
            if tag == "body" and stack:
                part = stack[0][1]
                stack.clear()
            if tag in _BLOCKS or token["attributes"]:
                stack.append((tag, part))
                mark = _mark(tag, token["attributes"], part is not None and part.in_main)
                if mark or tag in ("article", "main"):
                    if tag not in _BLOCKS:
                        close()
                    if not mark and part is not None:
                        part.lift(FIRM if tag == "main" else SOFT)
                    part = _Part(part, tag, mark)
                    parts.append(part)
    close()
    for one in parts:
        one.settle()
    return [(one.zone if one is not None else LOOSE, text) for one, text in out]


def host(url: str | None) -> str:
    """The host of an address, lower case; null and other texts have the empty one."""
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _parsed(batches: Iterator[pa.RecordBatch]):
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("host", pa.int64()),
            ("page", pa.int64()),
            ("main", pa.list_(pa.string())),
            ("units", pa.list_(pa.int64())),
            ("loose", pa.list_(pa.string())),
            ("apart", pa.list_(pa.string())),
        ]
    )
    for batch in batches:
        rows = []
        for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            parts: tuple[list[str], ...] = ([], [], [])
            for zone, text in blocks(html):
                parts[zone].append(text)
            rows.append(
                {
                    "page_id": page_id,
                    "url": url,
                    "host": _hash(host(url)),
                    # Pages that say the same are one page, under whatever address.
                    "page": _hash("\n".join(parts[MAIN] + parts[LOOSE])),
                    "main": parts[MAIN],
                    # Blocks of the article as numbers; shorter ones than a run are not judged.
                    "units": [_hash(t) if len(t.split(None, DEPTH - 1)) == DEPTH else None for t in parts[MAIN]],
                    "loose": parts[LOOSE],
                    "apart": parts[SET_APART],
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def gram_hashes(words: list[str], depth: int = DEPTH) -> np.ndarray:
    """A hash of the words at each place and the ``depth - 1`` after it, the same in every task."""
    if len(words) < depth:
        return np.zeros(0, np.int64)
    one = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    out = np.zeros(len(words) - depth + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(depth):
            out = out * np.uint64(0x9E3779B97F4A7C15) + one[j : len(one) - depth + 1 + j]
            out ^= out >> np.uint64(31)
    return out.view(np.int64)


def suffix_groups(tokens: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a stream to a depth (a power of two) by prefix doubling.

    Returns the suffixes in order and the rank of each place; places of equal rank share
    their first ``depth`` tokens.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        after = np.append(rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64))[: len(rank)]
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable"), rank


def _prefixes(batches: Iterator[pa.RecordBatch]):
    """One row for each distinct prefix of a task's hosts, with the least and greatest page it is on."""
    for batch in batches:
        streams, hashes, hosts, pages = [], [], [], []
        number: dict[str, int] = {}
        end = -1
        for name, page, loose, apart in zip(
            *(batch.column(c).to_pylist() for c in ("host", "page", "loose", "apart")), strict=True
        ):
            words = " ".join(loose + apart).split()
            grams = gram_hashes(words)
            if not len(grams):
                continue
            # A mark of the host before each word keeps hosts apart; a mark of its own ends a page.
            streams.append(np.array([number.setdefault(f"{name} {w}", len(number)) for w in words] + [end], np.int64))
            end -= 1
            hashes.append(np.append(grams, np.zeros(len(words) - len(grams) + 1, np.int64)))
            valid = np.arange(len(words) + 1) < len(grams)
            hosts.append(np.where(valid, name, 0))
            pages.append(np.where(valid, page, 0))
            hashes[-1] = np.stack([hashes[-1], valid])
        if not streams:
            continue
        order, rank = suffix_groups(np.concatenate(streams))
        gram, valid = np.concatenate(hashes, axis=1)
        name, page = np.concatenate(hosts), np.concatenate(pages)
        order = order[valid[order] == 1]
        starts = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
        heads = order[starts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(name[heads]),
                pa.array(gram[heads]),
                pa.array(np.minimum.reduceat(page[order], starts)),
                pa.array(np.maximum.reduceat(page[order], starts)),
            ],
            names=["host", "gram", "low", "high"],
        )


def _units(batches: Iterator[pa.RecordBatch]):
    """One row for each distinct block and page of a task's hosts, by the suffix array of blocks."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("host", "page", "units")), strict=True)
        found = [(name, page, unit) for name, page, units in rows for unit in units if unit is not None]
        if not found:
            continue
        name, page, unit = np.array(found, np.int64).T
        number: dict[tuple[int, int], int] = {}
        order, rank = suffix_groups(np.array([number.setdefault((n, u), len(number)) for n, _, u in found]), 1)
        # Within a group of equal blocks, each page once.
        order = order[np.lexsort((page[order], rank[order]))]
        first = np.append(True, (rank[order][1:] != rank[order][:-1]) | (page[order][1:] != page[order][:-1]))
        heads = order[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(name[heads]), pa.array(unit[heads]), pa.array(page[heads])], names=["host", "unit", "page"]
        )


def repeated_units(parsed: DataFrame, least: int = BLOCK_PAGES) -> DataFrame:
    """host and unit of the blocks of articles on many distinct pages of their host."""
    units = parsed.select("host", "page", "units").mapInArrow(_units, "host long, unit long, page long")
    many = units.distinct().groupBy("host", "unit").agg(F.count("*").alias("n"))
    return many.where(F.col("n") >= least).select("host", "unit")


def _places(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row, name, loose in zip(*(batch.column(c).to_pylist() for c in ("row", "host", "loose")), strict=True):
            grams = gram_hashes(" ".join(loose).split())
            n = len(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row)), pa.array(np.full(n, name)), pa.array(grams), pa.array(np.arange(n))],
                names=["row", "host", "gram", "at"],
            )


def unique_runs(loose: list[str], covered: list[int], depth: int = DEPTH) -> str:
    """Blocks without the words that repeated runs, beginning at ``covered``, cover."""
    total = sum(len(b.split()) for b in loose)
    gone = np.zeros(total + depth + 1, np.int64)
    np.add.at(gone, np.array(covered, np.int64), 1)
    np.add.at(gone, np.array(covered, np.int64) + depth, -1)
    keep = np.cumsum(gone)[:total] == 0
    out, at = [], 0
    for block in loose:
        words = block.split()
        left = [w for w, k in zip(words, keep[at : at + len(words)], strict=True) if k]
        at += len(words)
        if left:
            out.append(" ".join(left))
    return "\n".join(out)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Blocks inside article or main elements, less marked boilerplate and less whole blocks
    that many distinct pages of their host share, are the text. Pages
    without such an element give the blocks outside marked boilerplate, less runs of eight
    words or more that distinct pages of their host share. A null html counts as empty and
    gives an empty text; null urls share one host; null and repeated page_ids are rows of
    their own; an empty table gives no rows; other columns are ignored.
    """
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _parsed,
        "page_id long, url string, host long, page long, main array<string>, units array<long>, loose array<string>, "
        "apart array<string>",
    )
    parsed = staged(read.withColumn("row", F.monotonically_increasing_id()), "pages")
    prefixes = parsed.select("host", "page", "loose", "apart").mapInArrow(
        _prefixes, "host long, gram long, low long, high long"
    )
    shared = (
        prefixes.groupBy("host", "gram")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low <> high")
        .select("host", "gram")
    )
    shared = staged(shared, "page-runs")
    open_pages = parsed.where("size(main) = 0 AND size(loose) > 0")
    found = open_pages.select("row", "host", "loose").mapInArrow(_places, "row long, host long, gram long, at long")
    covered = (
        found.join(shared, ["host", "gram"])
        .groupBy("row")
        .agg(F.collect_set("at").alias("covered"))  # at most one entry per word of the page
    )

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [
                unique_runs(loose, at or [])
                for loose, at in zip(batch.column("loose").to_pylist(), batch.column("covered").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    judged = (
        open_pages.join(covered, "row", "left")
        .select("page_id", "url", "loose", "covered")
        .mapInArrow(cut, "page_id long, url string, text string")
    )
    repeated = staged(repeated_units(parsed), "page-units")
    gone = (
        parsed.select("row", "host", F.posexplode("units").alias("at", "unit"))
        .join(repeated, ["host", "unit"])
        .groupBy("row")
        .agg(F.collect_set("at").alias("gone"))  # at most one entry per block of the page
    )
    gone = staged(gone, "page-gone")
    # Pages stay where they are while the numbers of lost blocks are few.
    lost = gone.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0]
    known = F.broadcast(gone) if lost <= GONE_BLOCKS else gone
    whole = parsed.where("NOT (size(main) = 0 AND size(loose) > 0)").select("row", "page_id", "url", "main")
    kept = F.filter("main", lambda _, i: ~F.array_contains("gone", i))
    marked = whole.join(known, "row", "left").select(
        "page_id",
        "url",
        F.array_join(F.when(F.col("gone").isNull(), F.col("main")).otherwise(kept), "\n").alias("text"),
    )
    return marked.unionByName(judged).withColumn("n_chars", F.length("text").cast("long"))
