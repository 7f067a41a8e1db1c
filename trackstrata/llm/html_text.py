"""Main text of web pages by removing the templates of their site.

Every page is parsed into its text runs and its element subtrees. A subtree is hashed from its tags and text
(attributes vary within a template), and Spark counts, per host, the pages that hold it. The parse is done again when the cuts
are made, as moving the pages' hashes and not their texts costs less disk. Subtrees that recur on
``min_pages`` pages of a host are its template, and are cut from all its pages. Prose needs more, as passages and whole
articles are also repeated: a paragraph or heading, or anything inside the article, is template only if it stands on
``article_pages`` pages that are not all copies and on ``article_share`` of the host's pages, and only as long as all such cuts
leave at least half of the page's article; a subtree with more than half of a page's text never is one.

After that, what a site shows on too few pages to be counted is told by its markup: the article is what the page's ``article`` elements
hold (else ``main``, else the body), without the elements and class words listed below. Entities are decoded, white
space becomes one blank, blocks are joined by one blank.

Null or empty html gives the empty text. A url without a host has no site, so only markup decides there. Each
repeated row is a page of its own; extra columns pass through, those named like an output are replaced.
Broken markup is read as browsers do: unclosed elements end with their parent, ``p`` and ``li`` with the next one.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text, broadcast_under, packed, stored, unpacked

MIN_PAGES, ARTICLE_PAGES, ARTICLE_SHARE = 3, 5, 0.5
#: a key that holds more than one in so many rows counts as hot; there are at most so many hot keys
HOT = 10_000
#: cuts of so many pages are broadcast
BROADCAST_CUTS = 20_000

# Element names and class words of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul br".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
NO_TEXT = frozenset("nav footer aside form button select datalist dialog menu svg canvas object audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
COMMENTS = frozenset("comment comments commentlist commentary-list disqus respond reply replies".split())
NO_ARTICLE = COMMENTS | frozenset("ad ads advert advertisement promo related sponsored teaser".split())
WORDS = COMMENTS | frozenset(
    "ad ads adsense advert advertisement advertising adverts adbox adslot banner sponsor sponsored sponsors promo promotion promoted "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay paywall newsletter subscribe subscription "
    "signup login nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager sidebar sidebars masthead topbar "
    "share sharing social related recommended recommendations widget widgets searchform toolbar footer header "
    "sitefooter siteheader skiplink outbrain taboola".split()
)
#: an element of the first set, when it opens, ends an open one of the second, unless one of the third lies between
ENDS = (
    (frozenset({"li"}), frozenset({"li"}), frozenset("ul ol menu dir".split())),
    (frozenset("dt dd".split()), frozenset("dt dd".split()), frozenset({"dl"})),
    (frozenset("td th".split()), frozenset("td th".split()), frozenset({"table"})),
    (frozenset({"tr"}), frozenset({"tr"}), frozenset({"table"})),
    (frozenset("option optgroup".split()), frozenset({"option"}), frozenset({"select"})),
    (BLOCK - {"br"}, frozenset({"p"}), frozenset("article section div td th li blockquote body main aside nav header footer form table figure".split())),
)
#: an end tag does not reach beyond these, unless it names one
WALLS = frozenset("html body article section main aside nav header footer div table td th ul ol form".split())
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<[!?/][^>]*(?:>|\Z)""", re.S
)
UNCLOSED = re.compile(r"<(?=[a-zA-Z/!?])")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
HOST = r"://([^/?#]*)"


def _flags(tag: str, attributes: str) -> tuple[bool, bool]:
    """(is not article text, is a place of reader comments) by the element's name and attributes."""
    if tag in NO_TEXT:
        return True, False
    if not attributes or tag in ("html", "body"):
        return False, False
    words: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True, False
        if name == "role" and value.strip() in ROLES:
            return True, False
        if name in ("class", "id"):
            words.update(re.split(r"[^a-z0-9]+", value))
    found = words & (NO_ARTICLE if tag in ("article", "main") else WORDS)
    return bool(found), bool(found & COMMENTS)


@dataclass(slots=True)
class _Open:
    tag: str
    first: int
    dropped: bool = False
    comments: bool = False
    parts: list[str] = field(default_factory=list)
    length: int = 0
    prose: int = 0


@dataclass(slots=True)
class Page:
    """``runs`` of visible text (one that starts a block begins with a line break), whether markup leaves them to the ``article``,
    and the subtrees with text: ``hashes`` and their runs [``first``, ``last``); ``strict`` ones are prose or part of the article."""

    runs: list[str] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)
    hashes: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    strict: list[bool] = field(default_factory=list)


def parse(text: str) -> Page:
    runs: list[tuple[str, bool, bool, bool]] = []  # text, kept by markup, in an article, in main
    subtrees: list[tuple[int, int, int, int, bool]] = []  # hash, first run, last run, length, prose
    stack = [_Open("", 0)]
    broken, seen_article, total = False, False, 0
    depth = {"article": 0, "main": 0, "header": 0, "heading": 0, "dropped": 0}

    def counted(e: _Open, by: int) -> None:
        if e.tag in ("article", "main"):
            depth[e.tag] += by
        if e.tag == "header" and not e.dropped:
            depth["header"] += by
        if e.tag in HEADINGS:
            depth["heading"] += by
        depth["dropped"] += by * e.dropped

    def close() -> None:
        e = stack.pop()
        counted(e, -1)
        above = stack[-1]
        if not e.length:
            return
        digest = xxhash.xxh3_64_intdigest(f"{e.tag}\0" + "\1".join(e.parts))
        if e.tag in PROSE:
            e.prose = e.length
        if len(e.parts) == 1 and subtrees and subtrees[-1][1] == e.first and subtrees[-1][2] == len(runs):
            subtrees.pop()  # an element that only wraps another stands for it
        subtrees.append((digest, e.first, len(runs), e.length, 2 * e.prose >= e.length))
        above.parts.append(f"{digest:x}")
        above.length += e.length
        above.prose += e.prose

    def text_run(raw: str) -> None:
        nonlocal broken, total
        words = entities.unescape(raw) if "&" in raw else raw
        if not words or (words.isspace() and not runs):
            return
        kept = not depth["dropped"] and (not depth["header"] or depth["heading"] > 0)
        runs.append(("\n" + words if broken else words, kept, depth["article"] > 0, depth["main"] > 0))
        broken = False
        core = " ".join(words.split())
        if core:
            top = stack[-1]
            top.parts.append(core)
            top.length += len(core)
            total += len(core)

    at, size, last = 0, len(text), text.rfind(">")
    while at < size:
        found = TOKEN.search(text, at) if at <= last else None
        if found is None:
            text_run(UNCLOSED.split(text[at:], maxsplit=1)[0])  # a tag or comment that never ends is none
            break
        if found.start() > at:
            text_run(text[at : found.start()])
        at = found.end()
        end, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        broken = broken or tag in BLOCK
        if end:
            deepest = len(stack) - 1
            while deepest > 0 and stack[deepest].tag != tag and (tag in WALLS or stack[deepest].tag not in WALLS):
                deepest -= 1
            if deepest > 0 and stack[deepest].tag == tag:
                while len(stack) > deepest:
                    close()
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
            at = closing.end() if closing else size
            continue
        for opens, ends, walls in ENDS:
            if tag in opens:
                deepest = len(stack) - 1
                while deepest > 0 and stack[deepest].tag not in ends and stack[deepest].tag not in walls:
                    deepest -= 1
                if deepest > 0 and stack[deepest].tag in ends:
                    while len(stack) > deepest:
                        close()
        if tag in VOID:
            continue
        dropped, comments = _flags(tag, attributes)
        if tag == "header" and not depth["article"] and not depth["main"]:
            dropped = True
        if tag in ("article", "main") and not dropped and not seen_article:
            # an element around the page's article is no boilerplate, whatever its class says
            if all(not o.dropped or (not o.comments and o.tag not in NO_TEXT - {"form"} and o.tag != "header") for o in stack):
                for o in stack:
                    depth["dropped"] -= o.dropped
                    o.dropped = False
                seen_article = tag == "article"
        opened = _Open(tag, len(runs), dropped, comments)
        stack.append(opened)
        counted(opened, 1)
        if attributes.endswith("/") and tag not in BLOCK and tag in NO_TEXT:
            close()
    while len(stack) > 1:
        close()

    by_article = any(kept and article for _, kept, article, _ in runs)
    by_main = not by_article and any(kept and main for _, kept, _, main in runs)
    page, inside = Page(), []
    for words, kept, article, main in runs:
        here = article if by_article else main if by_main else True
        inside.append(here and (by_article or by_main))
        page.runs.append(words)
        page.article.append(kept and here)
    before = list(accumulate(inside, initial=0))
    for digest, first, last, length, prose in subtrees:
        if 2 * length <= total:
            page.hashes.append(digest)
            page.first.append(first)
            page.last.append(last)
            # prose that markup gives to the article, and all that holds text of the article element
            page.strict.append(before[last] > before[first] or (prose and page.article[first]))
    return page


def assembled(page: Page, cuts: list[tuple[int, int, bool]]) -> tuple[str, int, int]:
    """The text of the page without the templates ``(first run, last run, strict)`` and then without what markup tells; how many
    templates were cut, and how many runs of text were left to markup. The strict cuts are not made if they would
    take more than half of the article."""
    runs, article = page.runs, page.article
    gone = [False] * len(runs)
    taken = 0
    sizes = [len("".join(r.split())) for r in runs]

    def apply(some: list[tuple[int, int, bool]], marks: list[bool]) -> int:
        n, reached = 0, 0
        for first, last, _ in sorted(some, key=lambda c: (c[0], -c[1])):
            n += last > reached
            for i in range(max(first, reached), last):
                marks[i] = True
            reached = max(reached, last)
        return n

    taken += apply([c for c in cuts if not c[2]], gone)
    strict = [c for c in cuts if c[2]]
    if strict:
        marks = list(gone)
        n = apply(strict, marks)
        before = sum(s for s, g, a in zip(sizes, gone, article) if a and not g)
        if 2 * sum(s for s, g, a in zip(sizes, marks, article) if a and not g) >= before:
            gone, taken = marks, taken + n
    by_markup = sum(1 for s, g, a in zip(sizes, gone, article) if s and not g and not a)
    # what is left out never glues its neighbours together
    pieces = [r if a and not g else "\n" for r, g, a in zip(runs, gone, article)]
    return " ".join("".join(pieces).split()), taken, by_markup


_SUBTREES = "keys array<bigint>, first array<int>, last array<int>, strict array<boolean>, story bigint"
#: what a page's cuts depend on: its site and its html, by 96 bits of hashes
_PAGE = ["site", "long_hash", "short_hash"]


def _identified(pages: DataFrame, kept: Column, html: str, url: str) -> DataFrame:
    host = F.translate(F.regexp_extract(as_text(url), HOST, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = pages.select(kept.alias("kept"), F.when(host != "", F.xxhash64(host)).alias("site"), as_text(html).alias("html"))
    return named.select("kept", "site", F.xxhash64("html").alias("long_hash"), F.hash("html").alias("short_hash"), "html")


def page_subtrees(pages: DataFrame) -> DataFrame:
    """Stored, without texts: the subtrees of each page. A key stands for a subtree of a site, its
    lowest bit tells whether it is strict; ``story`` stands for the article."""
    source = pages.where(F.col("site").isNotNull()).select(*_PAGE, "html")
    schema = T.StructType([*source.drop("html").schema, *T.StructType.fromDDL(_SUBTREES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [parse(h) for h in part.column(3).to_pylist()]
                keys = [[_key(s, h, k) for h, k in zip(p.hashes, p.strict)] for s, p in zip(part.column(0).to_pylist(), found)]
                stories = [xxhash.xxh3_64_intdigest("".join(r for r, a in zip(p.runs, p.article) if a)) >> 1 for p in found]
                columns = [pa.array(keys, pa.list_(pa.int64()))]
                columns += [pa.array([getattr(p, n) for p in found], pa.list_(pa.int32())) for n in ("first", "last")]
                columns += [pa.array([p.strict for p in found], pa.list_(pa.bool_())), pa.array(stories, pa.int64())]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(3)], *columns], schema.fieldNames())

    return stored(source.mapInArrow(run, schema))


def _key(site: int, digest: int, strict: bool) -> int:
    key = (((site & 0xFFFFFFFFFFFFFFFF) * 0x9E3779B97F4A7C15 ^ digest) & 0xFFFFFFFFFFFFFFFE) | strict
    return key - (1 << 64) if key >> 63 else key


def _split_join(left: DataFrame, right: DataFrame, on: str, weight: str, total: int, how: str) -> DataFrame:
    """``left`` joined to ``right``, one row a key. The keys that hold more than 1 in ``HOT`` of all ``total`` rows, at most ``HOT``,
    are broadcast, so no task gets a hot key; the others are joined by size."""
    hot = F.col(weight) * HOT > total
    few = F.broadcast(right.where(hot))
    rest = left.join(F.broadcast(right.where(hot).select(on)), on, "left_anti")
    return left.join(few, on, how).unionByName(rest.join(broadcast_under(right.where(~hot)), on, how))


def site_templates(subtrees: DataFrame, min_pages: int = MIN_PAGES, article_pages: int = ARTICLE_PAGES, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """Stored (key, n): the subtrees that are templates of their site, and their pages."""
    each = subtrees.select("site", "story", F.explode(F.array_distinct("keys")).alias("key"))
    counts = each.groupBy("site", "key").agg(F.count(F.lit(1)).alias("n"), F.min("story").alias("one"), F.max("story").alias("other"))
    strict = F.col("key").bitwiseAND(F.lit(1)) == 1
    # what stands on copies of one article only is no template
    enough = F.when(strict, (F.col("n") >= article_pages) & (F.col("one") != F.col("other"))).otherwise(F.col("n") >= min_pages)
    often = stored(counts.where(enough).select("site", "key", "n"))
    sites = stored(subtrees.groupBy("site").agg(F.count(F.lit(1)).alias("pages")))
    total = sites.agg(F.sum("pages")).first()[0] or 0
    shared = _split_join(often.where(strict), sites, "site", "pages", total, "inner")
    return stored(often.where(~strict).select("key", "n").unionByName(shared.where(F.col("n") >= F.col("pages") * F.lit(article_share)).select("key", "n")))


def main_text(
    pages: DataFrame,
    html: str = "html",
    url: str = "url",
    keep: list[str] | None = None,
    min_pages: int = MIN_PAGES,
    article_pages: int = ARTICLE_PAGES,
    article_share: float = ARTICLE_SHARE,
) -> DataFrame:
    """Columns ``keep`` (all by default) with ``text``, ``n_chars`` (code points), ``n_template`` (template subtrees cut from the page) and
    ``n_markup`` (runs of text that recur too little to be cut, and went by markup)."""
    outputs = ["text", "n_chars", "n_template", "n_markup"]
    named = _identified(pages, packed(pages, outputs, keep), html, url)
    subtrees = page_subtrees(named)
    templates = site_templates(subtrees, min_pages, article_pages, article_share)
    one = F.explode(F.arrays_zip("keys", "first", "last", "strict")).alias("s")
    each = subtrees.select(*_PAGE, one).select(*_PAGE, F.col("s.keys").alias("key"), F.struct("s.first", "s.last", "s.strict").alias("cut"))
    total = templates.agg(F.sum("n")).first()[0] or 0
    found = _split_join(each, templates, "key", "n", total, "inner")
    cuts = stored(found.groupBy(*_PAGE).agg(F.collect_set("cut").alias("cuts")))
    # the pages are dealt anew only if the cuts are too many to go to them
    joined = named.join(broadcast_under(cuts, BROADCAST_CUTS), _PAGE, "left").select("kept", "html", "cuts")
    schema = T.StructType([joined.schema["kept"], *T.StructType.fromDDL("text string, n_chars bigint, n_template bigint, n_markup bigint")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = [
                    assembled(parse(text), [(c["first"], c["last"], c["strict"]) for c in cuts or ()])
                    for text, cuts in zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                ]
                texts = [t for t, _, _ in done]
                columns = [pa.array(texts, pa.string()), *[pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [n for _, n, _ in done], [m for _, _, m in done])]]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.fieldNames())

    result = joined.mapInArrow(run, schema)
    return result.select(*unpacked(result, "kept"), *outputs)
