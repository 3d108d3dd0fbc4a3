"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score one each, tags less than nothing: the more often a
tag stands outside the content of labelled pages than inside, the less. The contiguous run with the
greatest sum, found in one linear scan, is the content region. Elements that say themselves that they
are no content (menus, headers, footers, adverts, forms, comments, scripts and so on) score nothing and
give no text, so they neither pull the region to them nor tear it apart. An element is content all the same
if it is or holds the page's outermost article or main element, or most words of a page without.

Labelled pages are those that mark their content with one article or main element; tags are counted
over all of them.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.llm import common

# Fixed values of HTML: elements without an end tag, with raw content, and that stand as blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noscript noembed noframes xmp template svg math".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
# Elements, roles and words of classes or ids that are no content.
DROPPED = set("head nav footer aside form button select input label fieldset dialog menu object canvas audio video".split()) | RAW
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion sidebar widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription share sharing "
    "social related recommended recommendations comment comments commentlist disqus reply replies respond footer masthead toolbar pagination pager "
    "login signup register search disclaimer copyright skip".split()
)
HEADERS = {"header", "topbar"}
# Parts of a class that tell of another element, as in with-sidebar, and elements and roles that may stand around content.
ABOUT = set("with without has have no is show hide".split())
AROUND = {"form", "fieldset", "dialog"}
CONTENT = {"article", "main"}
# What a tag scores: no less than WORST, no more than BEST. Tags counted by name; others are together.
WORST, BEST = -1.0, -0.02
TAGS = sorted(VOID | RAW | BLOCK | DROPPED | set("a abbr b bdi cite code del em font i img ins kbd mark q s samp small span strike strong sub sup td th time tt u var".split()))

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>"']*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I) for name in RAW}


def _named(attributes: str) -> tuple[set[str], set[str], bool]:
    """The words of an element's class and id, these as a whole, and whether it is no content by its role or hidden."""
    words, whole, out = set(), set(), False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            out |= value.strip() in ROLES
        elif name.lower() == "hidden":
            out = True
        elif name.lower() == "aria-hidden":
            out |= value == "true"
        else:
            for part in value.split():
                split = _WORDS.split(part)
                whole.add(part)
                words.add(part)
                if ABOUT.isdisjoint(split):
                    words.update(split)
    return words, whole, out


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(kind, value, dropped, inside) of a page: kind is text or tag, inside tells of a content element."""
    doubtful: dict[int, list] = {}
    items = list(_walk(page, doubtful, set()))
    marked = doubtful.pop(-1, None) is not None
    if doubtful:
        total = sum(len(value.split()) for kind, value, dropped, _ in items if kind == "text" and not dropped)
        kept = {i for i, (holds, words) in doubtful.items() if holds or (not marked and 2 * words > total)}
        return _walk(page, None, kept)
    return iter(items)


def _walk(page: str, doubtful: dict[int, list] | None, kept: set[int]) -> Iterator[tuple[str, str, bool, bool]]:
    """The tokens of a page, where elements of ``kept``, by their places, are not dropped.

    With ``doubtful``, elements outside of content that only their names tell to be none are not dropped, but noted
    there: whether they hold a content element, and how many words. Place -1 is noted if the page has such an element.
    """
    stack: list[tuple[str, bool]] = []
    dropped = content = at = words_seen = 0
    # Places of noted elements that are open, with the depth of the stack and the words before them.
    noted: list[tuple[int, int, int]] = []

    def close(name: str) -> None:
        nonlocal dropped, content
        while stack:
            top, out = stack.pop()
            dropped -= out
            content -= top in CONTENT
            while noted and noted[-1][1] > len(stack):
                place, _, before = noted.pop()
                doubtful[place][1] = words_seen - before
            if top == name:
                return

    while at < len(page):
        found = _TOKEN.search(page, at)
        start = found.start() if found else len(page)
        if start > at:
            text = unescape(page[at:start])
            if doubtful is not None and not dropped:
                words_seen += len(text.split())
            yield "text", text, dropped > 0, content > 0
        if not found:
            for place, _, before in noted:
                doubtful[place][1] = words_seen - before
            return
        at = found.end()
        end, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if end:
            # The end of a dropped element is part of it.
            yield "tag", name, dropped > 0, content > 0
            if any(top == name for top, _ in stack):
                close(name)
            continue
        if name in BLOCK and stack and stack[-1][0] == "p":
            close("p")
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            close(name)
        if name == "body":
            # Whatever the head left open ends here.
            while stack:
                close(stack[-1][0])
        words, whole, out = _named(attributes) if attributes.strip() else (set(), set(), False)
        if name not in ("html", "body", "main"):
            out |= name in DROPPED - AROUND
            soft = not words.isdisjoint(NAMES) or name in AROUND
            soft |= content == 0 and (name in HEADERS or not words.isdisjoint(HEADERS))
        else:
            out = soft = False
        if name in CONTENT and content == 0 and not out and (not soft or whole.isdisjoint(NAMES)):
            # The element is content, and so are those around it.
            soft = False
            if doubtful is not None and not dropped:
                doubtful[-1] = [True, 0]
                for place, _, _ in noted:
                    doubtful[place][0] = True
        if soft and not out and content == 0 and doubtful is not None:
            if name not in VOID:
                doubtful[found.start()] = [False, 0]
                noted.append((found.start(), len(stack) + 1, words_seen))
        elif found.start() not in kept:
            out |= soft
        yield "tag", name, dropped > 0 or out, content > 0
        if name in RAW and not attributes.rstrip().endswith("/"):
            last = _END[name].search(page, at)
            at = last.end() if last else len(page)
        elif name not in VOID:
            stack.append((name, out))
            dropped += out
            content += name in CONTENT
    for place, _, before in noted:
        doubtful[place][1] = words_seen - before


def region(items: list[tuple[str, str, bool, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """Begin and end of the best run of items; of equal runs the first, and of these the longest."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, value, dropped, _) in enumerate(items):
        if total <= 0:
            total, start = 0.0, i
        if not dropped:
            total += len(value.split()) if kind == "text" else weights.get(value, weights[""])
        if total > best or (total == best > 0 and start == span[0]):
            best, span = total, (start, i + 1)
    return span


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of a page's content region, one on a line."""
    items = list(tokens(page or ""))
    begin, end = region(items, weights)
    blocks, held = [], []
    for kind, value, dropped, _ in items[begin:end]:
        if kind == "tag":
            if value in BLOCK:
                blocks.append("".join(held))
                held = []
            elif value in ("br", "td", "th"):
                held.append(" ")
        elif not dropped:
            held.append(value)
    blocks.append("".join(held))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def weights_of(inside: Counter, outside: Counter) -> dict[str, float]:
    """Scores of tags from how often each stands inside and outside the content of labelled pages."""
    share = (sum(inside.values()) + 1) / (sum(outside.values()) + 1)
    found = {t: -log((outside[t] + 1) / (inside[t] + 1) * share + 1) for t in [*TAGS, ""]}
    return {t: min(max(w, WORST), BEST) for t, w in found.items()}


def learn(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Tag scores from all pages with one content element; from none, every tag scores alike."""
    known = set(TAGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                items = list(tokens(page or ""))
                if sum(kind == "tag" and value in CONTENT for kind, value, _, _ in items) == 2:
                    for kind, value, _, within in items:
                        if kind == "tag":
                            (inside if within else outside)[value if value in known else ""] += 1
        tags = sorted({*inside, *outside})
        cols = [pa.array(tags, pa.string()), pa.array([inside[t] for t in tags], pa.int64()), pa.array([outside[t] for t in tags], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, ["tag", "inside", "outside"])

    common.small_batches(pages.sparkSession)
    counted = pages.select(F.col(html).cast("string")).mapInArrow(run, "tag string, inside long, outside long")
    # One row per known tag.
    rows = counted.groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return weights_of(Counter({r.tag: r.inside for r in rows}), Counter({r.tag: r.outside for r in rows}))


def text_of(weights: dict[str, float], html: str = "html") -> Column:
    """A column with the main text of a row's page."""

    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([main_text(p, weights) for p in part.to_pylist()], pa.string())

    return run(F.col(html).cast("string"))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``, by scores learnt from them.

    A null or empty html has an empty text. Rows with one id are each returned; other columns are ignored.
    """
    rows = pages.select("page_id", "url", text_of(learn(pages)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
