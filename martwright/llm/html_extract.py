r"""HTML extraction by maximum-scoring subsequence.

A page is read once, left to right, as a sequence of tags and block texts.
Elements that never hold article text (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments and hidden elements, told by
tag, class, id or role) are set aside with all they contain, unless they hold
more text than all that remains: such a wrapper ("page sidebar-right", a form
around the page) is opened, but for the parts in it.  In what is left
every word scores positive and every tag negative; a linear scan finds the
contiguous region of the largest sum, and its blocks are the main text.

The weights are log-odds counted on labelled pages: at most ``LABELLED_PAGES``
pages (a documented bound; smallest hash of page_id first) that mark their
article themselves by <article> or <main>.  A word's weight depends on the tag
of its block and on whether it is a link; a tag's on its name.  Such an element
is the region unless the best region outside outweighs it by these weights (or
has several times its words): cards of other stories are <article>s, too.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline; <br> is white space.

Defined results: null, empty and text-free html gives ''; markup cut off in the
middle counts as far as it goes, an unfinished tag is dropped; repeated rows
give repeated results; a null page_id or url stays; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks

LABELLED_PAGES = 1000

#: Names of the HTML language, and words that name page parts.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style annotation annotation-xml".split())
SKIPPED = frozenset(
    "head title nav header footer aside form menu dialog noscript template iframe object applet audio video canvas svg "
    "button select option optgroup textarea label datalist map".split())
#: Of these, kept in an article.
ARTICLE_TAGS = frozenset("header label noscript".split())
#: A part that may prove a wrapper of the article: told by one of the other
#: words or by these tags it needs more text than the rest of the page.
WRAPPERS = frozenset("header form aside".split())
SPACING = frozenset("br td th img hr wbr".split()) - {"wbr"}
PARTS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside header masthead topbar footer foot "
    "bottombar banner notice notices notification alert cookie cookies consent gdpr popup modal overlay ad ads adv "
    "advert adverts advertisement advertising sponsor sponsored promo promotion newsletter subscribe subscription "
    "signup login search form social share sharing related recommended recommendations comment comments commentlist "
    "disqus discussion reply replies respond reviews pagination pager toolbar widget widgets skip copyright "
    "complementary contentinfo hidden".split())
NEGATED = frozenset("no not has with without".split())
#: These words and the other tags need so many times the rest.
FIRM = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot bottombar cookie cookies consent gdpr notice "
    "notices copyright contentinfo ad ads adv advert adverts advertisement advertising sponsor sponsored".split())
FIRM_TIMES = 10
NEVER = 0  # grade of parts that are never a wrapper: comments, hidden elements, replaced content
COMMENTS = frozenset("comment comments commentlist disqus discussion reply replies respond reviews".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def page_part(name: str, attributes: str, inside: int = 0) -> int | None:
    """Grade of an element that is a page part other than the article: NEVER,
    or how many times the rest of the page's text it must hold to be taken for
    a wrapper of the article; None: no page part.  ``inside``: in an article."""
    if name in SKIPPED and not (inside and name in ARTICLE_TAGS):
        return 1 if name in WRAPPERS else FIRM_TIMES if name in ("nav", "footer", "menu") else NEVER
    if not attributes or "=" not in attributes and "hidden" not in attributes or name in ("html", "body", "main"):
        return None
    grade = None
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return NEVER
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return NEVER
        elif key in ("class", "id", "role"):
            for one in value.split():
                parts = set(_SPLIT.split(_CAMEL.sub("-", one).lower()))
                if not parts & NEGATED and (found := parts & (COMMENTS if name == "article" else PARTS)):
                    if found & COMMENTS:
                        return NEVER
                    if not (inside and found == {"header"}):
                        grade = max(grade or 1, FIRM_TIMES if found & FIRM else 1)
    return grade


@dataclass
class Block:
    """A block's text pieces, its tag, and where it lies: skipped elements
    around it, and the outermost <article> or <main> around it (its number from
    1 on; 0: none)."""

    tag: str
    skipped: bool
    inside: int
    pieces: list[str] = field(default_factory=list)
    links: int = 0

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


@dataclass
class Part:
    """A page part: the part around it (-1: none), its grade, the words outside
    of links in it, and those of them in an article; first without and then with
    those of the parts in it."""

    above: int
    grade: int
    words: int = 0
    marked: int = 0
    all_words: int = 0
    all_marked: int = 0


def skipped_parts(items: list[tuple[Block | str, int]], parts: list[Part]) -> list[bool]:
    """Which parts stay skipped: a part with more text (of articles, if any is
    seen) than all the rest that is seen is a wrapper, and what it holds is
    seen, but for the parts in it."""
    seen = Part(-1, NEVER)
    for x, k in items:
        if not isinstance(x, str):
            n = len("".join(x.pieces).split()) - x.links
            to = parts[k] if k >= 0 else seen
            to.words += n
            to.marked += n if x.inside else 0
    inner: dict[int, list[int]] = {}
    for k in range(len(parts) - 1, -1, -1):
        one = parts[k]
        one.all_words += one.words
        one.all_marked += one.marked
        # what is never a wrapper's text does not make one
        if one.above >= 0 and one.grade != NEVER:
            parts[one.above].all_words += one.all_words
            parts[one.above].all_marked += one.all_marked
        inner.setdefault(one.above, []).append(k)
    skipped = [True] * len(parts)
    front = inner.get(-1, [])
    by_marks = None
    heap: list[tuple[int, int]] = []
    while True:
        if by_marks != (seen.marked > 0):
            by_marks = seen.marked > 0
            front, heap = front + [k for _, k in heap], []
        for k in front:
            heapq.heappush(heap, (-(parts[k].all_marked if by_marks else parts[k].all_words), k))
        front, left = [], []
        while heap:
            n, k = heapq.heappop(heap)
            if parts[k].grade != NEVER and -n > parts[k].grade * (seen.marked if by_marks else seen.words):
                break
            # the rest only grows: later only the measure may change
            left.append(k)
        else:
            return skipped
        skipped[k] = False
        seen.words += parts[k].words
        seen.marked += parts[k].marked
        front = inner.get(k, [])
        if not by_marks and seen.marked:
            front = front + left


def read_page(page: str, classes: bool = True) -> list[Block | str]:
    """The page as tags (names, closing ones with '/') and blocks in order;
    tags inside skipped elements are left out."""
    out: list[tuple[Block | str, int]] = []  # with the innermost page part
    parts: list[Part] = []
    stack: list[tuple[str, int, int]] = []  # name, page part and article from here on
    names = Counter()
    marks = 0
    block: Block | None = None
    link = 0
    at, end = 0, len(page)

    def put(raw: str):
        nonlocal block
        if block is None:
            if not raw.strip():
                return
            tag = next((n for n, _, _ in reversed(stack) if n in BLOCKS), "")
            block = Block(tag, False, stack[-1][2] if stack else 0)
            out.append((block, stack[-1][1] if stack else -1))
        text = html.unescape(raw) if "&" in raw else raw
        block.pieces.append(text)
        if link:
            block.links += len(text.split())

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        if m.start() > at:
            put(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        if page[m.end() - 1] != ">":
            break
        name, closing = name.lower(), bool(m[1] or m[4])
        if name in SPACING and not closing:
            put(" ")
        if name in BLOCKS:
            block = None
        if closing:
            if not names[name]:
                continue
            while True:
                top = stack.pop()
                names[top[0]] -= 1
                link -= top[0] == "a"
                if top[0] in BLOCKS or top[1] >= 0:
                    block = None
                if top[0] == name:
                    break
        elif name not in VOID:
            attributes = m[3] if m[2] else m[6]
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = close.end() if close else end
                continue
            if name == "p" and names["p"] and stack[-1][0] != "p":
                # an open paragraph ends here, with what was left open in it
                k = max(i for i, x in enumerate(stack) if x[0] == "p")
                if all(x[0] not in BLOCKS and x[1] == stack[k][1] for x in stack[k + 1:]):
                    for x in stack[k:]:
                        names[x[0]] -= 1
                        link -= x[0] == "a"
                    del stack[k:]
            elif name in ("p", "li") and stack and stack[-1][0] == name:
                names[stack.pop()[0]] -= 1
            _, inner, inside = stack[-1] if stack else ("", -1, 0)
            grade = page_part(name, attributes if classes else "", inside)
            if name in ("article", "main") and not inside and grade is None:
                marks += 1
                inside = marks
            if grade is not None:
                parts.append(Part(inner, grade))
                inner = len(parts) - 1
                block = None
            stack.append((name, inner, inside))
            names[name] += 1
            link += name == "a"
        if name != "math" and not names["math"]:
            out.append(("/" + name if closing else name, stack[-1][1] if stack else -1))
    skipped = skipped_parts(out, parts)
    # parts stand after the part around them
    for k, one in enumerate(parts):
        skipped[k] = skipped[k] or one.above >= 0 and skipped[one.above]
    items = []
    for x, k in out:
        if isinstance(x, Block):
            x.skipped = k >= 0 and skipped[k]
        elif k >= 0 and skipped[k]:
            continue
        items.append(x)
    return items


@dataclass
class Weights:
    """Scores of a word by context and of a tag by name."""

    words: dict[tuple, float]
    tags: dict[str, float]

    def word(self, tag: str, link: bool) -> float:
        return self.words.get((tag, link), self.words.get(("", link), WORD_RANGE[0] if link else 1.0))

    def block(self, x: Block) -> float:
        n = len("".join(x.pieces).split())
        return (n - x.links) * self.word(x.tag, False) + x.links * self.word(x.tag, True)

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.1 if name.lstrip("/") in INLINE else -0.5)


WORD_RANGE = (0.05, 4.0)
TAG_RANGE = (-1.0, -0.02)
#: So many times the marked words outside of the marks are the story whatever their tags.
OUTSIDE_WORDS = 3


def contexts(page: list[Block | str]) -> Iterator[tuple[tuple, bool, int]]:
    """((kind, name, link), in the article, how many) of a labelled page."""
    inside = False
    for x in page:
        if isinstance(x, str):
            inside = inside and x not in ("/article", "/main") or x in ("article", "main")
            yield ("tag", x, False), inside, 1
        else:
            n = len("".join(x.pieces).split())
            good = bool(x.inside) and not x.skipped
            if x.links:
                yield ("word", x.tag, True), good, x.links
            if n > x.links:
                yield ("word", x.tag, False), good, n - x.links


def fit_weights(counts: dict[tuple, tuple[int, int]]) -> Weights:
    """Weights from (kind, name, link) -> (times inside, times outside)."""
    odds = {k: math.log((a + 1) / (b + 1)) for k, (a, b) in counts.items()}
    low, high = WORD_RANGE
    words = {(name, link): min(max(v, low), high) for (kind, name, link), v in odds.items() if kind == "word"}
    tags = {name: min(max(v - 1.0, TAG_RANGE[0]), TAG_RANGE[1]) for (kind, name, _), v in odds.items() if kind == "tag"}
    return Weights(words, tags)


def best_region(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the contiguous part with the largest sum (the first
    such one); empty if no score is positive."""
    best, where, total, begin = 0.0, (0, 0), 0.0, 0
    for k, x in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, k
        total += x
        if total > best:
            best, where = total, (begin, k + 1)
    return where


def region(items: list[Block | str], weights: Weights) -> list[Block]:
    """The blocks of the main text.  Marked elements (<article>, <main>) are
    the region if they outweigh the best region outside of them; otherwise
    they are teasers (several) or a part of it (a single one)."""
    blocks = [x for x in items if not isinstance(x, str)]
    marked = sum(weights.block(x) for x in blocks if x.inside)
    several = len({x.inside for x in blocks if x.inside}) > 1

    def best(block) -> list[Block]:
        a, b = best_region([weights.tag(x) if isinstance(x, str) else block(x) for x in items])
        return [x for x in items[a:b] if not isinstance(x, str)]

    outside = best(lambda x: 0.0 if x.inside and several else weights.block(x))
    if not marked:
        return outside
    alone = [x for x in outside if not x.inside]
    words_in, words_out = (sum(len("".join(x.pieces).split()) - x.links for x in part) for part in (
        (x for x in blocks if x.inside), alone))
    if sum(map(weights.block, alone)) > marked or words_out > OUTSIDE_WORDS * words_in:
        return [x for x in outside if not (x.inside and several)]
    high = WORD_RANGE[1]
    return best(lambda x: high * len("".join(x.pieces).split()) if x.inside else 0.0)


def extract(page: str | None, weights: Weights) -> str:
    """The main text of a page."""
    if not page:
        return ""
    for classes in (True, False):
        items = [x for x in read_page(page, classes) if isinstance(x, str) or not x.skipped]
        text = "\n".join(t for t in (x.text() for x in region(items, weights)) if t)
        if text:
            return text
    return ""


def labelled_weights(pages: DataFrame, limit: int = LABELLED_PAGES) -> Weights:
    """Weights counted on the pages that mark their article."""
    # at most ``limit`` page_ids
    some = (pages.where(F.col("page_id").isNotNull() & F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
            .select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(limit).distinct())
    rows = pages.select("page_id", "html").join(F.broadcast(some), "page_id").select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list[int]] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                for key, inside, n in contexts(read_page(page or "")):
                    if key[1].lstrip("/") in BLOCKS | VOID | SKIPPED | INLINE or not key[1]:
                        total.setdefault(key, [0, 0])[not inside] += n
        keys, values = list(total), list(total.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.bool_()), pa.array([v[0] for v in values], pa.int64()),
             pa.array([v[1] for v in values], pa.int64())], ["kind", "name", "link", "inside", "outside"])

    counted = rows.mapInArrow(count, "kind string, name string, link boolean, inside long, outside long")
    counted = counted.groupBy("kind", "name", "link").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    # one row per tag of the HTML language
    return fit_weights({(r.kind, r.name, r.link): (r.i, r.o) for r in counted.select(
        "kind", F.col("name").alias("name"), "link", "i", "o").collect()})


def extract_pages(pages: DataFrame, limit: int = LABELLED_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weights = pages.sparkSession.sparkContext.broadcast(labelled_weights(pages, limit))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2):
                texts = [extract(x, weights.value) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        compute, "page_id long, url string, text string, n_chars long")


def op1_html_extract(spark, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
