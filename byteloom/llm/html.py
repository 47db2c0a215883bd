"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  A word's score depends on the elements
around it: their names, the parts of their class, id and role, and whether the
word is link text.  Tags score negative.  Labelled pages give all weights; what
they do not show starts from a prior.  One linear scan finds the best contiguous
region; it grows to the element around it if it holds most of that one's text,
and blocks inside it that score negative are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common

#: Labelled pages that the weights are counted on, picked by a hash of the id.
SAMPLE_PAGES = 3_000
#: Tags, elements and parts of classes with a weight of their own, the most frequent ones.
LEARNED = 5_000
#: Bounds of the weights: tags never gain, element names only lean, parts of classes decide.
TAG_RANGE, NAME_RANGE, PART_RANGE = (-4.0, -0.02), (-0.5, 0.5), (-3.0, 3.0)
#: A prior counts as much as so many words of labelled pages.
PRIOR_WORDS = 50
#: Words below such an element are no part of a block around it.
APART = -1.5
#: The region grows to the element around it if it holds at least this share of its good words.
MOST, MOST_OF_MAIN = 0.8, 0.5

# Elements whose content is no text at all.
RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|textarea|title|head"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output "
    "progress q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
# Priors of elements and of parts of class, id and role.
BESIDE = "nav header footer aside form menu dialog button select option fieldset address".split()
STRONG = (
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay paywall newsletter "
    "subscribe subscription signup login sidebar sidenav widget widgets "
    "sharing social breadcrumb breadcrumbs menu nav navbar navigation navigationlinks topbar toolbar "
    "footer masthead comment comments commentlist disqus reply replies respond "
    "pagination pager complementary contentinfo"
).split()
WEAK = "related recommended recommendations share discussion feedback search".split()
PRIORS = (
    {f"<{n}>": -2.0 for n in BESIDE} | {n: -2.0 for n in STRONG} | {n: -0.8 for n in WEAK} | {"<article>": 1.0, "<main>": 0.5}
)
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)

# Outside quotes a tag holds no "<", so a tag that never ends is given up at the next one.
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?a-zA-Z][^<>]+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
PARTS = re.compile(r"[a-z0-9]+")


@dataclass(slots=True)
class Element:
    """An open element; `parts` are those of its class, id and role, and `<name>` where the name has a prior."""

    name: str
    parent: int
    start: int
    names: frozenset[str]
    parts: tuple[str, ...] = ()
    hidden: bool = False
    in_main: bool = False
    end: int = -1


@dataclass(slots=True)
class Item:
    """A tag (`kind` its name) or a piece of text (`kind` "word" or "link") in an element."""

    kind: str
    element: int
    words: int = 0
    text: str = ""
    breaks: bool = False


@dataclass
class Page:
    """Items in page order, and the elements in the order in which they open; the first stands for the page."""

    items: list[Item] = field(default_factory=list)
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, 0, frozenset())])


def signs(name: str, attributes: str, in_main: bool) -> tuple[tuple[str, ...], bool]:
    """Parts that say what an element is, and whether it is hidden."""
    parts = [f"<{name}>"] if f"<{name}>" in PRIORS and not (name == "header" and in_main) else []
    hidden = False
    for key, a, b, c, bare in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), (a or b or c).lower()
        if bare or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif key in ("class", "id", "role"):
            parts += PARTS.findall(value)
            if "header" in parts and not in_main and key != "role":
                parts.append("<header>")
    return tuple(parts), hidden


def parse(html: str) -> Page:
    page = Page()
    items, elements = page.items, page.elements
    stack = [0]
    opened: Counter = Counter()
    # Elements below the same names share one set of them.
    sets: dict[tuple[frozenset[str], str], frozenset[str]] = {}

    def close(name: str) -> None:
        while len(stack) > 1:
            top = elements[stack.pop()]
            opened[top.name] -= 1
            top.end = len(items)
            if top.name == name:
                return

    def text(piece: str) -> None:
        if piece:
            plain = unescape(piece) if "&" in piece else piece
            items.append(Item("link" if opened["a"] > 0 else "word", stack[-1], len(plain.split()), plain))

    at = 0
    for found in TOKEN.finditer(html):
        text(html[at : found.start()])
        at = found.end()
        raw, slash, name, attributes = found.groups()
        if not name:
            if raw:
                items.append(Item(raw.lower(), stack[-1], breaks=True))
            continue
        name = name.lower()
        if slash:
            known = opened[name] > 0
            items.append(Item(name, stack[-1], breaks=name not in INLINE and (known or name != "br")))
            if known:
                close(name)
            continue
        if name in CLOSES_P and opened["p"] > 0:
            close("p")
        if name == "li" and elements[stack[-1]].name == "li":
            close("li")
        if name == "br":
            items.append(Item("br", stack[-1], text=" "))
            continue
        if name in VOID or attributes.rstrip().endswith("/"):
            items.append(Item(name, stack[-1], breaks=name not in INLINE))
            continue
        above = elements[stack[-1]]
        parts, hidden = signs(name, attributes, above.in_main)
        if (above.names, name) not in sets:
            sets[above.names, name] = above.names | {name} if name not in ("html", "body", *MAIN) else above.names
        elements.append(
            Element(
                name, stack[-1], len(items), sets[above.names, name], parts, above.hidden or hidden, above.in_main or name in MAIN
            )
        )
        stack.append(len(elements) - 1)
        items.append(Item(name, stack[-1], breaks=name not in INLINE))
        opened[name] += 1
    text(html[at:])
    for e in elements:
        e.end = len(items) if e.end == -1 else e.end
    return page


@dataclass(frozen=True)
class Weights:
    """Scores a word (`words` by kind, `names` and `parts` of the elements around it) and a tag."""

    words: dict[str, float]
    tags: dict[str, float]
    names: dict[str, float] = field(default_factory=dict)
    parts: dict[str, float] = field(default_factory=lambda: PRIORS)
    other_tag: float = -1.0

    def around(self, page: Page, wrappers: set[int]) -> tuple[list[float], list[float]]:
        """For each element the lowest and the whole score that it and those around it give a word.

        The parts of `wrappers` say nothing.
        """
        low, lean, names = [0.0], [0.0], {}
        high = [0.0]
        for i, e in enumerate(page.elements[1:], 1):
            own = [] if i in wrappers else [self.parts.get(p, 0.0) for p in e.parts]
            low.append(min([low[e.parent], *own]))
            high.append(max([high[e.parent], *own]))
            if e.names not in names:
                names[e.names] = sum(self.names.get(n, 0.0) for n in e.names) / max(1, len(e.names))
            lean.append(names[e.names] + low[i] + high[i] / 2)
        return low, lean

    def scores(self, page: Page, lean: list[float]) -> list[float]:
        out = []
        for item in page.items:
            if not item.text:
                out.append(self.tags.get(item.kind, self.other_tag))
            elif page.elements[item.element].hidden or not item.words:
                out.append(0.0)
            else:
                out.append(item.words * max(-3.0, min(3.0, self.words.get(item.kind, 0.0) + lean[item.element])))
        return out


#: For tables without a single labelled page.
PLAIN = Weights({"word": 1.0, "link": 0.1}, {"p": -0.02, "b": -0.1, "i": -0.1, "em": -0.1, "br": -0.1})


def best_region(scores: list[float]) -> tuple[int, int]:
    """The first contiguous run of the highest sum, as [start, end); empty if none is positive."""
    best, span, run, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, span = run, (start, i + 1)
    return span


def region_of(page: Page, scores: list[float]) -> tuple[int, int]:
    """The best region, grown to the element around it if it holds most of the good words there."""
    start, end = best_region(scores)
    good = [k for k in range(start, end) if scores[k] > 0]
    if not good:
        return 0, 0
    above = set()
    at = page.items[good[0]].element
    while at >= 0:
        above.add(at)
        at = page.elements[at].parent
    at = page.items[good[-1]].element
    while at not in above:
        at = page.elements[at].parent
    held = sum(page.items[k].words for k in good)
    while at > 0 and page.elements[at].name not in ("html", "body"):
        e = page.elements[at]
        words = sum(page.items[k].words for k in range(e.start, e.end) if scores[k] > 0)
        if held >= (MOST_OF_MAIN if e.name in MAIN else MOST) * words:
            return min(start, e.start), max(end, e.end)
        # A paragraph of an article is not the article.
        at = e.parent if not e.in_main or e.name in MAIN else next_main(page, at)
    return start, end


def next_main(page: Page, at: int) -> int:
    """The nearest article or main element around an element, 0 if there is none."""
    while at > 0 and page.elements[at].name not in MAIN:
        at = page.elements[at].parent
    return at


def wrappers_of(page: Page, by_title: bool) -> set[int]:
    """Elements that hold half of the page's words or more; if `by_title`, its title too, which is enough for articles."""
    words = [0] * len(page.elements)
    titles = [0] * len(page.elements)
    for item in page.items:
        words[item.element] += item.words
        titles[item.element] += item.kind == "h1"
    for i in range(len(page.elements) - 1, 0, -1):
        words[page.elements[i].parent] += words[i]
        titles[page.elements[i].parent] += titles[i]
    return {
        i
        for i, e in enumerate(page.elements)
        if e.parts and (titles[i] or not by_title)
        and (2 * words[i] >= words[0] or e.name in MAIN and by_title)
        and (e.name not in BESIDE or e.name == "form")
    }


def main_text(html: str, weights: Weights) -> str:
    """The text of the best region; in time that grows with the page's length.

    What an element is called says nothing if it holds the title and half of the
    page's words, or is an article with the title; where nothing else is left,
    half of the words are enough.
    """
    page = parse(html)
    for by_title in (True, False):
        low, lean = weights.around(page, wrappers_of(page, by_title))
        scores = weights.scores(page, lean)
        start, end = region_of(page, scores)
        if end:
            break
    blocks: list[str] = []
    current: list[str] = []
    total = 0.0

    def finish() -> None:
        if total > 0:
            blocks.append(" ".join("".join(current).split()))
        current.clear()

    for item, score in zip(page.items[start:end], scores[start:end]):
        if item.breaks:
            finish()
            total = 0.0
        elif item.text and not page.elements[item.element].hidden and low[item.element] > APART:
            current.append(item.text)
            total += score if item.words else 0.0
    finish()
    return "\n\n".join(b for b in blocks if b)


def counts(html: str) -> Counter | None:
    """Words and tags, and words below names and parts, in and outside the articles of a page that marks one."""
    page = parse(html)
    marked = {e.name for e in page.elements} & MAIN
    if not marked:
        return None
    label = "article" if "article" in marked else "main"
    inside, around = [False], [frozenset()]
    low, _ = PLAIN.around(page, wrappers_of(page, True))
    for i, e in enumerate(page.elements[1:], 1):
        inside.append(inside[e.parent] or e.name == label)
        around.append(around[e.parent].union(p for p in e.parts if p not in ("<article>", "<main>")) if e.parts else around[e.parent])
    out: Counter = Counter()
    for item in page.items:
        e = page.elements[item.element]
        own = inside[item.element] and low[item.element] > APART and not e.hidden
        if not item.text:
            out["tag", item.kind, own] += 1
        elif item.words:
            out["word", item.kind, own] += item.words
            for name in e.names:
                out["name", name, own] += item.words
            for part in around[item.element]:
                out["part", part, own] += item.words
    return out


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights: log ratios of how often words and tags are in and outside marked articles.

    Counted on at most `sample_pages` pages, picked by a hash of the id.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column(0).to_pylist():
                total.update(counts(html) or {})
        yield pa.RecordBatch.from_pylist(
            [{"type": t, "kind": k, "inside": i, "n": n} for (t, k, i), n in total.items()],
            pa.schema([("type", pa.string()), ("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]),
        )

    picked = pages.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    # At most sample_pages ids.
    sample = pages.join(F.broadcast(picked.distinct()), "page_id").select(common.text_of("html").alias("html"))
    rows = (
        sample.mapInArrow(count, "type string, kind string, inside boolean, n bigint")
        .groupBy("type", "kind")
        .agg(F.sum(F.expr("if(inside, n, 0)")).alias("a"), F.sum(F.expr("if(inside, 0, n)")).alias("b"))
        .orderBy((F.col("a") + F.col("b")).desc(), "type", "kind")
        .limit(LEARNED)
        .collect()
    )
    sums = {t: (sum(r.a for r in rows if r.type == t), sum(r.b for r in rows if r.type == t)) for t in ("tag", "word")}
    if not all(sums["word"]) or not all(sums["tag"]):
        return PLAIN

    def ratio(r, span: tuple[float, float]) -> float:
        a, b = sums["tag" if r.type == "tag" else "word"]
        return float(np.clip(np.log((r.a + 1) / (a + 1)) - np.log((r.b + 1) / (b + 1)), *span))

    def with_prior(r) -> float:
        n = r.a + r.b
        return (n * ratio(r, PART_RANGE) + PRIOR_WORDS * PRIORS.get(r.kind, 0.0)) / (n + PRIOR_WORDS)

    return Weights(
        PLAIN.words,
        {r.kind: ratio(r, TAG_RANGE) for r in rows if r.type == "tag"},
        {r.kind: ratio(r, NAME_RANGE) for r in rows if r.type == "name"},
        PRIORS | {r.kind: with_prior(r) for r in rows if r.type == "part"},
    )


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    NULL html is the empty page, which has the empty text, as has a page
    without words.  Unclosed elements end with their parent, unclosed comments
    and scripts with the page.  Repeated rows are extracted alike.
    """
    fitted = weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, fitted) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string"), common.text_of("html").alias("html")).mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint"
    )


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages, by weights counted on their own marked articles."""
    pages = common.table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
