"""Main text of web pages as the best-scoring contiguous region.

A page is a sequence of words and tags.  A word scores by what is known of the
elements around it (their names, classes, ids and roles), a tag scores
negatively; both weights are fitted on labelled pages.  One linear scan finds
the contiguous run of blocks with the greatest sum.  The run grows to the
article or main element that it lies in, and blocks inside it whose words score
negatively by where they stand (adverts, forms, reader comments) are left out;
links tell where content ends, but are not left out of it.

Elements that only give a page its shape (``html``, ``body``, ``div``,
``section`` and the like) have no weight.  Names say what stands in a box, not
what a whole page looks like: nothing counts of ``html``, ``body`` and ``main``
but the element itself, and nothing at all of a frame, which is an element that
holds the main heading and at least half of the page's words, or a form that
does either; an ``article`` counts for single words only; names such as
``no-sidebar`` or ``header-fixed`` tell of a state, and ``header-block`` or
``promo-text`` of a place.  Words in a box that is clearly something else
(navigation, asides, footers, forms, notices, adverts, reader comments) never
score positively, whatever else is around them.  Where less than a seventh of a
page is left, the names of the elements that hold half of its words and at least
three paragraphs (not those of comments) do not count either, if that gives
more; where nothing is left, all words outside those boxes are the text.

Reading takes linear time whatever the markup.  Defined results: a null or
empty page, and one without text, gives an empty text; broken markup is read as
far as it goes (an element that is never closed ends with its parent, an
unclosed comment or script runs to the end; once a quote inside a tag is never
closed, tags end at the next ">" whatever the quotes); text is never cut;
repeated rows stay; further columns of the input are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackforge.llm.common import in_batches

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
_QUOTED = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|data-label)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_RAW = {x: re.compile(rf"</{x}\b", re.I) for x in ("script", "style", "noscript", "template", "svg", "textarea", "title", "iframe", "select", "object", "math", "canvas", "audio", "video")}
_TO_END = frozenset(("script", "style", "textarea", "title", "iframe"))
_HEAD_END = re.compile(r"</head\b|(?=<body\b)", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SECTION = frozenset(("article", "main"))
_LISTS = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr"))}
# Elements that only give a page its shape; boxes that are clearly something else, by element and by name; what their names are run together with;
# words that do so only by themselves, and words after them that make the name one of a place.
_SHAPE = frozenset("html body div section center font span tbody thead tfoot".split())
_ELSE = "nav aside footer form dialog button".split()
_ELSE_NAMED = """ad advert advertisement advertising sponsor sponsored cookie consent gdpr popup modal newsletter subscribe subscription share social related recommended comment reply replie
discussion response disqu sidebar widget menu nav navigation navbar breadcrumb pagination pager login signup search toolbar footer complementary contentinfo hidden""".split()
_CLEARLY_ELSE = frozenset([*_ELSE, *(f".{x}" for x in _ELSE_NAMED)])
_BOX = frozenset("list box area bar wrap wrapper container section form link left right widget banner notice block body text item thread count feed".split())
_FAINT = frozenset("header banner promo teaser notice warning alert legal".split())
_PLACE = frozenset("block text content body inner copy story section".split())
# Elements whose names describe the page, and words that make a name one of a state or of a title.
_WHOLE_PAGE = frozenset(("html", "body", "main"))
_STATE_FIRST = frozenset("no not non has have with without show hide".split())
_STATE_LAST = frozenset("fixed sticky static dark light accepted enabled disabled on off none free visible shown style layout default transparent open closed collapsed expanded full wide boxed".split())
_TITLED = frozenset("entry post article story content section".split())
_TALK = frozenset((".comment", ".reply", ".replie", ".discussion", ".response", ".disqu"))


@dataclass(slots=True)
class _Element:
    name: str
    parent: int
    own: list[str]  # what is known of it: its name and the words of its names
    label: str
    section: int
    box: int  # place in the stack of the nearest open element that is not inline, itself included
    inline: Counter[str] | None  # open inline elements since this one, if it is not inline
    words: int = 0
    paragraphs: int = 0
    leads: bool = False  # the main heading stands in it


@dataclass(slots=True)
class Block:
    """Text without a block tag inside; tags: those since the block before."""

    parts: list[str] = field(default_factory=list)
    runs: list[tuple[int, int]] = field(default_factory=list)  # (element, words)
    words: int = 0
    score: float = 0.0
    place: float = 0.0  # what the words score by where they stand, links and tags aside
    tags: list[str] = field(default_factory=list)
    section: int = 0


@dataclass(frozen=True)
class Weights:
    base: float
    element: dict[str, float]
    tag: dict[str, float]


def _name_words(token: str, name: str) -> list[str]:
    """The words of one class, id or role that tell what stands in the element."""
    words = [x.lower() for x in _NAME.findall(token)]
    state = words[:1] and (words[0] in _STATE_FIRST or words[-1] in _STATE_LAST)
    if len(words) > 1 and (state or name == "article" or words[0] in _TITLED and words[-1] == "header" or words[0] in _FAINT and words[-1] in _PLACE):
        return []
    words += [x for w in words for x in _ELSE_NAMED if len(x) > 5 and w.startswith(x) and w[len(x) :].removesuffix("s") in _BOX]
    if name[:1] == "h" and name[1:].isdigit():  # a heading's own style
        words = [x for x in words if x not in ("header", "banner")]
    return words


def features(name: str, rest: str) -> tuple[list[str], str]:
    """What is known of an element, and its label on a labelled page."""
    found, label = [] if name in _SHAPE else [name], ""
    if len(rest) > 1:
        for key, value in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), value.strip("\"'")
            if key == "data-label":
                label = value
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                found.append(".hidden")
            elif key in ("class", "id", "role") and name not in _WHOLE_PAGE:
                found += [f".{x.rstrip('s')}" for token in value.split() for x in _name_words(token, name)]
    return found, label


def read(page: str) -> tuple[list[_Element], list[Block]]:
    """The page's elements (the first is the page itself) and its blocks, both in order."""
    root = _Element("", -1, [], "", 0, 0, Counter())
    elements, out, block = [root], [], Block()
    stack: list[int] = [0]
    open_: Counter[str] = Counter()
    sections, at, end, last = 0, 0, len(page), page.rfind(">")
    quotes, unclosed = True, set()

    def text(chunk: str) -> None:
        words = len(chunk.split())
        block.parts.append(chunk)
        if words:
            e = stack[-1]
            block.words += words
            block.section = block.section or elements[e].section
            block.runs.append((e, words))
            elements[e].words += words

    def cut() -> None:
        nonlocal block
        if block.words:
            out.append(block)
            block = Block()
        else:
            block.parts.clear()

    def pop_to(depth: int) -> None:
        for i in stack[depth:]:
            e = elements[i]
            open_[e.name] -= 1
            if e.inline is None and (box := elements[stack[e.box]] if e.box < depth else None):
                box.inline[e.name] -= 1
        del stack[depth:]

    while at < end:
        m = _OPEN.search(page, at)
        if m is None or m.start() > last and not m[1]:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        if m[1]:
            close = page.find("-->", m.end())
            at = close + 3 if close >= 0 else end
            continue
        at = m.end()
        if m[2]:
            at = page.index(">", at) + 1
            continue
        name = m[4].lower()
        closed = _QUOTED.match(page, at) if quotes else None
        if closed is None:
            quotes = False
        rest = page[at : (closed.end() if closed else page.index(">", at) + 1)]
        at += len(rest)
        if name == "head" and not m[3]:
            close = None if "head" in unclosed else _HEAD_END.search(page, at)
            if close:
                at = page.find(">", close.end()) + 1 or end if close.end() > close.start() else close.end()
            else:
                unclosed.add("head")
            continue
        if name in _RAW:
            if not m[3]:
                close = None if name in unclosed else _RAW[name].search(page, at)
                if close:
                    at = page.find(">", close.end()) + 1 or end
                elif name in _TO_END:
                    at = end
                else:
                    unclosed.add(name)
            continue
        if name == "br":
            block.parts.append(" ")
            continue
        inline = name in _INLINE
        if not inline:
            cut()
        block.tags.append(name)
        if m[3]:
            box = elements[stack[elements[stack[-1]].box]]
            if (box.inline[name] if inline else open_[name]) > 0:
                depth = len(stack) - 1
                while elements[stack[depth]].name != name:
                    depth -= 1
                pop_to(depth)
            continue
        if name in _VOID:
            continue
        if not inline:  # a paragraph ends where another block begins, an item where the next begins
            stops = _LISTS.get(name, ())
            while (depth := elements[stack[-1]].box) > 0:
                before = elements[stack[depth]].name
                if not (before == "p" or stops and before in _LISTS and before not in stops):
                    break
                pop_to(depth)
        own, label = features(name, rest)
        parent = elements[stack[-1]]
        sections += name in _SECTION
        e = _Element(name, stack[-1], own, label or parent.label, parent.section or (sections if name in _SECTION else 0), parent.box if inline else len(stack), None if inline else Counter())
        e.leads = name in ("h1", "main") or ".main" in own and "role" in rest.lower()
        e.paragraphs = int(name == "p")
        if inline:
            elements[stack[e.box]].inline[name] += 1
        open_[name] += 1
        stack.append(len(elements))
        elements.append(e)
    cut()
    for e in reversed(elements[1:]):
        parent = elements[e.parent]
        parent.words += e.words
        parent.paragraphs += e.paragraphs
        parent.leads |= e.leads
    return elements, out


def _known(elements: list[_Element], weights: dict[str, float] | None, frame) -> Iterator[tuple[float, float, bool, tuple[str, ...]]]:
    """For each element what stands around its words: the weight, the weight without links, whether it is clearly something else, and (without weights) the features.

    What is around a word counts once, however often it is; of frames nothing counts.
    """
    around: Counter[str] = Counter()
    path: list[tuple[int, list[str], float, float, bool]] = []
    for i, e in enumerate(elements):
        while path and path[-1][0] != e.parent:
            around.subtract(path.pop()[1])
        weight, unlinked, other = path[-1][2:] if path else (0.0, 0.0, False)
        own = [] if e.own and frame(e) else e.own
        for x in own:
            if weights and not around[x]:
                w = weights.get(x, 0.0)
                weight += w
                unlinked += w * (x != "a")
            around[x] += 1
        other |= not _CLEARLY_ELSE.isdisjoint(own)
        path.append((i, own, weight, unlinked, other))
        yield weight, unlinked, other, () if weights else tuple(x for p in path for x in p[1])


def blocks(elements: list[_Element], found: list[Block], weights: Weights, way: str = "") -> list[Block]:
    """The blocks with their scores.

    ``rescue`` takes every element that holds half of the words for a frame;
    ``rest`` asks only whether words stand in boxes that are clearly something else.
    """
    half = elements[0].words / 2

    def frame(e: _Element) -> bool:
        if e.name == "form" and e.leads:
            return True
        return e.words >= half and (e.leads or e.name == "form" or way == "rescue" and e.paragraphs >= 3 and not _TALK.intersection(e.own))

    def score(weight: float, other: bool) -> float:
        if way == "rest":
            return -1.0 if other else 1.0
        return min(weights.base + weight, -1.0) if other else weights.base + weight

    known = [(score(w, o), score(u, o)) for w, u, o, _ in _known(elements, weights.element, frame)]
    for b in found:
        b.score = sum(n * known[e][0] for e, n in b.runs) + sum(weights.tag.get(t, 0.0) for t in b.tags)
        b.place = sum(n * known[e][1] for e, n in b.runs)
    return found


@cache
def fit(pages: tuple[str, ...] | None = None, steps: int = 3000, rate: float = 4.0, decay: float = 5e-5) -> Weights:
    """Weights from labelled pages.

    Words: logistic regression of "is content" on what is known of the elements
    around them.  Tags: minus the logarithm of how much likelier they stand
    outside content than inside, never above -0.05.
    """
    if pages is None:
        from trackforge.llm.html_labelled import PAGES

        pages = tuple(PAGES)
    rows, inside, outside = [], Counter(), Counter()
    for page in pages:
        elements, found = read(page)
        known = [k for *_, k in _known(elements, None, lambda e: False)]
        for b in found:
            labels = [elements[e].label == "content" for e, _ in b.runs]
            rows += [(set(known[e]), y) for (e, _), y in zip(b.runs, labels)]
            (inside if all(labels) else outside).update(b.tags)
    names = {x: i for i, x in enumerate(sorted({x for known, _ in rows for x in known}))}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for i, (known, _) in enumerate(rows):
        x[i, [names[k] for k in known]] = 1
    y, w = np.array([r[1] for r in rows], float), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= rate * (x.T @ (p - y) / len(y) + decay * w * (np.arange(len(w)) < len(names)))
    tags = {t: -max(0.05, float(np.log((outside[t] + 1) / (inside[t] + 1)))) for t in {*inside, *outside}}
    return Weights(float(w[-1]), {k: float(w[i]) for k, i in names.items()}, tags)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the greatest sum, by one linear scan; (0, 0) if none is positive."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, at = total, (start, i + 1)
    return at


def _is_heading(elements: list[_Element], block: Block) -> bool:
    e = elements[block.runs[0][0]]
    return any(len(x) == 2 and x[0] == "h" and x[1].isdigit() for x in (e.name, elements[e.parent].name))


def _region(elements: list[_Element], found: list[Block], least: float) -> list[Block]:
    """The blocks of the best region and of the sections that it lies in, without those inside that score negatively."""
    start, end = best_region([max(least, b.score) for b in found])
    while 0 < start < end and found[start - 1].place > 0 and _is_heading(elements, found[start - 1]):  # the text's own headings
        start -= 1
    chosen = set(range(start, end))
    if sections := {found[i].section for i in chosen if found[i].score > 0} - {0}:
        chosen |= {i for i, b in enumerate(found) if b.section in sections}
    return [found[i] for i in sorted(chosen) if found[i].place > 0]


def main_text(page: str, weights: Weights, least: float = -4.0) -> str:
    """``least`` bounds what one block can cost, so that an advert inside an article does not end it."""
    elements, found = read(page)
    held = lambda chosen: sum(b.words for b in chosen)
    best = _region(elements, blocks(elements, found, weights), least)
    if 7 * held(best) < elements[0].words:
        best = max(best, _region(elements, blocks(elements, found, weights, "rescue"), least), key=held)
    if not best:
        best = [b for b in blocks(elements, found, weights, "rest") if b.place > 0]
    texts = (" ".join(html.unescape("".join(b.parts)).split()) for b in best)
    return "\n".join(x for x in texts if x)


def extract(pages: DataFrame, labelled: tuple[str, ...] | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page; no shuffle."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = fit(labelled)
        for b in batches:
            texts = [main_text(x.as_py() or "", weights) for x in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return in_batches(pages.select(*columns)).mapInArrow(work, "page_id long, url string, text string, n_chars long")
