"""Operator 6, HTML extraction: ratios of tag paths tell content from the rest of a page.

A page's text falls into blocks, each with the path of tags that leads to it; each ``article`` or ``main`` element has paths of
its own, and so have parts that are marked as something else (navigation, forms, comments of readers and the like). Per
path, the lengths of text and the punctuation of all its blocks are averaged; both are smoothed over neighbouring paths in
page order and fused; paths that reach a share of the page's mean are content. Classes and names of elements only weigh a
ratio: far less where they name what is never an article, a little less where the name may be a topic, too. All paths of one article share the
best ratio among them.

Ratios are smoothed over the tree, too, so that headings, lists and cells stay with the text they belong to: a short block takes the ratio
of the nearest element around it that has content, which is the share that content has of that element's text. Only markup and scripts are out
from the start.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Elements of HTML without content, elements whose content is not markup, elements inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe select annotation".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark object q s samp small span strike strong sub sup time tt u var wbr".split())
#: Formulas and drawings: what text they hold belongs to the line they stand in, whatever their elements are called.
EMBEDDED = frozenset("math svg".split())
#: Elements and words of a class, id or role that mark what is not the article; of the second kind are words that a text may be
#: about, so they count as whole names only, and weigh little.
OUTSIDE = frozenset("nav header footer aside form button menu dialog head".split())
OUTSIDE_WORDS = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement sponsor sponsored promo banner "
    "notice cookie cookies consent popup modal comment comments disqus breadcrumb breadcrumbs pagination pager complementary contentinfo".split()
)
MAYBE_OUTSIDE = frozenset("reply replies form search login signup subscribe newsletter share social related recommended toolbar widget".split())
#: Elements that hold a whole page or article, whatever their classes say.
WHOLE = frozenset("html body article main".split())
#: Elements that end an open paragraph, as browsers do.
ENDS_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section div body html main nav header footer aside form".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>?|<[!?][^<>]*>?", re.S)
WORDS = re.compile(r"[a-z]+")
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
SPACE = re.compile(r"[ \t\n\r\f\v]+")
PUNCTUATION = re.compile(r"[.,;:!?。，！？、]")
#: Elements that stand in each other at most.
DEEPEST = 512
#: Share of the mean fused ratio that a path has to reach; weight of each neighbour in smoothing.
LEAST_SHARE, NEIGHBOUR = 0.2, 0.1
#: Weights of a ratio: in no part marked as something else, in one that may be, in one that is.
WEIGHTS = (1.0, 0.3, 0.001)
#: Share of an element's text that has to be content for its other blocks to belong to it.
CONTENT_SHARE = 0.5
#: Blocks that belong to the content around them where no element but the body holds it.
BELONGING = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th pre blockquote figcaption caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _outside(label: str) -> int:
    """How far a class, id or role names a part of a page that is not the article: a place in ``WEIGHTS`` ("with-sidebar" does not)."""
    parts = WORDS.findall(label)
    if not parts or parts[0] in ("with", "has", "no", "is"):
        return 0
    return 2 if not OUTSIDE_WORDS.isdisjoint(parts) else int(len(parts) == 1 and parts[0] in MAYBE_OUTSIDE)


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int, int, tuple[int, ...]]]:
    """(path, text, how far it is marked as something else, number of the innermost article element or 0, numbers of the elements
    around it) of every block, in page order."""
    out: list = []
    open_tags: list[tuple[str, int, int, int]] = []
    articles = elements = 0
    embedded = ""
    text: list[str] = []
    at = 0

    def flush() -> None:
        if text:
            joined = SPACE.sub(" ", html.unescape("".join(text))).strip(" \t\n\r\f\v")
            text.clear()
            if joined:
                around = [t for t in open_tags if t[0] not in INLINE]
                outside, inside = (open_tags[-1][1], open_tags[-1][2]) if open_tags else (0, 0)
                out.append((tuple(t[0] for t in around), joined, outside, inside, tuple(t[3] for t in around)))

    def close(name: str) -> None:
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i][0] == name:
                del open_tags[i:]
                return

    def closes_implied(names: tuple[str, ...]) -> None:
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i][0] in names:
                del open_tags[i:]
                return
            if open_tags[i][0] in SCOPES:
                return

    while found := TAG.search(page, at):
        if found.start() > at:
            text.append(page[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if embedded and name not in RAW:
            # Nothing inside a formula ends a line; only its own end closes it.
            embedded = "" if found["close"] and name == embedded else embedded
            continue
        if name in EMBEDDED:
            embedded = "" if found["close"] or found["rest"].endswith("/") else name
            continue
        if name not in INLINE and name not in RAW:
            flush()
        if found["close"]:
            if name == "p" and not any(t[0] == "p" for t in open_tags):
                continue
            close(name)
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^<>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or found["rest"].endswith("/"):
            continue
        if name in ENDS_P:
            closes_implied(("p",))
        if name in SAME_ENDS:
            closes_implied(SAME_ENDS[name])
        marked = 0
        if "=" in found["rest"] and name not in WHOLE:
            marked = max((_outside(x) for a in ATTRIBUTE.findall(found["rest"]) for x in a.strip("\"'").lower().split()), default=0)
        above = open_tags[-1] if open_tags else (None, 0, 0, 0)
        article = name in ("article", "main") and not above[1]
        articles += article
        elements += 1
        outside = max(above[1], 2 if name in OUTSIDE and not (name == "header" and above[2]) else 0, marked)
        if len(open_tags) >= DEEPEST:
            # As in browsers, what is nested deeper belongs to the element that far down.
            open_tags.pop()
        open_tags.append((name, outside, 0 if outside else articles if article else above[2], elements))
    text.append(page[at:])
    flush()
    return out


def _with_surroundings(found: list, chosen: list[bool]) -> list[bool]:
    """Chosen blocks, and those that take the ratio of the element around them.

    The nearest element around a block that holds content decides: if content has its share of the element's unmarked
    text, the block belongs to it. Directly in the body a block belongs to it if it stands between content, or is a heading just before.
    """
    whole: dict[int, int] = {}
    content: dict[int, int] = {}
    for (path, text, outside, _, around), is_content in zip(found, chosen):
        for name, element in zip(path, around):
            if name not in ("html", "body") and not (outside and not is_content):
                whole[element] = whole.get(element, 0) + len(text)
                content[element] = content.get(element, 0) + is_content * len(text)
    places = [i for i, c in enumerate(chosen) if c]
    out = list(chosen)
    for i, (path, _, outside, _, around) in enumerate(found):
        if chosen[i] or outside or not places:
            continue
        # An article that fell short is not made up for by what stands around it.
        own = max((k for k, name in enumerate(path) if name in ("article", "main")), default=-1)
        near = next((e for e in reversed(around[max(own, 0) :]) if content.get(e)), None)
        if near is not None:
            out[i] = content[near] >= CONTENT_SHARE * whole[near]
        elif own < 0:
            out[i] = bool(path) and path[-1] in BELONGING and places[0] < i < places[-1]
    # Headings that lead over to content, the last one first; those within its element have been judged with it.
    for i in range(len(found) - 2, -1, -1):
        path, _, outside, _, around = found[i]
        if not out[i] and not outside and out[i + 1] and path and path[-1] in HEADINGS and not any(content.get(e) for e in around):
            out[i] = True
    return out


def path_ratios(found: list) -> tuple[dict[tuple, float], float]:
    """The fused ratio of every path (with its marks and article), and what content has to reach."""
    sums: dict[tuple, list[int]] = {}
    for path, text, outside, article, _ in found:
        of = sums.setdefault((path, outside, article), [0, 0, 0])
        of[0] += len(text)
        of[1] += len(PUNCTUATION.findall(text))
        of[2] += 1
    paths = list(sums)
    smooth = lambda values: [
        ((1 - 2 * NEIGHBOUR) * v + NEIGHBOUR * ((values[i - 1] if i else 0) + (values[i + 1] if i + 1 < len(values) else 0))) for i, v in enumerate(values)
    ]
    length = smooth([sums[p][0] / sums[p][2] for p in paths])
    marks = smooth([sums[p][1] / sums[p][2] for p in paths])
    # Where all of a page is marked (a form around everything, say), the least marked parts weigh in full.
    least = min(outside for _, outside, _ in paths)
    weights = [WEIGHTS[outside - least] if outside else 1.0 for _, outside, _ in paths]
    fused = {p: w * a * (1 + b) for p, w, a, b in zip(paths, weights, length, marks)}
    best: dict[int, float] = {}
    for p, f in fused.items():
        best[p[2]] = max(best.get(p[2], 0.0), f)
    ratios = {p: best[p[2]] if p[2] else f for p, f in fused.items()}
    return ratios, LEAST_SHARE * sum(fused.values()) / sum(weights)


def main_text(page: str | None) -> str:
    """The text of a page's content, blocks joined by one space; empty for null and for pages without text."""
    found = blocks(page or "")
    if not found:
        return ""
    ratios, least = path_ratios(found)
    chosen = [ratios[path, outside, article] >= least for path, _, outside, article, _ in found]
    return " ".join(b[1] for b, stays in zip(found, _with_surroundings(found, chosen)) if stays)


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` and ``n_chars`` (its code points).

    A null or empty page has an empty text. Every page is read whole and by itself; repeated rows get equal results and an
    empty table stays empty. Broken markup is read as browsers do: unclosed paragraphs end at the next block, an unclosed
    tag or comment runs to the end. Columns named ``text`` or ``n_chars`` are replaced.
    """
    ids = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    schema = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in ids), "text string", "n_chars bigint"])

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch.pop("_html")]
            yield batch.assign(text=texts, n_chars=[len(t) for t in texts])

    return pages.select(*ids, pages[html_column].alias("_html")).mapInPandas(extract, schema)
