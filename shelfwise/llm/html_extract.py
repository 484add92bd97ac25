"""Main text of web pages by tag-path ratios.

A page is scanned once into text nodes, each with its root-to-leaf tag path and its chain of elements. Text nodes
below boilerplate elements (menus, headers, footers, sidebars, notices, adverts, forms, comments of readers, hidden
parts, scripts, styles) get no vote. For every path of the rest the number of nodes, the length of their text and
their punctuation are summed: length per node and punctuation per node are the ratios of the path. Along the page
both ratios are smoothed with a Gaussian over neighbouring nodes and fused to their product with the path's text
length; nodes at or above a share of the mean are content nodes. The deepest element that holds all of them is the
article (without a marked article, the h1 headings too), and every block of it without boilerplate is its text. So no
content node is lost, and a short heading or a line of few words between them is kept.

Blocks are runs of inline text between block tags. White space inside a block becomes one blank; blocks are joined in
page order by a line break. Character references are decoded, markup is dropped, nothing else is.

A class or id is a cue only as a whole token and never against <article>, <main>, what holds them or what holds most
of the content (``without_cued``).

Nulls and empty pages give an empty text, pages of boilerplate elements alone too. Broken markup is read as browsers do in
the common cases: unclosed paragraphs and list items end at the next one, end tags without a start are skipped, an
open comment, script or style runs to the end. Pages are independent rows of one narrow pass; repeated rows give
repeated results. Only the three named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARE = 0.3
SMOOTH = np.array([0.25, 0.5, 1.0, 0.5, 0.25])

#: Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math object xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark meter nobr output progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = set(
    "nav footer aside form script style noscript template iframe svg math object button select option textarea dialog "
    "menu head title audio video canvas map applet frame frameset input fieldset legend datalist".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ARTICLES = set("article main".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
CUES = set(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion promoted nav navbar "
    "navigation menu menubar submenu breadcrumb breadcrumbs header masthead topbar footer foot bottombar sidebar side aside rail cookie "
    "cookies consent gdpr notice notices notification alert banner popup modal overlay newsletter subscribe subscription signup "
    "login signin register comment comments commentlist disqus reply replies respond discussion share sharing social follow related "
    "recommended recommendations widget widgets toolbar pagination pager copyright legal disclaimer hidden".split()
)
#: Cues of parts that hold <article> elements of others: comments of readers, teasers.
OTHERS = set(
    "comment comments commentlist disqus reply replies respond discussion related recommended recommendations widget widgets promo "
    "promotion promoted sponsor sponsored".split()
)
#: Start tags that end an open element of the same group.
SIBLINGS = [{"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}, {"thead", "tbody", "tfoot"}]

TAG = re.compile(r"<(?:!--|/?[a-zA-Z]|[!?])")
#: Rest of a tag: a quote counts only where an attribute value starts, and only if it is closed.
END = re.compile(r"""(?>[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]*))?)*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
SPLIT = re.compile(r"[-_]+")
PUNCTUATION = re.compile(r"[,.;:!?…、。，！？；]")
SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("name", "parent", "path", "dropped", "cues", "holds", "depth")

    def __init__(self, name: str, parent: Element | None, dropped: bool, cues: set[str] = frozenset()):
        self.name, self.parent, self.dropped, self.cues = name, parent, dropped, cues
        #: whether an article or main element stands in it
        self.holds = False
        self.path = name if parent is None else f"{parent.path}>{name}"
        self.depth = 0 if parent is None else parent.depth + 1


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(text):
        found.setdefault(key.lower(), html.unescape(value.strip("\"'")))
    return found


def is_boilerplate(name: str, a: dict[str, str], inside_article: bool) -> bool:
    """Whether an element by its name, role or visibility starts a part of the page that is never article text."""
    if name in DROPPED or (name == "header" and not inside_article):
        return True
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "").lower()):
        return True
    return a.get("role", "").lower() in ROLES


def cues_of(name: str, a: dict[str, str], inside_article: bool) -> set[str]:
    """Cues among the class and id tokens of an element: a token all of whose parts are cues ("cookie-notice")."""
    if name in HEADINGS or name in ARTICLES or name in ("html", "body"):
        return frozenset()
    found: set[str] = set()
    for key in ("class", "id"):
        for token in a.get(key, "").lower().split():
            parts = [t for t in SPLIT.split(token) if t]
            if parts and all(t in CUES for t in parts):
                found.update(parts)
    return found - {"header"} if inside_article else found


def blocks(page: str) -> list[tuple[Element, str]]:
    """(element, text) of all text blocks outside boilerplate by name, role or visibility, in page order."""
    root = Element("#", None, False)
    at, out, run = 0, [], []
    here = owner = root
    articles = 0

    def flush() -> None:
        if run:
            text = SPACE.sub(" ", html.unescape("".join(run))).strip()
            if text and not owner.dropped:
                out.append((owner, text))
            run.clear()

    def text_until(end: int) -> None:
        nonlocal owner
        if end > at and not here.dropped:
            if not run:
                owner = here
                while owner.name in INLINE and not owner.cues and owner.parent is not None:
                    owner = owner.parent
            run.append(page[at:end])

    def close(to: Element) -> None:
        nonlocal here, articles
        while here is not to:
            if here.name not in INLINE or here.cues:
                flush()
            if here.name in ARTICLES:
                articles -= 1
            here = here.parent

    while True:
        m = TAG.search(page, at)
        if m is None:
            text_until(len(page))
            break
        text_until(m.start())
        mark = m.group()
        if mark == "<!--":
            k = page.find("-->", m.end())
            at = len(page) if k < 0 else k + 3
            continue
        if mark in ("<!", "<?"):
            k = page.find(">", m.end())
            at = len(page) if k < 0 else k + 1
            continue
        start = m.end() - 1
        name = NAME.match(page, start).group().lower()
        e = END.match(page, start + len(name))
        # a tag that never ends swallows the rest of the page
        at = e.end() if e else page.find(">", start) + 1 or len(page)
        if mark[1] == "/":
            up = here
            while up is not root and up.name != name:
                up = up.parent
            if up is not root:
                close(up.parent)
            elif name in ("p", "br"):
                flush() if name == "p" else run.append(" ")
            continue
        attrs = page[start + len(name) : at - 1]
        if name == "br":
            if run:
                run.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name not in INLINE:
            up = here
            while up is not root and up.name in INLINE:
                up = up.parent
            if up.name == "p" or up.name in HEADINGS and name in HEADINGS:
                close(up.parent)
            group = next((g for g in SIBLINGS if name in g), None)
            if group:
                up = here
                while up is not root and up.name not in group and up.name not in ("ul", "ol", "dl", "table", "select"):
                    up = up.parent
                if up.name in group:
                    close(up.parent)
            flush()
        a = attributes(attrs) if attrs.strip(" /") else {}
        dropped = here.dropped or is_boilerplate(name, a, articles > 0)
        cues = frozenset() if dropped else cues_of(name, a, articles > 0)
        if attrs.endswith("/") and name in RAW:
            continue
        if name in RAW:
            k = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = len(page) if k is None else k.start()
        if (dropped and not here.dropped or cues) and name in INLINE:
            flush()
        here = Element(name, here, dropped, cues)
        if name in ARTICLES:
            articles += 1
            up = here.parent
            while up is not None and not dropped and not up.holds:
                up.holds = True
                up = up.parent
    flush()
    return out


def fused_scores(found: list[tuple[Element, str]]) -> np.ndarray:
    """Score of every block: smoothed length and punctuation ratios of its tag path, fused."""
    nodes, length, marks = Counter(), Counter(), Counter()
    for element, text in found:
        nodes[element.path] += 1
        length[element.path] += len(text)
        marks[element.path] += len(PUNCTUATION.findall(text))
    per_length = np.array([length[e.path] / nodes[e.path] for e, _ in found])
    per_mark = np.array([marks[e.path] / nodes[e.path] for e, _ in found])
    total = np.array([length[e.path] for e, _ in found], float)
    weight = np.convolve(np.ones(len(found)), SMOOTH, "same")[: len(found)] if len(found) >= len(SMOOTH) else None

    def smooth(x: np.ndarray) -> np.ndarray:
        return x if weight is None else np.convolve(x, SMOOTH, "same") / weight

    return np.log1p(smooth(per_length)) * np.log1p(1 + smooth(per_mark)) * np.log1p(total)


def without_cued(found: list[tuple[Element, str]]) -> list[tuple[Element, str]]:
    """Blocks outside elements that a cue drops.

    A cue drops no element that holds most of the content score (score by length of text) or an article or main
    element, unless it names parts that hold those of others. A paragraph with a cue stays where the article holds it.
    """
    if not any(up.cues for element, _ in found for up in chain(element)):
        return found
    score = [s * len(text) for s, (_, text) in zip(fused_scores(found), found)]
    held: Counter = Counter()
    for s, (element, _) in zip(score, found):
        for up in chain(element):
            if up.cues:
                held[id(up)] += s
    total = sum(score)

    def drops(e: Element) -> bool:
        if not e.cues or e.name == "p" or 2 * held[id(e)] > total:
            return False
        return not e.holds or bool(e.cues & OTHERS)

    return [(element, text) for element, text in found if not any(drops(up) for up in chain(element))]


def chain(element: Element | None) -> Iterator[Element]:
    """The element and all around it."""
    while element is not None:
        yield element
        element = element.parent


def common(one: Element, other: Element) -> Element:
    """Deepest element that holds both."""
    while one is not other:
        if one.depth >= other.depth:
            one = one.parent
        else:
            other = other.parent
    return one


def marked(element: Element | None) -> Element | None:
    """The nearest article or main element around an element."""
    while element is not None and element.name not in ARTICLES:
        element = element.parent
    return element


def main_text(page: str | None) -> str:
    found = without_cued(blocks(page or ""))
    if not found:
        return ""
    score = fused_scores(found)
    good = [element for (element, _), s in zip(found, score) if s >= SHARE * score.mean()]
    # a paragraph with a cue is text of the article around it, but says nothing about where that is
    voters = [element for element in good if not element.cues] or good
    article = voters[0]
    for element in voters:
        article = common(article, element)
    if marked(article) is None:
        # no mark says where the article starts: its title is an h1
        for element, _ in found:
            if element.name == "h1":
                article = common(article, element)
    # a paragraph or heading is not an article: take what it stands in; a marked article around it wins
    while article.parent is not None and (article.name in HEADINGS or article.name in ("p", "li", "ul", "ol", "blockquote", "pre", "td", "tr", "tbody", "table")):
        article = article.parent
    article = marked(article) or article

    def inside(element: Element | None) -> bool:
        while element is not None and element is not article:
            element = element.parent
        return element is article

    return "\n".join(text for element, text in found if inside(element))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    three = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType(
        [three.schema["page_id"], three.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return three.mapInArrow(run, schema)
