"""Main text of HTML pages: two passes over blocks by stop-word density, length and links.

A page is cut into blocks at block-level tags. The first pass decides blocks that are clear: by
the element they stand in (navigation, footer, aside, form, an advert's class ...), by the share
of their text in links, by length and by the density of stop words; short and middling blocks stay
open. In the second pass an open block takes the label of its nearest decided neighbours.
Inside an article the page has said what is text, so only clear signs against a block count there;
what stands beside it goes if the article holds most of the text. Few stop words alone leave a block
open. On a page whose text has few of them (another language, code) length and links decide.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import with_fields

# Frequent words of the languages of the pages.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be because been before but by can could did do for from had has have he her
    him his how i if in into is it its just like more most my no not of on one only or other our out over said she so some
    than that the their them then there these they this time to two up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer er es für
    hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so um und uns unter vom von vor war
    was wenn werden wie wir wird zu zum zur über
    alors au aux avec ce ces cette comme dans de des du elle elles en est et il ils je la le les leur lui mais me même mes
    mon ne nous on ou où par pas plus pour qu que qui sa sans se ses si son sont sur ta te tu un une vous à été être
    al algo ante como con contra cual cuando de del desde donde el ella ellos en entre era es esta este están fue ha hasta
    hay la las lo los mi muy más ni no nos o para pero por que quien se sin sobre su sus también te tiene un una uno y ya
    """.split()
)
# Elements, and words in class, id or role, that mark what is no main text.
_OUTSIDE = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "select", "fieldset", "datalist", "canvas", "object", "head", "map"}
_SILENT = {"script", "style", "noscript", "template", "iframe", "svg", "math", "textarea", "title", "audio", "video", "noframes", "xmp"}
_WORDS_OUTSIDE = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "sidebar", "widget", "rail",
    "footer", "masthead", "header", "topbar", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "signup", "login", "search", "share", "sharing", "social", "comment", "comments", "commentlist", "disqus",
    "reply", "replies", "respond", "related", "recommended", "contentinfo", "complementary", "copyright", "disclaimer", "skip",
}
_WORDS_INSIDE = {"article", "content", "main", "post", "story", "entry", "body"}
_BLOCKS = set(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
    tfoot th thead tr ul caption""".split()
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CLOSED_BY_SIBLING = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",),
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^>]*(?:>|\Z))",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"\s(?:hidden(?=[\s/>=])|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[^\W\d_]+")
# Scripts that write a word with a letter or two.
_WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uac00-\ud7af\U00020000-\U0003ffff]")

SHORT, LONG = 70, 200
SPARSE, DENSE = 0.30, 0.32
LINKED = 0.2


@dataclass(slots=True)
class Block:
    tag: str
    outside: bool
    article: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    size: int = 0  # length, a letter of a wide script for three
    share: float = 0.0  # of the text in links
    density: float = 0.0  # of stop words
    notice: bool = False  # a copyright line by its looks


def _names_outside(rest: str) -> bool:
    """Whether class, id or role speak of something beside the text."""
    words: list[str] = []
    for value in _NAMES.findall(rest):
        words += re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
    found = [w for i, w in enumerate(words) if w in _WORDS_OUTSIDE and (i == 0 or words[i - 1] not in ("has", "with", "no", "without"))]
    comments = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "related"}
    return bool(found) and (not _WORDS_INSIDE.intersection(words) or bool(comments.intersection(found)))


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, each with where it stands."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # name, outside, in an article, in a link, outside for a form only
    now = ("", False, False, False, False)
    current: Block | None = None
    at = 0

    def add(text: str) -> None:
        nonlocal current
        if current is None or (current.outside, current.article) != (now[1], now[2]):
            current = Block(next((s[0] for s in reversed(stack) if s[0] in _BLOCKS), ""), now[1], now[2])
            out.append(current)
        text = html.unescape(text)
        current.parts.append(text)
        if now[3]:
            current.linked += len(text.strip())

    def close(depth: int) -> None:
        nonlocal now
        del stack[depth:]
        now = stack[-1] if stack else ("", False, False, False, False)

    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at:tag.start()])
        at = tag.end()
        if tag["name"] is None:
            continue
        name, rest = tag["name"].lower(), tag["rest"]
        if tag["end"]:
            if name in _BLOCKS:
                current = None
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                close(depth)
            continue
        if name in _SILENT:
            if not rest.endswith("/>") or name not in ("svg", "math"):
                over = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else len(page)
            continue
        if name == "br":
            add(" ")
            continue
        if name in _BLOCKS:
            current = None
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
            if depth is not None and all(s[0] not in _BLOCKS for s in stack[depth + 1:]):
                close(depth)
        if name == "body":
            close(next((i for i, s in enumerate(stack) if s[0] == "head"), len(stack)))
        if name in _CLOSED_BY_SIBLING:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if stack[i][0] in _CLOSED_BY_SIBLING[name]:
                    break
        if name in _VOID:
            continue
        _, outside, article, link, form = now
        is_article = name in ("article", "main") or re.search(r"role\s*=\s*[\"']?main\b|articleBody", rest) is not None
        if is_article and form:
            outside, form = False, False  # a form around the whole page
        beside = name in _OUTSIDE or (name == "header" and not article) or bool(_HIDDEN.search(rest))
        if not beside and name not in ("html", "body", "main", *_HEADINGS):
            beside = _names_outside(rest)
        if beside and not outside:
            outside, form = True, name == "form"
        elif beside and name != "form":
            form = False
        now = (name, outside, article or is_article, link or name == "a", form)
        stack.append(now)
    for block in out:
        block.text = " ".join("".join(block.parts).split())
    return [b for b in out if b.text]


def _measure(block: Block) -> None:
    words = [w.lower() for w in _WORD.findall(block.text)]
    block.size = len(block.text) + (0 if block.text.isascii() else 2 * len(_WIDE.findall(block.text)))
    block.share = block.linked / len(block.text)
    block.density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    block.notice = "\N{COPYRIGHT SIGN}" in block.text and not block.article and (block.size < SHORT or block.size < LONG and block.density < DENSE)


def _stop_words_tell(blocks: list[Block]) -> bool:
    """Whether at least half of the page's unlinked text has stop words: elsewhere they say nothing about a block."""
    sizes = [(b.size, b.density >= SPARSE) for b in blocks if not b.outside and b.share <= LINKED and b.size >= SHORT]
    return 2 * sum(n for n, dense in sizes if dense) >= sum(n for n, _ in sizes)


def _decide(block: Block, telling: bool) -> str:
    """First pass: good, bad, near (middling) or short."""
    if block.outside:
        return "bad"
    if block.article:
        if block.share > 0.5:
            return "bad" if block.tag == "li" else "short"
        return "good" if block.size >= SHORT or block.density >= DENSE else "short"
    if block.share > LINKED or block.notice:
        return "bad"
    if block.size < SHORT:
        return "bad" if block.linked else "short"
    if block.density >= DENSE or not telling:
        return "good" if block.size >= LONG else "near"
    if block.density >= SPARSE or block.size >= LONG:
        return "near"
    return "bad" if block.linked else "short"


def _neighbours(labels: list[str], decided: list[bool]) -> list[tuple[str | None, str | None]]:
    """The nearest decided labels before and after each block."""
    out: list[list[str | None]] = [[None, None] for _ in labels]
    for side, places in ((0, range(len(labels))), (1, range(len(labels) - 1, -1, -1))):
        seen = None
        for i in places:
            out[i][side] = seen
            seen = labels[i] if decided[i] else seen
    return [(before, after) for before, after in out]


def main_text(page: str | None) -> str:
    """The text of the good blocks, each on one line of words, joined by one space."""
    found = blocks_of(page or "")
    plain = [(max(0, len(b.text) - b.linked), b.article) for b in found if not b.outside]
    if 2 * sum(n for n, article in plain if article) > sum(n for n, _ in plain):
        found = [b for b in found if b.article]  # what stands beside the article is none of it
    for b in found:
        _measure(b)
    telling = _stop_words_tell(found)
    first = [_decide(b, telling) for b in found]
    # An advert inside an article says nothing about its neighbours.
    decided = [f in ("good", "bad") and not (b.outside and b.article) for b, f in zip(found, first, strict=True)]
    if any(b.notice for b in found):
        # A copyright line amid the text is part of it.
        around = _neighbours(first, [d and not (b.notice and not b.outside and b.share <= LINKED) for b, d in zip(found, decided, strict=True)])
        for i, b in enumerate(found):
            if b.notice and not b.outside and b.share <= LINKED and around[i] == ("good", "good"):
                first[i], decided[i] = "short", False
    final = list(first)
    nothing_good = "good" not in first
    for i, (before, after) in enumerate(_neighbours(first, decided)):
        label = first[i]
        if label in ("good", "bad"):
            continue
        sides = {before, after}
        if found[i].article or nothing_good:
            good = sides != {"bad"} or nothing_good
        elif sides == {"good", "bad"}:
            good = label == "near" or (found[i].tag in _HEADINGS and after == "good")
        else:
            good = "good" in sides
        final[i] = "good" if good else "bad"
    return " ".join(b.text for b, f in zip(found, final, strict=True) if f == "good")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("_html").to_pylist()]
        names = [n for n in batch.schema.names if n != "_html"]
        columns = [batch.column(n) for n in names]
        columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*names, "text", "n_chars"])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """The other columns of `pages` with text and n_chars (code points).

    White space, character references decoded, is one space inside a block. Null pages and pages
    without text give an empty text. Rows may repeat. Input columns named text or n_chars give way.
    """
    others = [c for c in pages.columns if c not in {html_column, "text", "n_chars"}]
    rows = pages.select(*others, F.col(html_column).alias("_html"))
    return rows.mapInArrow(_extract, with_fields(pages.select(*others).schema, "text string, n_chars long"))
