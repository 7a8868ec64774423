"""Main text of HTML pages (operator 7).

Method: two passes over the blocks of a page. The first gives each block a
score from its own features: its length, its density of stop words, its share
of linked characters, and where it lies. Scores high or low enough decide; the
blocks between, short ones above all, are ambiguous. The second pass lets those
inherit the label of their nearest decided neighbours, by two sweeps over the
page; a heading goes with what follows. Stop words are learnt from the pages
themselves: the words that the largest number of pages hold
(:func:`learn_stops`), beside a fixed list of common words of four languages.

Where a block lies is one feature among these. Navigation, page headers,
footers, asides, forms, hidden elements and those whose class, id or role names
them as menus, adverts, notices or reader comments speak strongly against it. A
marked article (or else main element) speaks for the blocks inside, and where a
page has one, against those outside.

Text: character references are decoded, white space inside a block (line
breaks and cell borders included) becomes one space, and blocks are joined in
page order by one line feed. Nothing else is dropped or cut. Scripts, styles,
comments and markup never are text; an unfinished tag at the end is dropped.
Of elements that hide their content (buttons, selects, objects ...) only those
with an end tag do so.

Cases: null and empty pages, and pages without text, give the empty text;
repeated rows are kept; an empty table gives an empty table; output columns
replace input columns of the same name.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator, Set
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.spotsigs import ANCHORS

# Thresholds of the first pass.
SHORT, LONG = 70, 200               # characters
FEW_STOPS, MANY_STOPS = 0.05, 0.3   # share of stop words
MAX_LINKS, MAX_LINKS_INSIDE = 0.33, 0.6   # share of linked characters, outside and inside the article
GOOD, BAD = 2, -1                   # scores that decide
PLACE = 2                           # what an article says for what is inside, against what is outside
# Of the stop words.
STOP_WORDS, STOP_PAGES = 600, 0.01  # at most so many, each on this share of the pages at least

STOPS = frozenset(ANCHORS)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())   # text up to the end tag, or to the end of the page
SKIPPED = frozenset("noscript template object svg math canvas select button audio video datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input output picture source".split())
SPACING = frozenset("br td th dt dd wbr col".split()) - {"wbr"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CLOSED = frozenset("nav header form menu".split())   # boilerplate only with an end tag
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
BOILER_NAMES = frozenset("""
    nav navbar navigation menu breadcrumb breadcrumbs sidebar footer ad ads advert adverts advertisement advertising sponsor
    sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription
    signup login share sharing social comment comments commentlist disqus reply replies respond related recommended
    recommendations widget pagination pager toolbar search banner skip copyright
""".split())
#: Names that speak against a block only outside the article.
OUTSIDE_NAMES = frozenset("header masthead topbar tags meta byline".split())

_token = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^\s/>]*[^>]*(?:>|\Z)|[^<]+|<""", re.S)
_attr = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_name_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_word = re.compile(r"\w+")
_end_tag = re.compile(r"</([a-zA-Z][^\s/>]*)")


@dataclass
class Open:
    """An open element and what holds for all inside it."""
    name: str
    boiler: bool
    inside: str           # "", "main" or "article"


@dataclass
class Block:
    boiler: bool
    inside: str
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = ""


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attr.finditer(raw)} if raw.strip(" /\n\t") else {}


def _open(name: str, attrs: dict[str, str], above: Open) -> Open:
    names = {p.lower() for p in _name_parts.findall(attrs.get("class", "") + " " + attrs.get("id", ""))}
    role = attrs.get("role", "").lower()
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
    own = name in BOILER_TAGS or role in BOILER_ROLES or hidden
    if name not in ("body", "html", "article", "main"):
        own = own or bool(names & BOILER_NAMES)
    elif name == "article":
        own = own or bool(names & {"comment", "reply", "ad", "advert", "sponsored", "promo", "related", "teaser", "card"})
    if not above.inside and not own:
        own = name == "header" or bool(names & OUTSIDE_NAMES) and name not in ("body", "html", "article", "main")
    inside = above.inside
    if name == "article" and not own or attrs.get("itemprop", "").lower() == "articlebody":
        inside = "article"
    elif not inside and (name == "main" or role == "main"):
        inside = "main"
    return Open(name, own or above.boiler, inside)


def blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in page order."""
    root = Open("", False, "")
    stack, out, links = [root], [], 0
    last_end = {m[1].lower(): m.start() for m in _end_tag.finditer(page)}
    current: Block | None = None

    def flush() -> None:
        nonlocal current
        if current is not None:
            current.text = " ".join("".join(current.parts).split())
            if current.text:
                out.append(current)
        current = None

    at = 0
    while m := _token.match(page, at):
        at = m.end()
        tag = m["name"]
        if tag is None:
            if m[0][0] == "<" and len(m[0]) > 1:
                continue
            if current is None:
                here = stack[-1]
                current = Block(here.boiler, here.inside, any(o.name in HEADINGS for o in stack[-3:]))
            piece = entities.unescape(m[0])
            current.parts.append(piece)
            if links:
                current.linked += len("".join(piece.split()))
            continue
        tag = tag.lower()
        if (tag in RAW or tag in SKIPPED) and not m["end"]:
            if not m["attrs"].rstrip().endswith("/"):
                if last_end.get(tag, -1) >= at:
                    closed = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = closed.end() if closed else at
                elif tag in RAW:
                    at = len(page)
            if current is not None:
                current.parts.append(" " if tag in ("select", "button") else "")
            continue
        if tag == "a":
            links = 0 if m["end"] else 1
        if tag in SPACING:
            if current is not None:
                current.parts.append(" ")
            continue
        if tag in INLINE:
            continue
        flush()
        links = 0 if tag != "a" else links
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == tag:
                    del stack[i:]
                    break
                if tag in ("p", "li") and stack[i].name not in ("p", "li", *HEADINGS):
                    break
            continue
        if tag in VOID or tag == "hr":
            continue
        if tag in ("p", "li", *HEADINGS, "div", "ul", "ol", "section", "article", "footer", "aside", "nav", "header", "main", "table", "form", "blockquote", "pre") and stack[-1].name in ("p", *HEADINGS):
            stack.pop()
        if tag == "li" and stack[-1].name == "li":
            stack.pop()
        above = stack[-1]
        if tag in ("article", "main") and above.boiler and stack[-1].name in ("nav", "header", "ul", "li", "form"):
            # an article does not lie in a menu: the menu was left open
            while stack[-1].boiler and stack[-1].name in ("nav", "header", "ul", "li", "form"):
                stack.pop()
            above = stack[-1]
        here = _open(tag, _attributes(m["attrs"]), above)
        if tag in CLOSED and here.boiler and not above.boiler and last_end.get(tag, -1) < at:
            here.boiler = False   # never closed: it cannot hold the rest of the page
        stack.append(here)
    flush()
    return out


def _score(b: Block, article: str, stops: Set[str]) -> int:
    """What the features of a block say for it (first pass)."""
    score = 0
    if article:
        score += PLACE if b.inside == article else -PLACE
    size = len(b.text)
    if size >= SHORT:
        words = _word.findall(b.text.lower())
        share = sum(w in stops for w in words) / max(1, len(words))
        score += 1 if share >= MANY_STOPS else -1 if share < FEW_STOPS else 0
    return score + (size > LONG)


def _decide(b: Block, article: str, stops: Set[str]) -> str:
    """First pass: good, bad, or ambiguous (short, near)."""
    linked = b.linked / max(1, len(b.text.replace(" ", "")))
    if b.boiler or linked > (MAX_LINKS_INSIDE if article and b.inside == article else MAX_LINKS):
        return "bad"
    score = _score(b, article, stops)
    if len(b.text) < SHORT:
        return "bad" if score <= BAD else "short"
    return "good" if score >= GOOD else "bad" if score <= BAD else "near"


def classify(page: str, stops: Set[str] = STOPS) -> list[Block]:
    """The blocks of a page, each labelled good or bad."""
    found = blocks(page)
    kinds = {b.inside for b in found if not b.boiler}
    article = "article" if "article" in kinds else "main" if "main" in kinds else ""
    first = [_decide(b, article, stops) for b in found]
    # decided neighbours before and behind: not those that lie in boilerplate elements,
    # which say nothing of what is beside them; in a marked article those of the article
    heard = [label in ("good", "bad") and not b.boiler and (not article or b.inside == article) for b, label in zip(found, first)]
    before, behind, last = [-1] * len(found), [-1] * len(found), -1
    for i in range(len(found)):
        before[i], last = last, i if heard[i] else last
    last = -1
    for i in reversed(range(len(found))):
        behind[i], last = last, i if heard[i] else last
    upto = [0, *accumulate(len(b.text) for b in found)]
    for i, (b, label) in enumerate(zip(found, first)):
        b.label = label
        if label in ("good", "bad"):
            continue
        near = [j for j in (before[i], behind[i]) if j >= 0]
        if b.heading and behind[i] >= 0:
            b.label = first[behind[i]]
        elif not near:
            b.label = "good"   # nothing on the page speaks against it
        elif len({first[j] for j in near}) == 1:
            b.label = first[near[0]]
        else:
            ahead, after = upto[i] - upto[near[0] + 1], upto[near[1]] - upto[i + 1]
            b.label = first[near[0]] if ahead < after else first[near[1]] if after < ahead else "good" if article or label == "near" else "bad"
    return found


def learn_stops(df: DataFrame, html_col: str = "html", words: int = STOP_WORDS, pages: float = STOP_PAGES) -> frozenset[str]:
    """Stop words of a table of pages: of the words that at least the share
    ``pages`` of them hold the ``words`` most widespread (so many reach the
    driver), and the fixed list. Pages are counted whole, markup aside."""
    text = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), r"(?is)<(script|style)\b.*?(</\1[^>]*>|\z)|<!--.*?(-->|\z)|<[^>]*>|&#?\w+;", " ")
    held = F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), " "))
    n = df.count()
    counts = df.select(F.explode(held).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= max(2, math.ceil(pages * n))).orderBy(F.col("n").desc(), "word").limit(words)
    return STOPS | {r["word"] for r in top.collect()}


def main_text(page: str | None, stops: Set[str] = STOPS) -> str:
    return "\n".join(b.text for b in classify(page or "", stops) if b.label == "good")


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text", stops: Set[str] | None = None) -> DataFrame:
    """Add ``text_col``: the main text of the whole page. ``stops`` are learnt
    from ``df`` if not given."""
    stops = learn_stops(df, html_col) if stops is None else stops

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(p.as_py(), stops) for p in pages], pa.string())

    return df.withColumn(text_col, text(F.col(html_col)))
