"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags; scripts, styles and comments in
the markup are skipped. Pass one classifies each block by the density of its
links, its length and the density of stop words: good, bad, near (likely good)
or short (undecided). Pass two gives near and short blocks the label of the
nearest decided neighbours.

Markup narrows the question down first. Blocks under menus, forms, page headers,
footers, sidebars, adverts, notices and reader comments, told by tag, role or
class, are bad. If the page marks an article or main part, only its blocks can
be good; both passes label them, but inside it a lack of stop words makes no block
bad, nor do links a heading, and an undecided block goes only between bad ones. A main element overrides bad names of the elements around it; an
article does so where the page has no other paragraph in its main part, as
teasers and comments are articles too. Stop words count only on pages where some
block has many of them; on others, such as those in further languages, length
decides.

A name that a wrapper of the whole text may have too, such as "notice", counts only
where the page has some good block without it.

Defined cases: a null or empty page, and a page without a good block, give the
empty text. Unclosed and misnested tags close with the tag that encloses them.
Repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.llm.common import whole

STOP_WORDS = frozenset(
    """a an and are as at be by for from has have in is it not of on or that the they this to was were which with
    au aux avec ce dans de des du elle en est et il je la le les ne nous ou par pas pour qui que se sur un une vous
    aber als am auch auf aus bei das dem den der die ein eine einen er es für im ist mit nicht sich sie und von zu
    al como con del el esta lo los mas no para pero por sin su una y""".split())

LINKS_MOST = 0.5
SHORT_BELOW = 70
LONG_FROM = 200
STOPS_LOW, STOPS_HIGH = 0.15, 0.30

_SKIPPED = frozenset("script style noscript template textarea svg math iframe object select head title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    """a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong
    sub sup time tt u var""".split())
_BAD_TAGS = frozenset("nav footer aside form button dialog menu".split())
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_BAD_NAMES = frozenset(
    """ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent
    gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    sidebar widget related recommended recommendations menu nav navbar navigation breadcrumb breadcrumbs footer
    comment comments disqus replies respond discussion pagination pager toolbar""".split())
#: names that a wrapper of the whole text may have as well
_SOFT_NAMES = frozenset(
    """notice alert banner share sharing social widget promo promotion signup login subscription related toolbar""".split())
_HEADER_NAMES = frozenset("header masthead topbar".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAMES = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    parts: list = field(default_factory=list)
    link_chars: int = 0
    bad: bool = False
    hard: bool = False  # bad even where names that a wrapper may have do not count
    eased: bool = False  # bad if an article overrides names around it
    inside: bool = False
    heading: bool = False
    text: str = ""


def _mark(tag: str, attributes: str, inside: bool) -> str:
    """How an element is marked as bad: sure, by a name only, by a soft name only, or not at all (empty)."""
    if tag in _BAD_TAGS or (tag == "header" and not inside):
        return "sure"
    found = ""
    if not attributes:
        return found
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "sure"
        if name == "role" and value in _BAD_ROLES:
            return "sure"
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            names = set(_NAMES.findall(value))
            if names & _BAD_NAMES or (not inside and names & _HEADER_NAMES):
                soft = found != "name" and not names & (_BAD_NAMES | _HEADER_NAMES) - _SOFT_NAMES
                found = "soft" if soft else "name"
    return found


def blocks_of(html: str) -> tuple[list[Block], bool]:
    """Blocks with text in page order, and whether the page marks a main part."""
    out: list[Block] = []
    # tag; under something surely bad, a bad name, one that no article overrides, a name that is not soft;
    # inside the main part, an article
    stack: list[tuple[str, bool, bool, bool, bool, bool, bool]] = []
    #: places of each open tag in the stack, so that a closing tag finds its own at once
    places: dict[str, list[int]] = {}
    nothing = (False,) * 6
    block, links, marked = Block(), 0, False
    at, end = 0, len(html)

    def close():
        nonlocal block
        if block.parts:
            out.append(block)
        sure, named, eased, hard, inside, _ = stack[-1][1:] if stack else nothing
        block = Block(bad=sure or named, hard=sure or hard, eased=sure or eased, inside=inside)

    def pop():
        places[stack.pop()[0]].pop()

    def add(raw: str):
        if raw:
            block.parts.append(raw)
            if links:
                block.link_chars += len(raw)

    while at < end:
        m = _TAG.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if tag in _SKIPPED and tag != "head":
            if not closing:
                stop = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else end
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            add("\n")
            continue
        if tag in _VOID and tag != "hr":
            continue
        if tag in _INLINE and not _mark(tag, attributes, True) and not any(s[0] == tag for s in stack[-1:]):
            continue
        if closing:
            if places.get(tag):
                for _ in range(len(stack) - places[tag][-1]):
                    pop()
        elif tag != "hr":
            if stack and stack[-1][0] == "p":
                pop()
            sure, named, eased, hard, inside, article = stack[-1][1:] if stack else nothing
            if tag == "main" and not inside:
                named = eased = hard = False
            if tag == "article" and not article:
                eased, article = False, True
            if tag in ("article", "main"):
                inside = marked = True
            mark = _mark(tag, attributes, inside)
            name = mark in ("name", "soft")
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, sure or mark == "sure", named or name, eased or name, hard or mark == "name", inside, article))
        links = 0
        close()
        block.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") and not closing
    close()
    kept = []
    for b in out:
        b.text = " ".join(unescape("".join(b.parts)).split())
        if b.text:
            kept.append(b)
    if not any(b.inside and not b.bad and not b.heading and len(b.text) >= SHORT_BELOW for b in kept):
        for b in kept:
            b.bad = b.eased
    return kept, marked


def _linked(b: Block) -> bool:
    return b.link_chars > LINKS_MOST * max(1, sum(map(len, b.parts)))


def _stops(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def in_known_language(blocks: list[Block]) -> bool:
    """Whether some paragraph has as many stop words as text in a known language."""
    return any(not b.bad and not b.heading and len(b.text) >= SHORT_BELOW and not _linked(b)
               and _stops(b.text) >= STOPS_HIGH for b in blocks)


def first_pass(b: Block, marked: bool, known: bool = True) -> str:
    """good, bad, near or short; ``known`` tells whether stop words say something here."""
    if b.bad or (marked and not b.inside):
        return "bad"
    size = len(b.text)
    if _linked(b) and not (marked and b.heading):
        return "bad"
    if size < SHORT_BELOW or b.heading:
        return "short"
    stops = _stops(b.text)
    if stops >= STOPS_HIGH or not known:
        return "good" if size >= LONG_FROM else "near"
    return "near" if stops >= STOPS_LOW or marked else "bad"


def second_pass(labels: list[str], headings: list[bool], marked: bool) -> list[bool]:
    """Whether each block is kept, once undecided ones have looked at their neighbours.

    In a marked main part, whose blocks alone are asked there, the mark speaks for an
    undecided block: it goes only if its nearest decided neighbours on both sides are bad.
    """
    n = len(labels)
    before, after = [None] * n, [None] * n
    near_before, near_after = [False] * n, [False] * n
    for order, decided, near in ((range(n), before, near_before), (range(n - 1, -1, -1), after, near_after)):
        last, passed = None, False
        for i in order:
            decided[i], near[i] = last, passed
            if labels[i] in ("good", "bad"):
                last, passed = labels[i], False
            elif labels[i] == "near":
                passed = True
    kept = []
    for i, label in enumerate(labels):
        if label in ("good", "bad"):
            kept.append(label == "good")
        elif marked:
            kept.append(not before[i] == after[i] == "bad")
        elif label == "near":
            kept.append("good" in (before[i], after[i]) or before[i] is None and after[i] is None
                        or before[i] != after[i])
        elif headings[i]:
            kept.append(after[i] == "good" or near_after[i])
        else:
            good = (before[i] == "good" or near_before[i], after[i] == "good" or near_after[i])
            kept.append(all(good))
    return kept


def main_text(html: str) -> str:
    blocks, marked = blocks_of(html)
    keep = labelled(blocks, marked)
    if not any(keep) and not marked:
        for b in blocks:
            b.bad = b.hard
        keep = labelled(blocks, marked)
    return " ".join(b.text for b, k in zip(blocks, keep) if k)


def passes(blocks: list[Block], marked: bool) -> tuple[list[str], list[bool]]:
    """Both passes: the first one's label of each block, and whether it is kept.

    What the markup leaves out is no neighbour in a marked main part: an advert between
    two short paragraphs says nothing about them.
    """
    known = marked or in_known_language(blocks)
    asked = [i for i, b in enumerate(blocks) if not marked or b.inside and not b.bad]
    found = [first_pass(blocks[i], marked, known) for i in asked]
    stay = second_pass(found, [blocks[i].heading for i in asked], marked)
    labels, keep = ["bad"] * len(blocks), [False] * len(blocks)
    for i, label, k in zip(asked, found, stay):
        labels[i], keep[i] = label, k
    return labels, keep


def labelled(blocks: list[Block], marked: bool) -> list[bool]:
    """Whether each block is kept."""
    return passes(blocks, marked)[1]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row; no shuffle."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), whole(html).alias("_html"),
    ).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
