"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Closed-class words of the four languages of the pages.
STOP_WORDS = frozenset("""
a an and are as at be by for from has he in is it its of on or she that the they this to was were will with
au aux avec ce cette dans de des du elle en est et il la le les leur mais ne ou par pas pour qui que se son sur un une
aber als auch auf aus bei das dem den der des die ein eine er es für ihr im in ist mit nicht sich sie sind und von war zu
como con del el ella en es esta la las lo los más no para pero por que se sin su un una y
""".split())

# Elements by what they mean for blocks.
BLOCK_TAGS = frozenset("""
address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section
summary table tbody td tfoot th thead title tr ul
""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea title iframe object svg annotation annotation-xml canvas xmp noembed noframes".split())
INLINE_RAW = frozenset("svg annotation annotation-xml".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog button select datalist search fieldset head".split())
MAIN_TAGS = frozenset("article main".split())
NEVER_BAD = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_NAMES = frozenset("""
ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination
popup promo promoted promotion related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar
""".split())
# Names that are also words of an article, or of its own parts; and those that, as a class of their own, never are.
AMBIGUOUS = frozenset("""
banner comment cookie cookies header login menu navigation notice notices overlay promotion related share sharing skip social
""".split())
SURE_NAMES = frozenset("ad ads advert adverts advertisement advertising comments disqus sponsored".split())
# Names of parts of an article that are no text of it, unless they hold the most of it; of articles beside the main one;
# and what follows "comment" in the name of a place for comments.
PART_NAMES = frozenset("newsletter notice notices promo promoted promotion sidebar signup subscribe".split())
OTHER_ARTICLES = frozenset("ad ads advert advertisement comment comments promo promoted related sponsored".split())
COMMENT_PLACES = frozenset("area box form list section thread".split())
OWN_NAMES = frozenset("header notice notices".split())  # of parts of an article itself
LAYOUT_NAMES = frozenset("has no with without".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())

SHORT = 70  # characters below which a block cannot decide for itself
LINKED = 0.5  # share of linked characters from which a block is a menu
RICH, POOR = 0.15, 0.05  # stop-word shares that show running text outside an article, and anywhere else

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
      |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']|"[^"]*+"|'[^']*+')*+)>
      |<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
_NAMING = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD_BREAK = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    boilerplate: bool  # inside a menu, footer, advert ...
    main: bool  # inside the article
    suspect: int = -1  # the innermost element that its name alone makes boilerplate only on evidence
    label: str = ""  # good, bad, short or unsure
    prose: bool = False  # a heading or paragraph of the article


@dataclass
class Suspect:
    """What an element holds, whose name is that of boilerplate but may be that of a part of the article."""

    outer: int
    kind: str  # evidence beside links: few characters (short), or less than half of the text (part)
    chars: int = 0
    linked: int = 0
    heading: bool = False


def _verdict(tag: str, attrs: str, main: bool) -> str | None:
    """What the names of an element make of it: ``bad``, ``linked``, ``short`` or ``part`` (bad if so), or nothing.

    A class that is the name of boilerplate is bad, and outside the article also a class or id that ends
    in one (user-comments), unless that is an ordinary word; other parts of names need evidence. Inside
    the article only whole classes, adverts (ad-slot) and places for comments (comment-list) count, and but
    for the surest they need evidence; so do only the surest for headings and paragraphs. An article of
    its own class (related) is a part too.
    """
    if not attrs or "=" not in attrs or tag in NEVER_BAD and tag != "article":
        return None
    if tag == "article":
        classes = (a or b or c for key, a, b, c in _NAMING.findall(attrs) if key.lower() == "class")
        return "part" if any(x in OTHER_ARTICLES for value in classes for x in value.lower().split()) else None
    found = None
    for key, a, b, c in _NAMING.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "role" and value in BAD_ROLES or key == "aria-hidden" and value == "true":
            return "bad"
        if key not in ("class", "id"):
            continue
        for token in value.split():
            parts = [x for x in _WORD_BREAK.split(token) if x]
            block = tag in BLOCK_TAGS and tag != "p" and tag not in HEADINGS
            if main and block and parts and LAYOUT_NAMES.isdisjoint(parts):
                place = parts[0] == "comment" and len(parts) == 2 and parts[1] in COMMENT_PLACES
                if place or "comments" in (parts[0], parts[-1]) or token == "commentlist":
                    return "bad"
                if len(parts) > 1 and parts[0] in ("ad", "ads", "advert") or key == "class" and token in PART_NAMES:
                    found = "part"
                    continue
            bad = [x for x in parts if x in BAD_NAMES]
            if not bad or not LAYOUT_NAMES.isdisjoint(parts):
                continue
            whole = len(parts) == 1
            if whole and key == "class" and token in SURE_NAMES:
                return "bad"
            if tag == "p" or tag in HEADINGS:
                continue
            if main:
                if whole and key == "class" and token not in OWN_NAMES and tag in BLOCK_TAGS:
                    found = found or "linked"
            elif parts[-1] in BAD_NAMES and (parts[-1] not in AMBIGUOUS or tag in BLOCK_TAGS and len(bad) == len(parts)):
                return "bad"
            elif tag in BLOCK_TAGS:
                found = "short"
    return found


def blocks_of(page: str) -> list[Block]:
    """Blocks of text between block-level tags, in page order. Unclosed tags end where HTML ends them."""
    suspects: list[Suspect] = []
    blocks = list(_blocks(page, suspects))
    for b in blocks:
        if b.suspect >= 0:
            suspects[b.suspect].chars += len(b.text)
            suspects[b.suspect].linked += b.linked
    for x in reversed(suspects):  # inner ones come after outer ones
        if x.outer >= 0:
            suspects[x.outer].chars += x.chars
            suspects[x.outer].linked += x.linked
            suspects[x.outer].heading |= x.heading
    total = sum(len(b.text) for b in blocks if not b.boilerplate)
    confirmed: list[bool] = []
    for x in suspects:
        minor = 2 * x.chars < total
        few = x.kind == "short" and not x.heading and x.chars < SHORT
        confirmed.append(minor and (few or x.kind == "part") or x.linked > 0 and x.linked >= LINKED * x.chars or x.outer >= 0 and confirmed[x.outer])
    for b in blocks:
        b.boilerplate |= b.suspect >= 0 and confirmed[b.suspect]
    return blocks


def _blocks(page: str, suspects: list[Suspect]) -> Iterator[Block]:
    stack: list[tuple[str, bool, bool, int]] = []  # tag, boilerplate, main, suspect: each with what it inherits
    parts: list[str] = []
    linked, in_link = 0, 0
    at, size = 0, len(page)
    muted = -1  # place on the stack of an inline element (a button, an advert) whose text is left out of its block

    def state() -> tuple[bool, bool, int]:
        return stack[-1][1:] if stack else (False, False, -1)

    def flush() -> Iterator[Block]:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            around = stack if muted < 0 else stack[:muted]
            tag, bad, main, suspect = around[-1] if around else ("", False, False, -1)
            yield Block(text, min(linked, len(text)), bad, main, suspect, prose=main and (tag == "p" or tag in HEADINGS))
        parts.clear()
        linked = 0

    def take(piece: str) -> None:
        nonlocal linked
        if piece and muted < 0:
            parts.append(piece)
            if in_link:
                linked += len(" ".join(html.unescape(piece).split()))

    while at < size:
        found = _MARKUP.search(page, at)
        if found is None:
            take(page[at:])
            break
        take(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA["):
                take(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        closing = bool(found["end"] or found["end2"])
        attrs = found["attrs"] or found["attrs2"] or ""
        if tag == "br":
            take("\n")
            continue
        if muted < 0 and (tag in BLOCK_TAGS or tag in RAW_TAGS and tag not in INLINE_RAW):
            yield from flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if i < muted:  # the element around it ends
                        yield from flush()
                    del stack[i:]
                    muted = muted if muted < i else -1
                    break
                if stack[i][0] in MAIN_TAGS and tag not in ("html", "body"):
                    break  # a stray end tag inside the article does not end it
            if tag == "a":
                in_link = 0
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size if tag in ("script", "style") else at
            continue
        if tag in VOID_TAGS or attrs.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag == "a":
            in_link = 1
            continue
        if tag in BLOCK_TAGS:
            if stack and stack[-1][0] == "p" or stack and stack[-1][0] == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                stack.pop()
            in_link = 0
        bad, main, suspect = state()
        if suspect >= 0 and tag in HEADINGS:
            suspects[suspect].heading = True
        verdict = None if bad else _verdict(tag, attrs, main)
        here = bad or tag in BAD_TAGS or tag == "header" and not main or verdict == "bad"
        if verdict and not here:
            suspects.append(Suspect(suspect, verdict))
            suspect = len(suspects) - 1
        if tag in BLOCK_TAGS or here != bad:  # other inline elements change nothing
            if here != bad and tag not in BLOCK_TAGS:
                muted = len(stack)
            stack.append((tag, here, main or tag in MAIN_TAGS, suspect))
    yield from flush()


def _stops(text: str) -> tuple[int, int]:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words), max(1, len(words))


def classify(blocks: list[Block]) -> None:
    """First pass: what a block shows by itself. Second pass: undecided ones follow decided neighbours.

    By itself, a block is bad inside boilerplate or when mostly links; headings and paragraphs of the article
    may be links. Else short ones are undecided, and
    long ones are good by their stop words, or undecided too. A page whose long texts together hold
    hardly any is in a language without a list: there, long ones are good.

    ``<article>`` and ``<main>`` are a hint, followed where they hold as much text as the running text
    outside them (a teaser card does not): then a long block outside needs more stop words, and a short
    one outside a good neighbour outside.

    Undecided blocks take the label of the nearest decided block in the same part of the page, long ones
    only of one outside boilerplate; good where the two sides tie. With none, they are good inside an
    article; outside it bad; on a page without one, long ones are good, and short ones when no block of
    the page is good.
    """
    free = [not b.boilerplate and (b.prose or b.linked < LINKED * len(b.text)) for b in blocks]
    stops = [_stops(b.text) if f and len(b.text) >= SHORT else (0, 0) for b, f in zip(blocks, free)]
    known = sum(n for n, _ in stops) >= POOR * sum(words for _, words in stops)
    rich = [words > 0 and (not known or n >= RICH * words) for n, words in stops]
    inside = sum(len(b.text) for b, f in zip(blocks, free) if f and b.main)
    marked = 0 < inside >= sum(len(b.text) for b, r in zip(blocks, rich) if r and not b.main)
    regions = [marked and b.main and not b.boilerplate for b in blocks]
    for i, b in enumerate(blocks):
        n, words = stops[i]
        if not free[i]:
            b.label = "bad"
        elif len(b.text) < SHORT:
            b.label = "short"
        elif rich[i] or n >= POOR * words and (regions[i] or not marked):
            b.label = "good"
        else:
            b.label = "unsure"
    before = _nearest(blocks, regions, range(len(blocks)))
    after = _nearest(blocks, regions, range(len(blocks) - 1, -1, -1))
    any_good = any(b.label == "good" for b in blocks)
    for i, b in enumerate(blocks):
        if b.label not in ("short", "unsure"):
            continue
        (d1, l1), (d2, l2) = before[i], after[i]
        if l1 is None and l2 is None:
            alone = not marked and (b.label == "unsure" or not any_good)
            b.label = "good" if regions[i] or alone else "bad"
        elif d1 == d2:
            b.label = "good" if "good" in (l1, l2) else "bad"
        else:
            b.label = l1 if d1 < d2 else l2


def _nearest(blocks: list[Block], regions: list[bool], order: range) -> list[tuple[float, str | None]]:
    found: list[tuple[float, str | None]] = [(float("inf"), None)] * len(blocks)
    last: dict[tuple[bool, str], tuple[int, str]] = {}  # by region and kind of block that asks
    for i in order:
        label, region = blocks[i].label, regions[i]
        if label == "bad" and region:
            continue  # a list of links inside the article says nothing of the paragraph beside it
        if label not in ("short", "unsure"):
            last[region, "short"] = (i, label)
            if not blocks[i].boilerplate:
                last[region, "unsure"] = (i, label)
        elif (region, label) in last:
            at, near = last[region, label]
            found[i] = (abs(i - at), near)
    return found


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    classify(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def main_text_column(page: Column) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return extract(page)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of text) of every row of ``pages`` (page_id, url, html).

    Defined cases: NULL or empty html, and html without article text, give an empty text; a tag cut off
    at the end of the page is markup; a page of any length is read whole; repeated rows are extracted
    each; an empty table gives no rows; further columns are ignored.
    """
    return pages.select("page_id", "url", main_text_column(F.col("html")).alias("text")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
