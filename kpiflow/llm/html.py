"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Each block has its words, its stop-word
density (share of its words in the function-word lists), its link density (share
of characters inside links) and the containers it stands in.

Pass 1 decides what can be decided: blocks in containers that are no article text by
tag, role, class or id (menus, headers, footers, sidebars, notices, adverts, forms,
comments) are boilerplate, except a container dropped by class or id that holds more than
``WRAPPER`` of the page's unlinked text; link-dense blocks and long blocks without stop words are
boilerplate, long blocks with stop words are text, and the rest is ambiguous. An
``article`` (else ``main``) is one more feature, on pages where it holds most of the long
blocks' text (of all text, where no block is long), so teaser cards do not count as the
article: inside, more links are allowed, headings may be links, and a long block without stop words is
ambiguous; outside, a long block needs the higher stop-word density and a middling
one is ambiguous, and short blocks are boilerplate. Where long varied blocks without stop
words outweigh the text with them, the page is in a language that the lists do not
know: these blocks are text then (ambiguous outside the marked article).

Pass 2 gives each ambiguous block the label of the nearest decided block
outside such containers and on its side of the marked article, if there is one; at
equal distance text wins; without any, it is text.

Whole pages are read. Defined results: null, empty or tag-only html gives the empty
text; broken markup (unclosed, stray or cut tags, comments and quotes) is read as far
as it goes; an unclosed script or style runs to the end of the page; rows that
repeat are extracted alike; null ids and urls are kept; an empty table gives an empty
result. Only the columns named are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINK_DENSE, LINK_DENSE_INSIDE = 0.35, 0.6
SHORT, LONG = 60, 160
STOPS_LOW, STOPS_HIGH = 0.1, 0.2

# Function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to a in is that it for on was with as are be by this or from at an not have which but they his her you we".split()
    + "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei".split()
    + "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux elle".split()
    + "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ha o este".split()
)

# Tags that hold no article text, with all they contain.
DROP_TAGS = frozenset("nav header footer aside form button select option textarea noscript template svg iframe object canvas head menu dialog".split())
RAW_TAGS = frozenset("script style title textarea xmp noembed noframes".split())
SELF_CLOSING = frozenset("p li tr td th dt dd option".split())  # one ends the open one of its kind
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
# Class and id names that mark such containers: alone, as the last word of a compound without one of STATES, or as
# its first word when all others are in PARTS. Words are runs of letters.
DROP_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices"
    " alert popup modal overlay paywall newsletter subscribe subscription signup login menu nav navbar navigation breadcrumb breadcrumbs pagination"
    " pager footer header masthead sidebar aside widget related recommended recommendations share sharing social comment comments respond disqus"
    " reply replies toolbar topbar skip".split()
)

STATES = frozenset("has have no not non with without is hide hides hidden show shows toggle before after under beside content layout".split())
PARTS = frozenset(
    "area banner bar block body bottom box button buttons container content col column form group holder inner item items left link links list"
    " main menu outer panel post posts primary right row secondary section slot stories story top unit wrap wrapper widget widgets x".split()
)
# Often longer than the article, so never taken for a wrapper of the page.
COMMENTS = frozenset("comment comments respond disqus reply replies".split())
#: Share of the page's unlinked text from which a container named so is a wrapper of the page, whatever its name.
WRAPPER = 0.75

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[a-z]+")
_STRIP = ".,;:!?()[]\"'*%$#&|«»“”…-"
_NO_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*none")


@dataclass
class Block:
    text: str
    tag: str
    dropped: bool
    article: bool
    main: bool
    link_chars: int
    label: str | None = None

    @cached_property
    def link_density(self) -> float:
        return min(1.0, self.link_chars / max(1, len(self.text)))

    @cached_property
    def stop_density(self) -> float:
        words = self.text.lower().split()
        return sum(w.strip(_STRIP) in STOP_WORDS for w in words) / max(1, len(words))


def _named(token: str) -> bool:
    """Whether a class or id name marks a container without article text."""
    words = _NAME.findall(token)
    if len(words) < 2:
        return bool(words) and words[0] in DROP_NAMES
    if words[-1] in DROP_NAMES and STATES.isdisjoint(words[:-1]):
        return True
    return words[0] in DROP_NAMES and PARTS.issuperset(words[1:])


def _drops(tag: str, attrs: str) -> str:
    """Why the element holds no article text: ``sure`` (tag, role, hidden, readers' comments), ``name`` (class or id), or the empty text."""
    if tag in DROP_TAGS:
        return "sure"
    if tag in ("body", "html", "article", "main") and "role" not in attrs and "comment" not in attrs:
        return ""
    why = ""
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in DROP_ROLES:
            return "sure"
        if tag not in ("input", "html", "body") and (name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _NO_DISPLAY.search(value))):
            return "sure"
        if name in ("class", "id") and any(_named(t) for t in value.split()):
            why = "sure" if why == "sure" or not COMMENTS.isdisjoint(_NAME.findall(value)) else "name"
    return why


def _drop_named(found: list[Block], spans: list[tuple[int, int]]) -> None:
    """Marks the blocks of containers dropped by name, but not of those that hold most of the page's unlinked text."""
    upto, articles = [0], [0]
    for b in found:
        articles.append(articles[-1] + (not b.dropped and (b.article or b.main)))
        upto.append(upto[-1] + (0 if b.dropped else max(0, len(b.text) - b.link_chars)))
    steps = [0] * (len(found) + 1)
    for lo, hi in spans:
        size, outside = upto[hi] - upto[lo], articles[-1] - (articles[hi] - articles[lo])
        if size <= WRAPPER * upto[-1] or (size < LONG and outside):  # an advert may be longer than a short article
            steps[lo] += 1
            steps[hi] -= 1
    depth = 0
    for b, step in zip(found, steps):
        depth += step
        b.dropped = b.dropped or depth > 0


def blocks(html: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, bool, int, str]] = []  # open tag, whether it surely drops what it holds, first block if it drops by name (else -1), block tag around it
    named: list[tuple[int, int]] = []  # blocks from, to of containers that drop by name
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    link_chars, in_link, at, own = 0, 0, 0, "body"
    drop_depth = article_depth = main_depth = 0
    pending = False  # whether the open block has text

    def close_block():
        nonlocal link_chars, pending
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append(Block(text, own, drop_depth > 0, article_depth > 0, main_depth > 0, link_chars))
        parts.clear()
        link_chars, pending = 0, False

    def leave(k: int):
        """Ends the open tags from place k on."""
        nonlocal drop_depth, article_depth, main_depth, in_link, own
        for t, d, lo, _ in stack[k:]:
            if 0 <= lo < len(out):
                named.append((lo, len(out)))
            open_tags[t] -= 1
            drop_depth -= d
            article_depth -= t == "article"
            main_depth -= t == "main"
            in_link -= t == "a"
        own = stack[k][3]
        del stack[k:]

    while True:
        m = _TAG.search(html, at)
        data = html[at : m.start() if m else len(html)]
        if data:
            parts.append(data)
            pending = pending or bool((unescape(data) if "&" in data else data).strip())
            if in_link:
                link_chars += len(" ".join(unescape(data).split()))
        if m is None:
            break
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close_block()
        if not closing:
            if tag in RAW_TAGS:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag in VOID_TAGS or attrs.endswith("/"):
                continue
            if tag in SELF_CLOSING:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK_TAGS), None)
                if k is not None and stack[k][0] == tag:
                    leave(k)
            if tag == "a":
                in_link += 1
            d = _drops(tag, attrs)
            drop_depth += d == "sure"
            article_depth += tag == "article"
            main_depth += tag == "main"
            # text before an inline element in the same block is not in it
            stack.append((tag, d == "sure", len(out) + pending if d == "name" else -1, own))
            open_tags[tag] += 1
            if tag in BLOCK_TAGS:
                own = tag
        elif open_tags[tag]:
            leave(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
    close_block()
    if stack:
        leave(0)
    _drop_named(out, named)
    return out


def _marked(found: list[Block]) -> str | None:
    """The tag that marks the article of the page: it holds most of the long blocks' text."""
    free = [b for b in found if not b.dropped and b.link_density <= LINK_DENSE_INSIDE]
    free = [b for b in free if len(b.text) >= LONG] or free
    total = sum(len(b.text) for b in free)
    for tag in ("article", "main"):
        if 2 * sum(len(b.text) for b in free if getattr(b, tag)) > total:
            return tag
    return None


def _unlisted(b: Block) -> bool:
    """A long block that may be prose of a language without stop words here."""
    if b.dropped or len(b.text) < LONG or b.stop_density >= STOPS_LOW or b.link_density > LINK_DENSE:
        return False
    words = b.text.lower().split()
    return len(set(words)) >= min(0.25 * len(words), 50)


def _first_pass(b: Block, inside: bool | None, listed: bool) -> str | None:
    """The label of a block by its own features; ``inside`` the marked article, outside it, or None without one; ``listed``: the page's language has stop words."""
    if b.dropped:
        return "boilerplate"
    if b.link_density > (LINK_DENSE_INSIDE if inside else LINK_DENSE):
        return None if inside and b.tag in HEADINGS else "boilerplate"
    if len(b.text) >= LONG:
        if b.stop_density >= (STOPS_HIGH if inside is False else STOPS_LOW):
            return "text"
        if not listed and _unlisted(b):
            return None if inside is False else "text"
        return "boilerplate" if b.stop_density < STOPS_LOW and not inside else None
    if len(b.text) >= SHORT and b.stop_density >= STOPS_HIGH:
        return None if inside is False else "text"
    return "boilerplate" if inside is False else None


def classify(found: list[Block]) -> list[Block]:
    """Sets the label, ``text`` or ``boilerplate``, of each block."""
    marked = _marked(found)
    known = sum(len(b.text) for b in found if not b.dropped and len(b.text) >= SHORT and b.stop_density >= STOPS_LOW and b.link_density <= LINK_DENSE)
    listed = known >= sum(len(b.text) for b in found if _unlisted(b))
    for b in found:
        b.label = _first_pass(b, getattr(b, marked) if marked else None, listed)
    before, after = {}, {}
    side = [bool(marked and getattr(b, marked)) for b in found]
    for order, near in ((range(len(found)), before), (range(len(found) - 1, -1, -1), after)):
        last: dict[bool, int] = {}
        for i in order:
            if found[i].label is None:
                near[i] = last.get(side[i])
            elif not found[i].dropped:
                last[side[i]] = i
    for i in before:
        sides = [(abs(i - j), found[j].label != "text") for j in (before[i], after[i]) if j is not None]
        found[i].label = "boilerplate" if sides and min(sides)[1] else "text"
    return found


def main_text(html: str | None) -> str:
    return "\n".join(b.text for b in classify(blocks(html or "")) if b.label == "text")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    ids, url = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return rows.mapInArrow(_extract, f"page_id {ids}, url {url}, text string, n_chars bigint")
