"""Main text of web pages by two passes over their blocks.

First pass: blocks in menus, headers, footers, sidebars, notices, adverts, forms and comments go,
as do blocks made of links. Of the others, a block with enough words and a fair share of stop
words is text; one with enough words and hardly a stop word is not, unless the whole page has
hardly any. Second pass: short blocks take the label of the nearest decided block, text if two
are equally near and differ, and all of them are text if no block is. Where a page marks its article, what stands outside is not text and
what stands inside is, but for the kinds above.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.ship import ship

STOP_WORDS = frozenset(
    # Common words of English, German, French, Spanish, Italian and Portuguese.
    "the of and to in a is that it for was on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has her two him see no could than been who its now did get may "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde dem im "
    "le la les de des un une et est que qui dans en du pour pas sur au avec ce il elle ne se plus par son sa ses aux mais ou nous vous leur été être cette ces comme tout "
    "el los las y del que en por con para una su al lo como más pero sus sin sobre este ya entre cuando todo esta ser son dos también fue había era muy hasta desde "
    "il di che è per non si da sono con lo gli una nel alla della dei "
    "o os um uma não no na do da dos das ao pelo".split()
)
SKIPPED = frozenset("script style template noscript svg math iframe object canvas audio video textarea title select option head".split())
RAW = frozenset("script style textarea title noscript iframe".split())
AWAY = frozenset("nav footer aside form menu dialog button fieldset label input".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
AWAY_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer masthead toolbar comment comments commentlist reply replies disqus respond related share sharing social widget copyright login signup search pagination pager skip".split()
)
#: Away for good: an article element in such a part is a reader's.
READERS = frozenset("comment comments commentlist reply replies disqus respond related".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PART = re.compile(r"[\s_-]+")


@dataclass(frozen=True)
class BlockRules:
    """Words from which a block is decided by its stop words, shares of stop words above which
    it is text and below which it is not, and the share of linked characters that is too much."""

    words: int = 10
    text_share: float = 0.15
    other_share: float = 0.05
    links: float = 0.5


@dataclass
class Block:
    text: str
    linked: int
    away: bool
    inside: bool


def _names(attributes: str) -> tuple[bool, bool]:
    """Whether an element is away from the article, by its role, class or id; and for good."""
    away = readers = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() in ("class", "id"):
            parts = set(_PART.split(value))
            away |= not parts.isdisjoint(AWAY_NAMES)
            readers |= not parts.isdisjoint(READERS)
        elif name.lower() == "role":
            away |= value in AWAY_ROLES
    return away, readers


def blocks(html: str) -> list[Block]:
    """The blocks of a page with text, in order. Broken markup is read as far as it goes."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, away, skipped, away for good
    away = skipped = links = inside = for_good = 0
    parts: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, away > 0, inside > 0))
            parts.clear()
        linked = 0

    def close(down_to: int) -> None:
        nonlocal away, skipped, links, inside, for_good
        while len(stack) > down_to:
            tag, a, s, r = stack.pop()
            away -= a
            for_good -= r
            skipped -= s
            links -= tag == "a"
            inside -= tag in ("article", "main")

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not skipped:
            plain = unescape(piece)
            parts.append(plain)
            if links:
                linked += len(plain.strip())

    end = len(html)
    while at < end:
        found = _MARKUP.search(html, at)
        if found is None:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            if found[0].startswith("<![CDATA["):
                text(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in BLOCKS:
            for i in range(len(stack) - 1, max(len(stack) - 8, -1), -1):  # a block ends an open paragraph
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if tag in ("article", "main") or (tag == "body" and skipped):
            # An article begins anew, whatever was left open before it; a comment may be one too.
            if not (inside or for_good):
                away = skipped = links = 0
                stack[:] = [(t, False, False, False) for t, *_ in stack if t != "a"]
        if tag in VOID or attributes.rstrip().endswith("/"):
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}", re.I).search(html, at)
            at = stop.start() if stop else end
        named, readers = _names(attributes)
        gone = named or tag in AWAY or (tag == "header" and not inside)
        if tag in ("html", "body", "main") or (tag == "article" and not readers):
            gone = readers = False
        stack.append((tag, gone, tag in SKIPPED, readers))
        away += gone
        for_good += readers
        skipped += tag in SKIPPED
        links += tag == "a"
        inside += tag in ("article", "main")
    flush()
    return out


def _stop_words(text: str) -> tuple[int, int]:
    words = [w.strip(".,;:!?\"'()").lower() for w in text.split()]
    return len(words), sum(w in STOP_WORDS for w in words)


def main_text(html: str, rules: BlockRules = BlockRules()) -> str:
    """The blocks of the article, joined by line breaks; empty if there are none."""
    found = blocks(html)
    marked = any(b.inside and not b.away for b in found)
    counts = [_stop_words(b.text) for b in found]
    words = sum(n for (n, _), b in zip(counts, found) if not b.away)
    foreign = sum(s for (_, s), b in zip(counts, found) if not b.away) < rules.other_share * words
    labels: list[bool | None] = []
    for b, (n, stops) in zip(found, counts):
        share = stops / n if n else 0.0
        if b.away or (marked and not b.inside) or b.linked > rules.links * len(b.text):
            labels.append(False)
        elif marked:
            labels.append(True if n >= rules.words else None)
        elif n >= rules.words and (foreign or share >= rules.text_share):
            labels.append(True)
        elif n >= rules.words and share < rules.other_share:
            labels.append(False)
        else:
            labels.append(None)
    if marked:
        # The blocks of one article are neighbours of each other only.
        return "\n".join(b.text for b, label in zip(found, labels) if label is not False)
    if True not in labels:  # short blocks only: there is no text to tell them from
        labels = [label is None for label in labels]
    return "\n".join(b.text for b, label in zip(found, _inherited(labels)) if label)


def _inherited(labels: list[bool | None]) -> list[bool]:
    before: list[tuple[int, bool]] = []
    far = (len(labels) + 1, False)
    last = far
    for label in labels:
        last = (0, label) if label is not None else (last[0] + 1, last[1])
        before.append(last)
    last, out = far, []
    for label, prior in zip(reversed(labels), reversed(before)):
        last = (0, label) if label is not None else (last[0] + 1, last[1])
        out.append(prior[1] if prior[0] < last[0] else last[1] if last[0] < prior[0] else prior[1] or last[1])
    return out[::-1]


def _run(column: str, rules: BlockRules):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                names = [c for c in rows.schema.names if c != column]
                texts = [main_text(h or "", rules) for h in rows.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in names], pa.array(texts, pa.string())], [*names, "text"]
                )

    return run


def extract(pages: DataFrame, html: str = "html", rules: BlockRules = BlockRules()) -> DataFrame:
    """The pages with their html replaced by `text`. A null or empty page, or one without an
    article, has an empty text. A column already called `text` is replaced; all rows stay."""
    ship(pages.sparkSession)
    base = pages.drop("text") if html != "text" else pages
    return base.mapInArrow(_run(html, rules), base.drop(html).withColumn("text", F.lit("")).schema)
