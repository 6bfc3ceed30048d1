"""Main text of web pages by two passes over their blocks.

A page is cut at block-level tags. Navigation, forms and the like are out before anything is decided. In the first pass each
block, inside an article or not, is decided by its share of linked characters, by its length and by its share of stop words;
long prose without links needs no stop words, whatever its language; what cannot be told stays open. In the second pass an
open block takes the label of its nearest decided neighbours: that of both sides if they agree, otherwise the nearer one's, or
the earlier one's if both are as near. An open block inside an article is content unless it stands directly between two blocks
that are not; on a page without any block decided as content all open ones are content.

A class name or id is a hint only: where nothing else is left of a page, what such names alone had put out is judged like the rest.

Character references are decoded, white space inside a block becomes one space, and blocks are joined by one space. Broken
markup is read as far as it goes: unclosed elements end with their container, an unclosed script or comment takes the rest, a
tag whose quotes never close ends at its first ``>``, and one without any ``>`` is text. Time is linear in the page's length.

Defined results: a null or empty page gives an empty text; null keys, repeated rows and other columns are passed by;
pages of any length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import text_or_empty

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "le de la les et des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec "
    "el los y las del se con por su para al lo como más o pero sus".split()
)
#: Elements whose text is never content.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form select option button textarea iframe object svg canvas "
    "menu dialog audio video map".split()
)
_RAW = frozenset(("script", "style", "textarea", "title"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a block; others stay inside it.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
_HINTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"cookies?|consent|notice|popup|modal|newsletter|subscribe|comments?|comment-?list|replies|disqus|footer|site-?header|"
    r"masthead|share|sharing|social|related|recommend\w*|toolbar|login|search|pagination|pager|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s<>/]*)|[^<]+|<", re.DOTALL)
_STOP = re.compile(r"[>\"']")
_NAMED = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=/])", re.IGNORECASE)
_BLANKS = re.compile(r"\S+")
_SENTENCE = re.compile(r"[.!?…。！？।؟۔]")

MOST_LINKED, SHORT, LONG = 0.33, 70, 200
FEW_STOPS, MANY_STOPS = 0.15, 0.30
GOOD, BAD, OPEN = "good", "bad", "open"
#: The place of blocks that only a class name or id puts out.
HINTED = "hinted"


@dataclass
class Block:
    text: str
    linked: int
    place: str | None


class _TagEnds:
    """Where tags end: at the first ``>`` outside quotes. Each quote is followed once, however many tags run into it."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.seen, self.stop = 0, -1  # no stop lies from ``seen`` up to ``stop``
        self.dead: set[int] = set()  # quotes that open and lead to no end

    def _next_stop(self, at: int) -> int:
        if not self.seen <= at <= self.stop:
            found = _STOP.search(self.page, at)
            self.seen, self.stop = at, found.start() if found else len(self.page)
        return self.stop

    def end(self, at: int) -> int:
        """Place of the closing ``>`` of a tag whose name ends at ``at``, or -1."""
        if at > self.last:
            return -1
        page, path = self.page, []
        stop = self._next_stop(at)
        while stop < len(page) and page[stop] != ">":
            if stop in self.dead:
                stop = len(page)
                break
            path.append(stop)
            close = page.find(page[stop], stop + 1)
            found = _STOP.search(page, close + 1) if close >= 0 else None
            stop = found.start() if found else len(page)
        if stop < len(page):
            return stop
        self.dead.update(path)
        return page.find(">", at)


def _out_of_content(tag: str, attributes: str, in_article: bool) -> str | None:
    """``BAD`` for elements that are out by their kind, ``HINTED`` for those out by a class name or id alone."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return BAD
    if not attributes:
        return None
    if _HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)):
        return BAD
    hinted = None
    for name, *values in _NAMED.findall(attributes):
        value, name = "".join(values), name.lower()
        if name in ("class", "id") and tag not in ("body", "html", "article", "main") and _HINTS.search(value):
            hinted = HINTED
        if name == "role" and value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form"):
            return BAD
        if name == "aria-hidden" and value.lower() == "true":
            return BAD
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return BAD
    return hinted


def blocks_of(page: str) -> list[Block]:
    """The page's blocks that have text, in order, each with its linked characters and its place."""
    out: list[Block] = []
    parts: list[str] = []
    linked_parts: list[str] = []
    stack: list[tuple[str, str | None, bool]] = []  # element, how it drops its text, is an article
    depth: Counter[str] = Counter()  # open elements by name, by way of dropping, and articles
    links = 0

    def close() -> None:
        nonlocal parts, linked_parts
        words = _BLANKS.findall("".join(parts))
        if words:
            linked = sum(map(len, _BLANKS.findall(" ".join(linked_parts))))
            place = BAD if depth[BAD] else HINTED if depth[HINTED] else GOOD if depth["/article"] else None
            out.append(Block(" ".join(words), linked, place))
        parts, linked_parts = [], []

    def enter(tag: str, drops: str | None, article: bool) -> None:
        stack.append((tag, drops, article))
        depth.update((f"<{tag}", drops or "", "/article" if article else ""))

    def leave() -> str:
        tag, drops, article = stack.pop()
        depth.subtract((f"<{tag}", drops or "", "/article" if article else ""))
        return tag

    ends = _TagEnds(page)
    at, end = 0, len(page)
    while at < end:
        found = _PIECE.match(page, at)
        tag, closing, piece = found[2], found[1], found[0]
        attributes = ""
        at = found.end()
        if tag is not None:
            stop = ends.end(at)
            if stop < 0:
                tag = None  # no tag at all
            else:
                attributes, at = page[at:stop], stop + 1
        elif piece[0] == "<" and piece != "<":
            continue
        if tag is None:
            text = html.unescape(piece)
            parts.append(text)
            if links:
                linked_parts.append(text)
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in _BLOCKS and tag not in DROPPED:
            drops = None if closing or tag in _VOID else _out_of_content(tag, attributes, depth["/article"] > 0)
            if drops:
                close()
                enter(tag, drops, False)
            elif closing and stack and stack[-1][0] == tag:
                close()
                leave()
            continue
        close()
        if closing:
            links = 0
            if depth[f"<{tag}"]:
                while leave() != tag:
                    pass
            continue
        if tag in _RAW:
            # Nothing inside is markup up to the closing tag.
            done = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = done.end() if done else end
            continue
        if tag in _VOID or attributes.endswith("/"):
            continue
        if tag == "body":
            # An unclosed head ends here.
            stack.clear()
            depth.clear()
        drops = _out_of_content(tag, attributes, depth["/article"] > 0)
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and not drops:
            continue
        enter(tag, drops, tag in ("article", "main") and not depth[BAD] and not depth[HINTED])
    close()
    return out


def first_pass(block: Block) -> str:
    if block.place == BAD or block.linked > MOST_LINKED * len(block.text):
        return BAD
    if len(block.text) < SHORT:
        return BAD if block.linked and block.place is None else OPEN
    words = block.text.split()
    stops = sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words) / len(words)
    if stops >= MANY_STOPS or (stops >= FEW_STOPS and not block.linked):
        return GOOD
    if not block.linked:
        return GOOD if len(block.text) >= LONG and _SENTENCE.search(block.text) else OPEN
    return BAD if stops < FEW_STOPS and block.place is None else OPEN


def second_pass(labels: list[str], places: list[str | None] | None = None) -> list[str]:
    """Open blocks take their nearest decided neighbours' label, with their place as prior; where none is decided as
    content, all open ones are."""
    places = places or [None] * len(labels)
    alone = GOOD not in labels
    before: list[tuple[int, str] | None] = []
    last = None
    for i, label in enumerate(labels):
        last = (i, label) if label != OPEN else last
        before.append(last)
    out, after = list(labels), None
    for i in range(len(labels) - 1, -1, -1):
        if labels[i] != OPEN:
            after = (i, labels[i])
            continue
        if alone or places[i] == GOOD:
            enclosed = not alone and labels[max(i - 1, 0)] == BAD and labels[min(i + 1, len(labels) - 1)] == BAD
            out[i] = BAD if enclosed else GOOD
            continue
        left = before[i]
        near = min((x for x in (left, after) if x), key=lambda x: abs(x[0] - i), default=(0, GOOD))
        out[i] = near[1]
    return out


def main_text(page: str) -> str:
    kept = [b for b in blocks_of(page) if b.place != BAD]
    return _judged([b for b in kept if b.place != HINTED]) or _judged([Block(b.text, b.linked, None) for b in kept])


def _judged(blocks: list[Block]) -> str:
    labels = second_pass([first_pass(b) for b in blocks], [b.place for b in blocks])
    return " ".join(b.text for b, label in zip(blocks, labels, strict=True) if label == GOOD)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: ``page_id``, ``url``, the main ``text`` and its length in code points."""
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), text_or_empty(page).alias("page")
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
