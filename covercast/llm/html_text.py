"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. The first pass decides by link density, length and
the share of stop words, with the markup around a block as a further sign: navigation, adverts, notices, forms and
comments are never text, and what stands in an article is never rejected for its words alone. Blocks that are
too short or too odd to tell stay open; the second pass gives them the label of the nearest decided block of
the same section, the text's where two are equally near. Pages that mark no article are read by the same two passes.
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

from covercast.llm.storage import importable

# Common function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from has have he in is it of on or that the this to was were which with
    au aux avec ce ces dans de des du elle en est et il la le les leur mais ne par pas pour qui sur un une
    auf das dem den der die ein eine für im ist mit nicht sich sie und von zu
    al como con del el es las lo los más no para pero por que se su y
    """.split()
)

# Elements without text of the page, and elements and names that mark what is not the article.
SILENT = frozenset("script style noscript template title textarea select option button svg iframe object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    """
    a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span
    strike strong sub sup time tt u var wbr
    """.split()
)
OUTSIDE_TAGS = frozenset("nav header footer aside form menu dialog head".split())
OUTSIDE_NAMES = frozenset(
    """
    ad ads adsense advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent
    cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation
    newsletter notice notification pager pagination popup promo promotion related respond search share sharing sidebar
    signup social sponsor sponsored subscribe toolbar widget
    """.split()
)
OUTSIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
#: Names that an article's own heading may carry.
HEADING_NAMES = frozenset(["header", "masthead", "banner"])

SHORT, LONG = 70, 200
STOP_NONE, STOP_LONG, STOP_LOW, STOP_HIGH = 0.03, 0.08, 0.15, 0.30
MOST_LINKS = 0.5

#: Comments and declarations; tags whose attributes hold no "<"; tags of any kind.
REMARK = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)>")
ANY_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
#: Characters that a tag with "<" in its attributes may have, and such tags that may fail to close before no more are tried.
MOST_TAG, MOST_FAILED = 65_536, 64
WORD = re.compile(r"\w+")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[-_]+")
#: Elements that hold the page or its article: names do not set them apart.
HOLDERS = frozenset("html body main article".split())


@dataclass
class Block:
    """Text of a block, characters of it inside links, its section, and what the markup around it says."""

    text: str
    linked: int
    section: int
    outside: bool
    inside: bool
    label: str = "open"


def marked_outside(tag: str, attributes: str, inside: bool, by_name: bool = True) -> bool:
    """Whether a tag opens a part that is not the article's text: by itself, as hidden, or by a class, id or role.

    A class or id counts as a whole word, or if each of its parts between hyphens is a name. Without ``by_name``
    names count inside an article only.
    """
    if tag in OUTSIDE_TAGS and not (inside and tag == "header"):
        return True
    for kind, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        kind = kind.lower()
        if kind == "hidden":
            return True
        if kind not in ("class", "id", "role") or tag in HOLDERS or not (inside or by_name):
            continue
        names = OUTSIDE_ROLES if kind == "role" else OUTSIDE_NAMES
        names = names - HEADING_NAMES if inside else names
        for word in "".join(values).lower().split():
            if word in names or all(part in names for part in PART.split(word)):
                return True
    return False


class Marks:
    """Comments, declarations and tags of a page, found in time that grows with its length.

    What stands after a "<" that opens none of them is text. A tag that breaks off inside quotes ends nowhere: after
    ``MOST_FAILED`` of them only tags without "<" in their attributes are found.
    """

    def __init__(self, page: str):
        # Nothing closes behind the last ">", but a comment that runs to the end.
        self.page, self.last, self.failed = page, page.rfind(">") + 1, 0

    def after(self, at: int) -> re.Match | None:
        """The first one that begins at ``at`` or later."""
        page, last = self.page, self.last
        while (at := page.find("<", at)) >= 0:
            found = REMARK.match(page, at) if at < last or page.startswith("<!--", at) else None
            if found is None and at < last:
                found = TAG.match(page, at, last)
                if found is None and self.failed < MOST_FAILED:
                    found = ANY_TAG.match(page, at, min(last, at + MOST_TAG))
                    self.failed += found is None
            if found is not None:
                return found
            at += 1
        return None


def blocks(page: str, by_name: bool = True) -> list[Block]:
    """The blocks of a page in order, white space collapsed, character references decoded."""
    found: list[Block] = []
    open_tags: list[tuple[str, bool, bool, int]] = []  # tag, outside, inside, section
    parts: list[tuple[str, bool]] = []
    held: Counter[str] = Counter()  # open tags by name
    links, sections, breaks, at = 0, 0, 0, 0
    marks = Marks(page)

    def state() -> tuple[bool, bool, int]:
        return open_tags[-1][1:] if open_tags else (False, False, 0)

    def close_block() -> None:
        if not parts:
            return
        text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
        if text:
            linked = len(" ".join(html.unescape("".join(p for p, a in parts if a)).split()))
            outside, inside, section = state()
            found.append(Block(text, linked, section, outside, inside))
        parts.clear()

    def pop_from(k: int) -> None:
        held.subtract(t[0] for t in open_tags[k:])
        del open_tags[k:]

    while at < len(page):
        m = marks.after(at)
        end = m.start() if m else len(page)
        if end > at:
            piece = page[at:end]
            parts.append((piece, links > 0))
            if not piece.isspace():
                breaks = 0
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower() if m.re is not REMARK else ""
        if not tag:
            continue
        closing = bool(m[1])
        if tag == "br":
            parts.append((" ", links > 0))
            breaks += 1
            if breaks > 1:
                close_block()
            continue
        if tag in SILENT and not closing:
            if not m[3].endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at, marks.last)
                at = stop.end() if stop else len(page)
            parts.append((" ", links > 0))
            continue
        if tag not in INLINE:
            close_block()
            breaks = 0
        if tag in VOID:
            continue
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            if held[tag] > 0:
                pop_from(next(k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == tag))
            continue
        if tag not in INLINE:
            links = 0
            while open_tags and (open_tags[-1][0] in INLINE or open_tags[-1][0] in ("p", "li") and open_tags[-1][0] == tag):
                pop_from(len(open_tags) - 1)
            if open_tags and open_tags[-1][0] == "p":
                pop_from(len(open_tags) - 1)
            if tag == "body":
                pop_from(0)
        elif tag == "a":
            continue
        outside, inside, section = state()
        outside = outside or marked_outside(tag, m[3], inside, by_name)
        if tag in ("article", "main") and not outside:
            sections += 1
            inside, section = True, sections
        if tag not in INLINE or outside != state()[0]:
            open_tags.append((tag, outside, inside, section))
            held[tag] += 1
    close_block()
    return found


def first_pass(block: Block, marked: bool) -> str:
    """text, other or open; marked: whether the page marks an article."""
    size = len(block.text)
    if block.outside or marked and not block.inside:
        return "other"
    if block.linked > MOST_LINKS * size:
        return "other"
    if size < SHORT:
        return "open"
    tokens = WORD.findall(block.text.lower())
    density = sum(map(STOP_WORDS.__contains__, tokens)) / max(1, len(tokens))
    if density >= STOP_HIGH or density >= (STOP_LOW if size < LONG else STOP_LONG):
        return "text"
    # Hardly a function word in many: no prose. Else the neighbours decide.
    return "other" if density < STOP_NONE and size >= LONG and not block.inside else "open"


def classify(page: str) -> list[Block]:
    """The blocks of a page, each labelled text or other.

    Where all text stands in wrappers that only their names set apart, those keep it.
    """
    found = labelled(blocks(page))
    if any(b.label == "text" for b in found) or not any(b.outside for b in found):
        return found
    again = labelled(blocks(page, by_name=False))
    return again if any(b.label == "text" for b in again) else found


def labelled(found: list[Block]) -> list[Block]:
    marked = any(b.inside and not b.outside for b in found)
    for b in found:
        b.label = first_pass(b, marked)
    # Blocks that the markup sets apart are no neighbours: they stand between paragraphs of any kind.
    flow = [b for b in found if not b.outside and (b.inside or not marked)]
    decided = [i for i, b in enumerate(flow) if b.label != "open"]
    at = 0
    labels = []
    for i, b in enumerate(flow):
        if b.label != "open":
            labels.append(b.label)
            continue
        while at < len(decided) and decided[at] < i:
            at += 1
        near = [
            (abs(j - i), flow[j].label != "text")
            for j in decided[max(0, at - 1) : at + 1]
            if flow[j].section == b.section
        ]
        # Without any decided block in its section, an article's block is its text, and so is a page's without any at all.
        alone = "text" if b.inside or not decided else "other"
        labels.append(("text", "other")[min(near)[1]] if near else alone)
    for b, label in zip(flow, labels):
        b.label = label
    return found


def main_text(page: str) -> str:
    return "\n".join(b.text for b in classify(page) if b.label == "text")


def _extract_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labelled = [classify(x.as_py() or "") for x in batch.column(2)]
        texts = ["\n".join(b.text for b in page if b.label == "text") for page in labelled]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
                pa.array([len(p) for p in labelled], pa.int64()),
                pa.array([sum(b.label == "text" for b in p) for p in labelled], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
        )


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_blocks and n_kept of every page, in the place of the row: no shuffle.

    Null, empty and text-free pages give an empty text; tags that never close and pages that break off are
    read as far as they go; rows that repeat are extracted as often. Other columns are not read.
    """
    importable(pages.sparkSession)
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html")
    )
    schema = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_kept bigint"
    return rows.mapInArrow(_extract_partition, schema)
