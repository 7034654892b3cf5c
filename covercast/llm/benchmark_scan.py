"""Passages of a benchmark inside documents, found by an Aho-Corasick automaton.

Texts are normalised: A-Z become a-z, every other ASCII character that is neither letter nor digit becomes a space, and
one space stands between two words. The windows of the benchmark (``WIDTH`` words in a row, or a whole shorter item), normalised and
fenced by spaces, are the patterns of one automaton. A document is normalised and read by it once;
places in the normalised text are mapped back to the words and the characters of the original.

The patterns are broadcast, at most ``PATTERN_BYTES`` of them at a time: a larger benchmark is cut by a hash of the pattern into as
many automata as needed, which read the documents one after the other. No document is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covercast.llm.storage import importable, written

WIDTH = 10
#: Bytes of patterns and of the lists of their items that one automaton may hold; it takes up to some fifty times as much memory.
PATTERN_BYTES = 4_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What each byte of UTF-8 becomes: itself, its small letter, or a space.
FOLDED = bytes(
    ord(c.lower()) if b < 128 and c.isalnum() else b if b >= 128 else 32 for b, c in ((b, chr(b)) for b in range(256))
)
LETTER = np.frombuffer(FOLDED, np.uint8) != 32
SPACE = 32

OUT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "first_word", "last_word")]))),
        ("items", pa.list_(pa.string())),
    ]
)
SPANS, ITEMS = "array<struct<start:bigint,end:bigint,first_word:bigint,last_word:bigint>>", "array<string>"


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def windows(items: DataFrame, key: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(pattern, items) of the distinct windows, with the keys of the items that have them, as strings (null: "").

    Rows that share a key are one item. Items without words have no window.
    """
    named = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item")
    cut = items.select(named, words(F.col(text).cast("string")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    each = cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("w"))
    patterns = each.select("item", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("pattern")).distinct()
    return patterns.groupBy("pattern").agg(F.collect_list("item").alias("items"))


class Scanner:
    """An automaton over patterns and the keys of their items."""

    def __init__(self, patterns: list[tuple[str, list[str]]]):
        self.items = [keys for _, keys in patterns]
        self.automaton = ahocorasick.Automaton()
        for at, (pattern, _) in enumerate(patterns):
            # The letters of the automaton are bytes, one character each.
            self.automaton.add_word(pattern.encode().decode("latin-1"), (at, pattern.count(" ") - 1))
        self.automaton.make_automaton()

    def scan(
        self, text: str, spans: list[dict] | None = None, items: list[str] | None = None
    ) -> tuple[int, list[dict], list[str]]:
        """Number of words, hit stretches and keys of the items found, besides those that are known already."""
        data = text.encode()
        found = data.translate(FOLDED).split()
        if not found:
            return 0, [], []
        joined = b" " + b" ".join(found) + b" "
        ends, sizes, seen = [], [], set()
        if self.items:
            for end, (at, n) in self.automaton.iter(joined.decode("latin-1")):
                ends.append(end)
                sizes.append(n)
                seen.add(at)
        if not ends:
            return len(found), spans or [], items or []
        # A pattern ends with the space after its last word.
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == SPACE)
        last = np.searchsorted(blanks, np.array(ends)) - 1
        cover = np.zeros(len(found) + 1, np.int64)
        np.add.at(cover, last - np.array(sizes) + 1, 1)
        np.add.at(cover, last + 1, -1)
        for span in spans or ():
            cover[span["first_word"]] += 1
            cover[span["last_word"] + 1] -= 1
        edges = np.flatnonzero(np.diff(np.cumsum(cover[:-1]) > 0, prepend=False, append=False))
        firsts, lasts = edges[0::2], edges[1::2] - 1
        # Where words begin and end in the original, in bytes, and how many characters begin before each byte.
        raw = np.frombuffer(data, np.uint8)
        turns = np.flatnonzero(np.diff(LETTER[raw], prepend=False, append=False))
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        columns = (chars[turns[0::2][firsts]], chars[turns[1::2][lasts]], firsts, lasts)
        names = OUT.field("spans").type.value_type
        stretches = [dict(zip((f.name for f in names), row)) for row in zip(*(c.tolist() for c in columns))]
        return len(found), stretches, sorted({*(items or ()), *(key for i in seen for key in self.items[i])})


#: The automaton that this process used last, by the tag of its patterns.
_scanners: dict[str, Scanner] = {}


def _scan_partition(batches: Iterator[pa.RecordBatch], patterns: Broadcast, tag: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, spans, items, text) to (doc_id, n_words, spans, items, text)."""
    if tag not in _scanners:
        _scanners.clear()
        _scanners[tag] = Scanner(patterns.value)
    scanner = _scanners[tag]
    for batch in batches:
        keys, spans, items, texts = batch.columns
        rows = [scanner.scan(texts[i].as_py() or "", spans[i].as_py(), items[i].as_py()) for i in range(batch.num_rows)]
        new = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(OUT)]
        yield pa.RecordBatch.from_arrays([keys, *new, texts], ["doc_id", *OUT.names, "text"])


def scan(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs``, in the place of the row.

    spans: the hit stretches of the original text, as characters ``start`` (from) and ``end`` (before) and numbers of the first and
    last word; items: the sorted keys, as strings, of the items with a window in the text. Null and empty texts have no words
    and no hits. Rows of ``items`` with one key are one item, those with a null key one item with the key "". An empty
    benchmark hits nothing, an empty table gives no rows. Repeated rows are scanned as often; other columns are not read.
    """
    spark = docs.sparkSession
    importable(spark)
    patterns = written(windows(items, item_key, item_text, width), "windows")
    size = patterns.agg(F.sum(F.octet_length("pattern") + F.octet_length(F.array_join("items", " ")))).first()[0] or 0
    automata = -(-size // pattern_bytes) or 1
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.lit(None).cast(SPANS).alias("spans"),
        F.lit(None).cast(ITEMS).alias("items"),
        F.col(text).cast("string").alias("text"),
    )
    schema = f"doc_id {kind}, n_words bigint, spans {SPANS}, items {ITEMS}, text string"
    for number in range(automata):
        share = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(automata)) == number)
        known = spark.sparkContext.broadcast([(r["pattern"], r["items"]) for r in share.collect()])
        rows = rows.select("doc_id", "spans", "items", "text").mapInArrow(partial(_scan_partition, patterns=known, tag=uuid.uuid4().hex), schema)
        if number + 1 < automata:
            rows = written(rows, "scanned")
    return rows.select("doc_id", *OUT.names)
