"""Token ids of documents in Parquet files that allow selective reads.

Files hold the documents in ascending key order, one row each: key, number of ids, place of the first id
inside the file's part, and the ids as a list column. Ids are dictionary-encoded (delta-packed where the
dictionary grows too large), the integer columns delta-packed. Row groups and pages have set sizes, and pages
carry min/max and offsets, so that a read of a few documents or of the counts alone skips the other pages.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covercast.llm.pieces import PieceEncoder, slices, without_cycles
from covercast.llm.spread import in_order
from covercast.llm.storage import importable

#: Fixed value: the letter that stands for a space in byte-level vocabularies.
SPACE_LETTER = "Ġ"
#: Words that are encoded in one string.
RUN = 250
#: Bytes of text that are encoded together.
CHUNK = 8_000_000

SCHEMA = "part int, doc_id bigint, local_start bigint, n_tokens bigint, tokens array<int>"


@lru_cache(maxsize=2)
def library_encoder(path: str) -> PieceEncoder:
    """The tokenizers library behind a memory of pieces; kept by a Python worker from task to task."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    spelt = re.compile("|".join(map(re.escape, special)) or "(?!)").search
    # Words that begin with their only space can be encoded in one string: an id whose token begins with a space begins a word.
    spaced = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        spaced[i] = token.startswith(SPACE_LETTER)

    def singly(words: list[str]) -> list[bytes]:
        encoded = []
        for at in range(0, len(words), 20_000):
            some = tokenizer.encode_batch_fast(words[at : at + 20_000], add_special_tokens=False)
            encoded += [array("i", x.ids).tobytes() for x in some]
        return encoded

    def in_runs(words: list[str]) -> list[bytes]:
        encoded: list[bytes] = []
        for at in range(0, len(words), RUN):
            some = words[at : at + RUN]
            ids = np.array(tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, "<i4")
            starts = np.flatnonzero(spaced[ids]) * 4
            if len(starts) != len(some):
                break
            data, starts = ids.tobytes(), starts.tolist()
            encoded += map(data.__getitem__, map(slice, starts, [*starts[1:], len(data)]))
        return encoded + singly(words[len(encoded) :])

    def encode(words: list[str]) -> list[bytes]:
        run = [w for w in words if w[0] == " " and (w[1:].isalpha() or w.count(" ") == 1 and not w.isspace() and not spelt(w))]
        if len(run) == len(words):
            return in_runs(run)
        found = dict(zip(run, in_runs(run)))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, singly(rest)))
        return [found[w] for w in words]

    return PieceEncoder(encode, special, 700_000, 150_000)


def _encode_partition(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (part, doc_id, text) of one part in order to rows of ``SCHEMA``."""
    encoder, end = library_encoder(path), b"" if end_id is None else np.int32(end_id).astype("<i4").tobytes()
    start = 0
    for batch in batches:
        for some in slices(batch, 2, CHUNK):
            with without_cycles():
                lists = encoder.lists(pc.fill_null(some.column(2).cast(pa.string()), ""), end)
            counts = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]])
            start += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(starts), pa.array(counts), lists],
                ["part", "doc_id", "local_start", "n_tokens", "tokens"],
            )
            del lists
            pa.default_memory_pool().release_unused()  # else the worker keeps its largest need from task to task


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
    row_group_bytes: int = 64 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode every text and write the ids under ``path`` in ascending order of an integer key.

    tokenizer: file of a byte-level tokenizer for the tokenizers library; special tokens are not added, those
    spelt out in a text count as the library counts them. end_id: id appended to each document.
    Null and empty texts give no ids of their own; null keys come first; rows of one key are ordered by
    text, and equal rows are all written. An empty table gives files without rows. Other columns are not read.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    placed = in_order(rows, "doc_id", ["text"], parts).select("part", "doc_id", "text")
    tokens = placed.mapInArrow(lambda it: _encode_partition(it, tokenizer, end_id), SCHEMA)
    writer = tokens.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    writer = writer.option("parquet.page.row.count.limit", page_rows).option("parquet.writer.version", "v2")
    for column in ("part", "doc_id", "local_start", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, tokens; a read of some columns reads no others.

    Offsets of the parts come from the counts alone: one row per file, which is broadcast.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "tokens"
    )


def _checksum_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    from covercast.llm.pieces import id_values

    for batch in batches:
        values, offsets = id_values(batch.column(3))
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def checksums(tokens: DataFrame) -> DataFrame:
    """crc32 of every document's ids as little-endian 32-bit integers, from the rows of ``read_tokens``."""
    importable(tokens.sparkSession)
    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        _checksum_partition, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
