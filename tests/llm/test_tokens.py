"""Token files, BPE and the piece-wise encoding behind both, against the tokenizers library on whole texts."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from covercast.llm import bpe, token_files
from covercast.llm.pieces import pieces, slices
from covercast.llm.queries import QUERIES, tokenizer_path
from covercast.llm.storage import fresh_path

ODD = [
    None, "", " ", "\n", "a", "  two  spaces ", "tab\t\t x", "x\n\n y \n", "don't we'll", "aaaa" * 9, "ß é 東京 🙂🙂", "1234 5",
    "<|endoftext|>", "x<|endoftext|>y <|endoftext|> ", "a b  c", "\x1c \x1f x", "long " * 3000 + "x" * 5000,
]
SCHEMA = "doc_id bigint, text string, tokens string, part string"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "extra", "extra") for i, t in enumerate(texts)], SCHEMA)


def whole(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet=st.sampled_from("ab1'!\n\t  é<|endoftext|>"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_both_encoders_equal_the_library_on_any_text(text):
    tokenizer = Tokenizer.from_file(tokenizer_path()) if not hasattr(whole, "kept") else whole.kept
    whole.kept = tokenizer
    expected = whole(tokenizer, text)
    for encoder in (bpe.bpe_pieces(tokenizer_path()), token_files.library_encoder(tokenizer_path())):
        assert np.frombuffer(encoder.texts([text])[0], "<i4").tolist() == expected


@given(st.lists(st.text(alphabet=st.sampled_from("abé東1'!.,?\n\t\x1c\x85\u2003  <|endoftext|>"), max_size=40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_columns_of_texts_equal_the_library(texts):
    tokenizer = Tokenizer.from_file(tokenizer_path()) if not hasattr(whole, "kept") else whole.kept
    whole.kept = tokenizer
    end = np.int32(2).astype("<i4").tobytes()
    expected = [[*whole(tokenizer, t), 2] for t in texts]
    for encoder in (bpe.bpe_pieces(tokenizer_path()), token_files.library_encoder(tokenizer_path())):
        assert encoder.lists(pa.array(texts, pa.string()), end).to_pylist() == expected


def test_columns_of_texts_with_marks_odd_spaces_and_a_small_memory(library):
    encoder = bpe.PieceEncoder(bpe.bpe(tokenizer_path()).encode, ["<|endoftext|>", "now!"], piece_limit=4, word_limit=4)
    texts = [t or "" for t in ODD] + ["One, two... three?! and, and, two", "a\u2003 \x85b", "ends with a space ", "東京, é."] * 3
    for some in (texts, texts[:1], [], texts):
        assert encoder.lists(pa.array(some, pa.string())).to_pylist() == [whole(library, t) for t in some]
    # Sliced columns, and a special string of letters and a mark.
    column = pa.array(["x"] + texts, pa.string()).slice(1)
    assert encoder.lists(column).to_pylist() == [whole(library, t) for t in texts]
    seen = []
    encoder = bpe.PieceEncoder(lambda words: [seen.append(w) or b"\0\0\0\0" for w in words], ["now!"])
    encoder.lists(pa.array(["so now! then!"]))
    assert " now!" in seen and " then!" not in seen and " then" in seen


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"t": pa.array([None, "ab", "", "abcdef", None, "x"], pa.string())})
    for size in (1, 2, 5, 100):
        assert pa.concat_arrays([s.column(0) for s in slices(batch, 0, size)]).equals(batch.column(0))
    assert [s.num_rows for s in slices(batch.slice(1), 0, 3)] == [3, 2]
    assert not list(slices(batch.slice(0, 0), 0, 3))


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_pieces_join_to_the_text(text):
    assert " ".join(pieces(text)) == text


def test_memory_forgets_without_changing_ids(library):
    encoder = bpe.PieceEncoder(bpe.bpe(tokenizer_path()).encode, ["<|endoftext|>"], piece_limit=4, word_limit=4)
    texts = ["one two three", "two four <|endoftext|>", "five six one two"] * 4
    for text in texts:
        assert np.frombuffer(encoder.texts([text])[0], "<i4").tolist() == whole(library, text)


def test_bpe_round_trip(spark, library):
    encoded = bpe.encode(frame(spark, ODD), tokenizer_path())
    rows = bpe.decode(encoded, tokenizer_path()).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.ids == whole(library, ODD[r.doc_id])
        assert r.text == (ODD[r.doc_id] or "")


def test_decoding_incomplete_characters(library):
    model = bpe.bpe(tokenizer_path())
    for ids in ([], [50256], whole(library, "é")[:1], whole(library, "🙂")[:1] + whole(library, "x")):
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_token_files(spark, library):
    docs = frame(spark, ODD).union(spark.createDataFrame([(None, "no key", "", ""), (3, "again", "", "")], SCHEMA))
    path = fresh_path(spark, "test")
    token_files.write_tokens(docs, path, tokenizer_path(), end_id=2, parts=4)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys) and len(rows) == len(ODD) + 2
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.tokens) and r.tokens[-1] == 2
        start += r.n_tokens
    by_key = {r.doc_id: r.tokens for r in rows if r.doc_id != 3}
    assert all(by_key[i] == [*whole(library, t), 2] for i, t in enumerate(ODD) if i != 3)
    sums = {(r.start, r.ids_crc32) for r in token_files.checksums(token_files.read_tokens(spark, path)).collect()}
    assert sums == {(r.start, zlib.crc32(np.array(r.tokens, "<u4").tobytes())) for r in rows}


def test_token_files_have_page_indexes_and_compact_encodings(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "repeat('word ', 1 + cast(id % 50 AS int)) AS text")
    path = fresh_path(spark, "test")
    token_files.write_tokens(docs, path, tokenizer_path(), end_id=2, parts=2, row_group_bytes=1 << 20, page_rows=500)
    files = [r.file for r in spark.read.parquet(path).selectExpr("input_file_name() AS file").distinct().collect()]
    assert len(files) == 2
    for file in files:
        group = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert any("DICTIONARY" in e for e in columns["tokens.list.element"].encodings)
        assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    plan = token_files.read_tokens(spark, path).select("doc_id", "n_tokens").filter("doc_id = 7")
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "tokens" not in scan.replace("n_tokens", "").split("ReadSchema")[1].split("\n")[0]
    assert "EqualTo(doc_id,7)" in scan


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert bpe.decode(bpe.encode(empty, tokenizer_path()), tokenizer_path()).count() == 0
    path = fresh_path(spark, "test")
    token_files.write_tokens(empty, path, tokenizer_path(), end_id=2)
    assert token_files.checksums(token_files.read_tokens(spark, path)).count() == 0


def test_registered_queries_cover_all_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op2_token_files"](spark, "/root/testdata/sf0.001").collect()}
    assert rows.keys() == texts.keys()
    start = 0
    for i in sorted(texts):
        ids = [*whole(library, texts[i]), 2]
        assert (rows[i].start, rows[i].n_tokens) == (start, len(ids))
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_op10_equals_the_library_on_every_document(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op10_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = whole(library, texts[r.doc_id])
        back = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_one_pass_equals_encoding_then_decoding(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BOTH_CHARS", 5)
    rows = [(1, "Hello there, <|endoftext|> you"), (None, None), (2, ""), (2, "é\u00a0 x  "), (3, "a" * 300)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id int, text string, ids string")
    one = bpe.encode_decode(docs, tokenizer_path())
    two = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path())
    assert one.schema == two.schema
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert bpe.encode_decode(docs.limit(0), tokenizer_path()).count() == 0
