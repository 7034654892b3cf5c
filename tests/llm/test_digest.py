"""Fingerprints: equal texts, bounds, and the comparison with edited texts against direct computation."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from covercast.llm import digest
from covercast.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, part int, extra string"


@given(st.text(max_size=200), st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_likeness_is_bounded_symmetric_and_one_for_equals(a, b):
    x, y = digest.fingerprint(a), digest.fingerprint(b)
    assert digest.likeness(x, x) == 1.0 and len(x) == len(y)
    assert 0.0 <= digest.likeness(x, y) == digest.likeness(y, x) <= 1.0


def test_a_small_change_stays_close():
    text = " ".join(f"word{i * i % 977}" for i in range(400))
    near = text.replace("word4 ", "other ")
    far = " ".join(f"{i * 31 % 613}thing" for i in range(400))
    mark = digest.fingerprint(text)
    assert digest.likeness(mark, digest.fingerprint(near)) > 0.9 > digest.likeness(mark, digest.fingerprint(far))


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks = [digest.fingerprint(t) for t in (text, edited, after)]
        near = (digest.likeness(marks[0], marks[1]), digest.likeness(marks[0], marks[2]))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks[0], marks[1], *near))
    return sorted(out, key=str)


def compared(spark, rows):
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], SCHEMA)
    return sorted(map(tuple, digest.compare_with_edits(docs).collect()), key=str)


def test_edits_over_partitions(spark):
    rows = [(i * 7 % 101, f"text number {i} " * (i % 13)) for i in range(101)]
    rows += [(None, None), (200, ""), (5, "repeated"), (5, "repeated"), (300, "é🙂" * 50), (-4, "x")]
    assert compared(spark, rows) == expected(rows)


def test_one_row_is_its_own_next_and_none_gives_none(spark):
    assert compared(spark, [(1, "abcdef")]) == expected([(1, "abcdef")])
    assert compared(spark, []) == []


def test_query_covers_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op4_digest"](spark, sf_dir).collect()), key=str) == expected(rows)
