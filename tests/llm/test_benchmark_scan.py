"""Benchmark passages in documents: against brute force over words, offsets, several automata, odd rows, the SQL."""

import hashlib
import random
import re
import sys

from covercast.llm import benchmark_scan
from covercast.llm.queries import OP12_SQL, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def direct(docs, items, width=10):
    """Per document its words, hit word numbers and item keys, window by window."""
    found = []
    for key, text in docs:
        words = WORD.findall(folded(text))
        hit, keys = set(), set()
        for item, passage in items:
            w = WORD.findall(folded(passage))
            for i in range(max(1, len(w) - width + 1)) if w else ():
                window = w[i : i + width]
                for at in range(len(words) - len(window) + 1):
                    if words[at : at + len(window)] == window:
                        hit |= set(range(at, at + len(window)))
                        keys.add("" if item is None else str(item))
        found.append((key, len(words), sorted(hit), sorted(keys)))
    return found


def scanned(spark, docs, items, **options):
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id bigint, text string, items int, spans string")
    items = spark.createDataFrame([(k, t, "y") for k, t in items], "item_id bigint, text string, pattern string")
    return benchmark_scan.scan(docs, items, **options).collect()


def in_words(rows):
    hit = lambda r: [w for s in r["spans"] for w in range(s.first_word, s.last_word + 1)]
    return [(r.doc_id, r.n_words, hit(r), r["items"]) for r in rows]


def sorted_rows(rows):
    return sorted(rows, key=repr)


def random_tables(seed, letters="ab"):
    rng = random.Random(seed)
    passage = lambda n: rng.choice(" ,\n").join(rng.choice([*letters, "Zé", "7x", "ÀB"]) for _ in range(n))
    items = [(i, passage(rng.randint(0, 14))) for i in range(12)]
    docs = [(i, passage(rng.randint(0, 60)) + " " + rng.choice(items)[1].upper()) for i in range(40)]
    return docs, items


def test_equals_window_by_window_search(spark):
    for seed, letters in ((1, "ab"), (2, "abcdefgh")):
        docs, items = random_tables(seed, letters)
        assert sorted_rows(in_words(scanned(spark, docs, items))) == sorted_rows(direct(docs, items))


def test_several_automata_give_the_same(spark):
    docs, items = random_tables(3)
    one, many = scanned(spark, docs, items), scanned(spark, docs, items, pattern_bytes=400)
    assert sorted_rows(one) == sorted_rows(many)
    assert sorted_rows(in_words(many)) == sorted_rows(direct(docs, items))


def test_spans_are_places_of_the_original(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    text = "Über—ganz: ß " + passage.upper().replace(" ", " -\n") + "! und twelve"
    (row,) = scanned(spark, [(1, text)], [(5, passage)])
    (span,) = row["spans"]
    assert text[span.start : span.end] == passage.upper().replace(" ", " -\n")
    assert row["items"] == ["5"] and span.last_word - span.first_word == 10


def test_odd_rows(spark):
    items = [(1, None), (2, ""), (3, "?!"), (None, "alpha beta"), (10, "gamma"), (9, "GAMMA"), (9, "delta"), (10, "gamma")]
    docs = [(1, None), (2, ""), (None, "Alpha, Beta"), (4, "gamma"), (4, "gamma"), (5, "gammas alpha-beta0 delta"), (6, "gamma\x00gamma")]
    rows = scanned(spark, docs, items)
    assert sorted_rows(in_words(rows)) == sorted_rows(direct(docs, items))
    assert {r.doc_id: r["items"] for r in rows}[4] == ["10", "9"]
    assert all(r["spans"] == [] for r in scanned(spark, docs, []))
    assert scanned(spark, [], items) == []


def test_a_very_long_text_of_nested_patterns():
    """Every place ends a pattern of each length."""
    patterns = [(" " + "a " * n, [str(n)]) for n in range(1, 11)]
    n, spans, items = benchmark_scan.Scanner(patterns).scan("a " * 200_000)
    assert n == 200_000 and items == sorted(map(str, range(1, 11)))
    assert spans == [{"start": 0, "end": 399_999, "first_word": 0, "last_word": 199_999}]


def test_query_equals_sql_and_brute_force(spark):
    sys.path.insert(0, "tests")
    from compare import connect, difference, type_differences

    sf_dir = "/root/testdata/sf0.001"
    df, relation = QUERIES["op12_decontamination"](spark, sf_dir), connect(sf_dir).sql(OP12_SQL)
    got = df.toPandas()
    assert difference(got, relation.df()) is None
    assert type_differences(df, relation) == []
    tables = [spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark")]
    expected = direct([(r.doc_id, r.text) for r in tables[0]], [(r.item_id, r.text) for r in tables[1]])
    assert any(hit for _, _, hit, _ in expected)
    ids = lambda keys: hashlib.sha256(",".join(keys).encode()).hexdigest()
    assert {tuple(r) for r in got.itertuples(index=False)} == {(k, n, len(h), len(i), ids(i), bool(h)) for k, n, h, i in expected}
