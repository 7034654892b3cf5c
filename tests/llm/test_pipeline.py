"""The pipeline against a plain version, its stages' columns, odd rows, and the entry without this subpackage."""

from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from covercast.llm import mixing, quality
from covercast.llm.queries import tokenizer_path
from test_minhash import all_pairs

SF = "/root/testdata/sf0.001"


def plain(spark, docs, sf_dir):
    """Keys of the documents that leave the third stage, as often as they do."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.collect()
    levels = np.stack([quality.quantized(quality.term_counts(r.text or "")) for r in rows])
    rows = [r for r, s in zip(rows, model.scores(levels)) if s >= quality.THRESHOLD]
    classes = all_pairs([(r.doc_id, r.text) for r in rows])
    kept = [r for r in rows if r.doc_id is None or classes[r.doc_id] == r.doc_id]
    frame = spark.createDataFrame(kept, docs.schema)
    return Counter({r.doc_id: r.copies for r in mixing.mix(frame).collect() if r.copies}), {r.doc_id: r.text for r in kept}


def test_run_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected, texts = plain(spark, docs, SF)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in rows) == expected
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for r in rows:
        assert r.text == texts[r.doc_id]
        assert r.ids == tokenizer.encode(r.text, add_special_tokens=False).ids


def test_stages_keep_the_columns_of_their_input(spark):
    rows = [(i, f"some text number {i} of the set", "en", f"s{i % 2}", 7, 1.0, "a") for i in range(20)]
    rows += [(None, None, None, None, None, None, None), (3, rows[3][1], "en", "s1", 7, 1.0, "a"), (40, "", "en", "s0", 0, 1.0, "b")]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, class_id string"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out.count()
    once = corpus_pipeline.keep_one_of_each(spark, docs, SF)
    assert Counter(r.doc_id for r in once.collect()) == Counter([*range(20), None, 40])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "mixing", "bpe"]
