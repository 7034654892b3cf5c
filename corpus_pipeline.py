"""A corpus from raw documents to token ids, in stages that are written and read again one by one.

Every stage takes the documents that the one before kept, with all their columns; extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covercast.llm import bpe, minhash, mixing, quality
from covercast.llm.queries import tokenizer_path
from covercast.llm.storage import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the rest go. Null and empty texts are scored as well."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    column = "score" + "_" * max(len(c) for c in docs.columns)
    return quality.score(docs, model, column=column).filter(F.col(column) >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each class of near copies.

    Documents with a null key stay; of rows that repeat a key one stays.
    """
    found = written(minhash.classes(docs), "classes").filter(F.col("doc_id").isNotNull())
    gone = written(found.filter("doc_id <> class_id").select("doc_id").distinct(), "gone")
    repeated = written(found.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    kept = docs.join(gone, "doc_id", "left_anti")
    once = kept.join(repeated, "doc_id", "left_anti")
    again = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(again).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mixed(docs)


def encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the text that they decode to, of every document."""
    return bpe.encode_decode(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("bpe", encode_decode),
]

#: None of the stages but mixing can be said in SQL; tests compare the rows with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
