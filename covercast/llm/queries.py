"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covercast.llm import balltree, benchmark_scan, bpe, chat, digest, gnat, html_text, lm, minhash, mixing, quality, runs, token_files
from covercast.llm.storage import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return token_files.checksums(token_files.read_tokens(spark, path))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(_table(spark, sf_dir, "documents"))


def op4_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_with_edits(_table(spark, sf_dir, "documents"))


def op5_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op6_balltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM valid q JOIN valid c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source", "copies")


OP7_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, md5('0:' || coalesce(doc_id::VARCHAR, 'null')) AS lot,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
), sources AS (
    SELECT *, 3 * source_size AS cap,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), levels AS (
    SELECT cap / weight AS full_at,
        ((SELECT sum(source_size) FROM sources)
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        )::BIGINT
        / (sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT
            AS level
    FROM sources
), goal AS (
    SELECT source, source_size, target, floor(target / source_size)::BIGINT AS copies,
        target / source_size - floor(target / source_size) AS p,
        target - floor(target / source_size)::BIGINT * source_size AS words_left
    FROM (
        SELECT source, source_size, least(
            weight * (SELECT arg_min(level, full_at) FROM levels WHERE full_at >= level), cap::DOUBLE) AS target
        FROM sources WHERE source_size > 0
    )
), drawn AS (
    SELECT *, (('0x' || lot[1:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source
), ranked AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, lot) <= words_left AS fits
    FROM (SELECT * EXCLUDE (source_1), CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM drawn)
), gaps AS (
    SELECT source, any_value(words_left) - coalesce(sum(size) FILTER (fits), 0)::BIGINT AS gap
    FROM ranked WHERE p > 0 GROUP BY source
), closing AS (
    SELECT r.source, r.lot AS extra_lot FROM ranked r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source
    WHERE p > 0 AND NOT fits AND abs(size - gap) < gap
    QUALIFY row_number() OVER (PARTITION BY r.source ORDER BY abs(size - gap), q, lot) = 1
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    (size * (copies + CASE WHEN p > 0 AND (fits OR coalesce(lot = extra_lot, false)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked LEFT JOIN closing ON ranked.source IS NOT DISTINCT FROM closing.source
UNION ALL
SELECT doc_id, 0::BIGINT, 0::BIGINT, 0::DOUBLE, 0::BIGINT FROM sized JOIN sources
    ON sized.source IS NOT DISTINCT FROM sources.source WHERE source_size = 0
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.learn(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        # A row without a key teaches nothing, but no lot holds it out.
        F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recover_lines(chat.transcripts(_table(spark, sf_dir, "conversations")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode_decode(_table(spark, sf_dir, "documents"), tokenizer_path())
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP11_SQL = """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), anchors AS (
    SELECT row_number() OVER () AS a, * FROM (SELECT DISTINCT vec_id, label, v FROM valid WHERE vec_id % 100 = 0)
), scored AS (
    SELECT a, q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
        list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM anchors q JOIN valid c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS p FROM scored WHERE same
    QUALIFY p <= 5
)
SELECT s.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY s.a, p.p ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.a = s.a AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_scan.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.reduce("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP12_SQL = r"""
WITH items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS pattern
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), grams AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))
), found AS (
    SELECT DISTINCT r, i, n, item FROM grams JOIN windows USING (pattern, n)
), hits AS (
    SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


def repeating(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that are looked at for runs: a tenth of the documents, by their number, repeat a stretch to their end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(_table(spark, sf_dir, "documents"), rewrite=repeating)
    ordered = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.array_max(ordered)
    named = found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "").alias("lines"),
        "collapsed",
    )
    return named.select(
        *named.columns[:5],
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.encode("lines", "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_token_files": op2_token_files,
    "op3_minhash": op3_minhash,
    "op4_digest": op4_digest,
    "op5_recurrent_lm": op5_recurrent_lm,
    "op6_balltree": op6_balltree,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_chat": op9_chat,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontamination": op12_decontamination,
    "op13_runs": op13_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op6_balltree": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_decontamination": OP12_SQL,
}
