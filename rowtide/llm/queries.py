"""The operators' registered queries and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    byte_bpe,
    exact_dedup,
    html_text,
    importance,
    languages,
    line_dedup,
    link_graph,
    metric_tree,
    near_dedup,
    packing,
    secrets,
    toxicity,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return cleaned.select(
        "doc_id",
        "n_lines",
        F.size("gone").cast("long").alias("n_removed"),
        F.array_join(F.col("gone").cast("array<string>"), ",").alias("removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(pages(spark, sf_dir))


URL_RULES = [
    link_graph.Rule("net", "/", "block"),
    link_graph.Rule("example.net", "/en/", "allow"),
    link_graph.Rule("example.com", "/de/", "block"),
    link_graph.Rule("org", "/fr/", "allow"),
]


def op3_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.judged(pages(spark, sf_dir), URL_RULES)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(documents(spark, sf_dir))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.fit(documents(spark, sf_dir), labels, ~toxicity.held_out())


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(documents(spark, sf_dir), toxicity_model(spark, sf_dir))


def op8_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return metric_tree.top_inner_products(vectors, "vec_id % 50 = 0")


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # Decoded where it was encoded: a second worker per task would hold the vocabulary once more.
    coded = byte_bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.linked(documents(spark, sf_dir), *sides)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = importance.resample(documents(spark, sf_dir), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = languages.predicted(docs, languages.fit(docs, ~languages.held_out()))
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_text": op2_html_text,
    "op3_link_graph": op3_link_graph,
    "op4_secrets": op4_secrets,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_metric_tree": op8_metric_tree,
    "op9_packing": op9_packing,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_alignment": op11_alignment,
    "op12_importance": op12_importance,
    "op13_language": op13_language,
    "pipeline": pipeline,
}

CHECKS = {
    "op12_importance": """
WITH RECURSIVE byte_steps AS (
    SELECT i, i AS c, 0 AS k FROM range(256) b(i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM byte_steps WHERE k < 8
), steps AS (SELECT list(c ORDER BY i) AS t FROM byte_steps WHERE k = 8),
texts AS (
    SELECT 's' AS side, row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 't', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
), words AS (
    SELECT side, r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), grams AS (
    SELECT side, r, unnest(list_concat(w,
        [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
        [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS f FROM words
), counted AS (
    SELECT side, r, f, count(*) AS n FROM grams GROUP BY ALL
), coded AS (
    SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)
), bucketed AS (
    SELECT f, xor(list_reduce(
        [CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, len(h) // 2 + 1)],
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM coded, steps
), sums AS (
    SELECT b.i AS bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
    FROM range(10000) b(i) LEFT JOIN (SELECT * FROM counted JOIN bucketed USING (f)) c ON c.bucket = b.i GROUP BY b.i
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000)
        / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM sums
), weights AS (
    SELECT r, sum(n) AS n_features, sum(n * gain) AS weight
    FROM counted JOIN bucketed USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY r
), scored AS (
    SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
           CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM words LEFT JOIN weights USING (r) WHERE side = 's'
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank
FROM placed
""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op8_metric_tree": """
WITH whole AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
