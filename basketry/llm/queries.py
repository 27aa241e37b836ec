"""One query per operator over the test tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import bpe, chat, combos, decontam, extract, language, near, passages, phrases, quality, topk, urls, whiten
from basketry.llm.scratch import Scratch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of every participant; spans as text."""
    out = chat.perspectives(read(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["stop"])), ",")
    return out.withColumn("mask", spans)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item that it holds."""
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, VOCABULARY)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each page; profiles come from all documents."""
    profiles = language.fit(read(spark, sf_dir, "documents"))
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return language.identify(pages, profiles)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")
    stored = Scratch(spark, "quality").keep(quality.features(docs))
    model = quality.fit_on(stored, read(spark, sf_dir, "labels"))
    out = quality.score_features(stored, model)
    return out.select(
        F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(read(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(read(spark, sf_dir, "embeddings"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combos.similarity_components(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents")).drop("cut")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    out = corpus_pipeline.run(spark, sf_dir)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.withColumn("ids_sha256", F.sha2(joined.cast("binary"), 256)).drop("ids")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_perspectives, op2_decontamination, op3_bpe, op4_url_filter, op5_html_text,
        op6_near_duplicates, op7_language, op8_quality, op9_repeated_passages, op10_top_k, op11_whitening,
        op12_jaccard_join, op13_collocations, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op1_chat_perspectives": """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
        replace(coalesce(text, ''), '<|', '< |') AS text,
        CAST(floor(turn / 64.0) AS BIGINT) AS part
    FROM conversations
), who AS (
    SELECT DISTINCT conv_id AS conv, role AS speaker FROM said WHERE role <> 'system'
), views AS (
    SELECT said.*, speaker,
        row_number() OVER (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM said JOIN who ON conv_id IS NOT DISTINCT FROM conv
), messages AS (
    SELECT *, CAST(pos // 64 AS INTEGER) AS piece, role = speaker AS own,
        '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant'
            ELSE 'user name=' || role END || chr(10) AS head,
        text || '<|im_end|>' AS body
    FROM views
), placed AS (
    SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
        PARTITION BY conv_id, speaker, part, piece ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
    FROM messages
)
SELECT conv_id, speaker, part, piece, CAST(count(*) AS INTEGER) AS n_messages,
    string_agg(head || body || chr(10), '' ORDER BY pos) AS text,
    coalesce(string_agg(CASE WHEN own THEN CAST(first + length(head) AS BIGINT) || '-'
        || CAST(first + length(head) + length(body) AS BIGINT) END, ',' ORDER BY pos), '') AS mask
FROM placed GROUP BY conv_id, speaker, part, piece
""",
    "op10_top_k": """
WITH v AS (
    SELECT DISTINCT ON (vec_id) vec_id,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
""",
    "op13_collocations": r"""
WITH cut AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda w: w <> '') AS w FROM cut
), n AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
        lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM words, (SELECT unnest(range(1, 6)) AS size) AS sizes
), f AS (
    SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100
), cuts AS (
    SELECT lang, phrase, a, size, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM f WHERE size > 1
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.size, k, l.a AS l, r.a AS r, n,
        CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM cuts c JOIN n ON n.lang = c.lang
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, size, a, unnest(list_transform(range(1, size - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM cuts WHERE k > 1
), longer AS (
    SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase
), kept AS (
    SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE coalesce(100 * most < 100 * a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
""",
}
