"""Queries of the numbered operators over the test tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    alignment,
    exact,
    html_text,
    jaccard,
    language,
    negatives,
    packing,
    pieces,
    quality,
    secret_scan,
    token_counts,
    toxicity,
    warc,
)
from tributary.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    "op1_quality_rules",
    sql=r"""
    WITH w AS (
      SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    l AS (
      SELECT *, len(words) AS n_words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
             [array_to_string(words[i:i + 7], ' ') FOR i IN range(1, len(words) - 6)] AS windows
      FROM w),
    spots AS (
      SELECT doc_id, t, unnest(windows) AS code, unnest(range(1, len(windows) + 1)) AS spot
      FROM l),
    twice AS (
      SELECT doc_id, t, spot FROM spots
      QUALIFY count(*) OVER (PARTITION BY doc_id, t, code) > 1),
    covered AS (
      SELECT doc_id, t, sum(least(8, coalesce(later - spot, 8)))::BIGINT AS n
      FROM (SELECT *, lead(spot) OVER (PARTITION BY doc_id, t ORDER BY spot) AS later FROM twice)
      GROUP BY doc_id, t),
    counts AS (
      SELECT l.doc_id, l.t, n_words::BIGINT AS n_words,
             length(regexp_replace(l.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(l.t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             len(string_split(l.t, chr(10))) AS n_lines,
             len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1]))::BIGINT AS n_stutters,
             length(regexp_replace(l.t, '[^A-Z]+', '', 'g')) AS n_capitals
      FROM l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.t = c.t),
    judged AS (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR n_symbols * 4 > n_words OR n_dup_lines * 2 > n_lines
                OR n_stutters * 10 > n_words * 3 OR n_capitals * 10 > word_chars * 3
                OR word_chars * 2 < n_words * 5 OR word_chars > n_words * 12) AS kept,
           n_stutters
    FROM judged
    """,
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_signals(documents(spark, sf_dir))


@query(
    "op10_exact_dedup",
    sql=r"""
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
      FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size,
           row_number() OVER w = 1 AS kept,
           sha256(content) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY content ORDER BY points DESC, doc_id NULLS LAST)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


@query(
    "op7_ngram_jaccard_join",
    sql=r"""
    WITH RECURSIVE w AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    sets AS (
      SELECT r, doc_id,
             CASE WHEN len(words) = 0 THEN []
                  WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                  ELSE list_distinct([array_to_string(words[i:i + 4], ' ')
                                      FOR i IN range(1, len(words) - 3)]) END AS shingles
      FROM w),
    items AS (SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
    links AS (
      SELECT a.r AS a, b.r AS b
      FROM items a JOIN items b ON a.shingle = b.shingle AND a.r <> b.r
      GROUP BY a.r, b.r, a.n, b.n
      HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach AS (
      SELECT r AS a, r AS b FROM sets
      UNION
      SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
    FROM sets s JOIN reach ON reach.a = s.r JOIN sets t ON t.r = reach.b
    GROUP BY s.r, s.doc_id, len(s.shingles)
    """,
)
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


@query("op5_secret_scans")
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(documents(spark, sf_dir))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(
        documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")
    )


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query("op11_cross_tokenizer_alignment")
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query(
    "op12_hard_negative_mining",
    sql="""
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
    p AS (
      SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
           other AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """,
)
def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 50, label)


@query("op13_warc")
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_warc(warc.page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    return warc.read_pages(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
