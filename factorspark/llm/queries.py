"""The queries of the operators, with their production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorspark.llm import (
    alignment,
    divergence,
    imatch,
    langid,
    mixture,
    packing,
    quality,
    sharding,
    simhash,
    tokencount,
    topk,
    toxicity,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack(_table(spark, sf_dir, "documents"), *paths, end_id=2, capacity=1024)


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(_table(spark, sf_dir, "pages")))
    return records.withColumnRenamed("key", "page_id")


def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, radius=4)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    counts = tokencount.token_counts(_table(spark, sf_dir, "documents"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(_table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), max_epochs=3.0, seed=42)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
    return alignment.align(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, names))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op13_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffled(_table(spark, sf_dir, "documents"), shards=40, seed=42)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return rows.select(
        "row.doc_id",
        sharding.text_bytes("row.text").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_toxicity": op2_toxicity,
    "op3_imatch_fingerprints": op3_imatch_fingerprints,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op6_site_quality": op6_site_quality,
    "op7_byte_cnn_language": op7_byte_cnn_language,
    "op8_simhash_components": op8_simhash_components,
    "op9_token_counts": op9_token_counts,
    "op10_source_mix": op10_source_mix,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_source_divergence": op12_source_divergence,
    "op13_shuffled_shards": op13_shuffled_shards,
}

SQL: dict[str, str] = {
    "op1_exact_top_k": """
        WITH q AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM q a JOIN q b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op10_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   CAST('0x' || substr(md5('42:' || doc_id), 1, 14) AS BIGINT) AS at
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
            FROM sized GROUP BY source
        ), rates AS (
            SELECT *,
                   ((SELECT sum(size) FROM sized)
                    - coalesce(sum(3.0 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
            FROM sources
        ), filled AS (
            SELECT *, least(3.0 * source_size, weight * (SELECT max(rate) FROM rates))::DOUBLE AS target
            FROM rates
        ), planned AS (
            SELECT source, source_size, target,
                   CASE WHEN source_size > 0 THEN CAST(floor(target / source_size + 1e-9) AS BIGINT) ELSE 0 END AS whole
            FROM filled
        )
        SELECT s.doc_id, s.size, p.source_size, round(p.target, 6) AS target,
               CAST(p.whole * s.size + greatest(0, least(s.size,
                   greatest(0, CAST(round(p.target) AS BIGINT) - p.whole * p.source_size)
                   - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.at, s.doc_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
        FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
    """,
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), groups AS (
            SELECT DISTINCT lang, source FROM docs
        ), seen AS (
            SELECT k, lang, source, unnest(terms) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM seen GROUP BY ALL HAVING count(DISTINCT k) >= 30
        ), sizes AS (
            SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
        ), counts AS (
            SELECT s.lang, s.source, s.term, count(*) AS n FROM seen s SEMI JOIN kept k USING (lang, term) GROUP BY ALL
        ), totals AS (
            SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
        ), probabilities AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * z.v) AS p,
                   1 + (1000000000::HUGEINT * (k.n + 5)) // (z.total + 5 * z.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN sizes z USING (lang)
            LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN probabilities x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN probabilities y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM probabilities WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
}
