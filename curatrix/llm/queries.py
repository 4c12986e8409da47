"""The registered query of each operator, over its whole table, with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from curatrix.llm import (
    centroids,
    decontamination,
    fingerprints,
    jaccard,
    licences,
    packing,
    quality,
    repeats,
    tokens,
    topk,
    toxicity,
    urls,
    variants,
)
from curatrix.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.contaminations(docs, items)


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query()
def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


@query()
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read_table(spark, sf_dir, "documents"))


@query(
    """
    WITH v AS (
        SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.id AS query_id, c.id AS vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.id % 50 = 0 AND q.id <> c.id
    ), r AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """
)
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = topk.scaled(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(table, table.where("id % 50 = 0"), k=5)


@query()
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"))


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source stands for the host, its language for the path."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality.classify(docs, labels, host="source", path="lang")


@query(licences.oracle())
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read_table(spark, sf_dir, "documents"))


@query(centroids.oracle())
def op11_simplex_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"), k=8, rounds=10)


@query()
def op12_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(read_table(spark, sf_dir, "documents"))


@query()
def op13_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.word_counts(read_table(spark, sf_dir, "documents"), slip_every=97)
    return variants.spelling_variants(words, ratio=2)
