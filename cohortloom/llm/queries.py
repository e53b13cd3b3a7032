"""The numbered operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import bpe, fingerprints, lmscore, mix, periodic, quality, simhash, suffixes, tokenfiles, topk, toxicity, trie, warc
from cohortloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix(table(spark, folder, "documents"))


SQL["op1_source_mix"] = mix.ORACLE


@query
def op2_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(table(spark, folder, "documents"))


@query
def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removal_digests(table(spark, folder, "documents"))


@query
def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


SQL["op4_warc_revisits"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), firsts AS (
    SELECT *, sha256(html) AS payload_digest,
           CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""


@query
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    found = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


SQL["op6_exact_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query
def op7_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return lmscore.scored(docs, lmscore.labelled_target(docs, table(spark, folder, "labels")))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.filed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, folder, "conversations")).drop("rank")


SQL["op12_conversation_trie"] = trie.ORACLE


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.run_digests(table(spark, folder, "documents"), edit=periodic.looped, texts=False)
