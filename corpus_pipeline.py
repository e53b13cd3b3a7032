"""From raw documents to token digests: five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import bpe, mix, quality, simhash, suffixes
from cohortloom.llm.common import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop what the quality model, learned from the labelled rows, rejects."""
    return quality.keep_good(docs, table(spark, folder, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of near-duplicates by SimHash the document with the least id stays."""
    return simhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages that occur twice leave the texts; documents stay, if need be with empty text."""
    return suffixes.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents left out, once, or repeated as the target weights of their sources ask for."""
    return mix.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Tokens of each document, as digests, and the digest of the text decoded from them."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_repeated_passages),
    ("mixing", mixed_sources),
    ("tokens", tokens),
]

#: A fitted model, fingerprints, suffix arrays and merges are beyond SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
