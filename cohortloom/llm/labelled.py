"""What both classifiers need: the rows to learn from, and a scan that scores every row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import crc_mod, steps, stored, texts_of

PREDICT_AT = 0.7


def learning_rows(labels: DataFrame, label: str, held: tuple[int, int], bound: int, key: str = "doc_id") -> DataFrame:
    """At most ``bound`` keys with label 0 or 1 outside the held-out remainder, least hashes first.

    Several labels of one key count as the larger one. NULL keys and labels are left out.
    """
    modulus, remainder = held
    known = labels.filter(
        F.col(key).isNotNull() & F.col(label).isin(0, 1) & (crc_mod(key, modulus) != remainder)
    )
    one = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("_key"), "_key").limit(bound)


def learning_texts(docs: DataFrame, rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``text`` and ``label`` of the rows to learn from; the broadcast side is bounded by them.

    A key that stands on several rows of ``docs`` is learned once, from its least text.
    """
    picked = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text"))
    joined = picked.join(F.broadcast(rows), "_key").groupBy("_key", "label").agg(F.min("text").alias("text"))
    return stored(joined.select("text", "label"), "learned")


def features_of(texts: DataFrame, extract: Callable[[list[bytes]], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the rows to learn from, in an order that does not depend on the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            x = extract(texts_of(batch)).astype(np.float64)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([flat, batch.column(1)], ["x", "label"])

    got = texts.mapInArrow(run, "x array<double>, label int").toArrow()
    y = got.column("label").to_numpy().astype(np.int64)
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(len(y), width)
    order = np.lexsort((*x.T, y))
    return x[order], y[order]


def scored(docs: DataFrame, score: Callable[[list[bytes]], np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` of every row, in one scan without a shuffle."""
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(texts_of(batch)))], ["key", "score"])

    return picked.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)


def kept_rows(docs: DataFrame, score: Callable[[list[bytes]], np.ndarray], at: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``at`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            yield batch.filter(pa.array(score(texts_of(batch, text)) >= at))

    return docs.mapInArrow(run, docs.schema)


def verdicts(scores: DataFrame, held: tuple[int, int], key: str = "doc_id") -> DataFrame:
    """``key``, ``held_out``, ``score``, ``predicted``; a NULL key counts as held out."""
    modulus, remainder = held
    return scores.select(
        key,
        F.coalesce(crc_mod(key, modulus) == remainder, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )


def quantile_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner bin edges of each column."""
    at = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, at)) for column in x.T]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.int64)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, x[:, i], side="left")
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
