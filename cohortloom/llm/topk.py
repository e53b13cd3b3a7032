"""Exact inner-product search by a three-phase uniform threshold over slices of the dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored

SCALE = 64
SLICES = 4
#: Rows of one block of queries and of one block of candidates.
QUERY_BLOCK, BLOCK = 256, 1024


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of every component, as whole doubles.

    Vectors that are NULL or hold NULL, NaN or infinite components are left out.
    """
    v = F.col(vector).cast("array<double>")
    limit = F.lit(float("inf"))
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("double"))
    return vectors.filter(F.coalesce(sound, F.lit(False))).select(F.col(key).alias("id"), whole.alias("v"))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    column = table.column("v").combine_chunks()
    offsets = column.offsets.to_numpy()
    widths = np.diff(offsets)
    out = np.zeros((len(ids), int(widths.max(initial=0))))
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    out[np.arange(out.shape[1]) < widths[:, None]] = flat
    return ids, out


def _aligned(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the same number of components: missing ones count as 0."""
    width = max(q.shape[1], c.shape[1], 1)
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, c))


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products, as numbers of 64 bits."""
    if (np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1])) < 2.0**53:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.T.astype(np.int64)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def _parts(width: int, slices: int) -> list[slice]:
    cut = np.linspace(0, width, min(slices, width) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cut[:-1], cut[1:])]


def _pair_blocks(queries: DataFrame, rows: DataFrame, n_query_blocks: int, n_blocks: int, extra: tuple[str, ...] = ()):
    """Both sides grouped by pairs of blocks, every query against every row once.

    Block numbers have one type on both sides: a cogroup deals each side by the hash of its own
    keys, and equal numbers of different types land in different partitions.
    """
    own = F.pmod(F.xxhash64("id"), F.lit(1 << 30))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("id", "v", *extra, (own % n_query_blocks).cast("int").alias("qb")).withColumn("cb", each(n_blocks))
    right = rows.select("id", "v", (own % n_blocks).cast("int").alias("cb")).withColumn("qb", each(n_query_blocks))
    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    slices: int = SLICES,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id``, ``score``: the ``k`` highest scores of each query.

    ``queries`` and ``vectors`` are tables with the columns ``key`` and ``vector``. The dimensions
    are cut into slices, each of which scores in part. (1) In each block of rows the best of every
    slice, a local list, are scored exactly; the k-th best of all lists is a cutoff that the k-th
    best score of all can't be below. (2) The cutoff goes to all blocks: a row that reaches it has
    a slice with at least the cutoff divided by the slices (signs don't matter), so only such rows
    are gathered. (3) Their scores are resolved exactly; each block hands on its ``k`` best that
    reach the cutoff, and the best of those are the result. Ties go to the smaller id. Rows with
    the query's own key are no candidates. Vectors of different lengths are filled up with zeros;
    repeated rows of a key count as rows, of a repeated query the least vector by its components
    asks; NULL keys take no part. Scores must fit in 64 bits.
    """
    rows = stored(quantised(vectors, key, vector).filter("id is not null"), "vectors")
    asked = stored(quantised(queries, key, vector).filter("id is not null").groupBy("id").agg(F.min("v").alias("v")), "queries")
    n_blocks, n_query_blocks = max(1, -(-rows.count() // BLOCK)), max(1, -(-asked.count() // QUERY_BLOCK))

    def lists(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "score": []}
        if len(left) and len(right):
            qid, q = _matrix(left)
            cid, c = _matrix(right)
            q, c = _aligned(q, c)
            n = min(k + 1, len(cid))
            chosen = np.zeros((len(qid), len(cid)), bool)
            for part in _parts(q.shape[1], slices):
                at = np.argpartition(-_scores(q[:, part], c[:, part]), n - 1, axis=1)[:, :n]
                np.put_along_axis(chosen, at, True, axis=1)
            score = _scores(q, c)
            for i, own in enumerate(qid):
                mine = score[i, chosen[i] & (cid != own)]
                mine = -np.partition(-mine, min(k, len(mine)) - 1)[:k] if len(mine) else mine
                out["query_id"] += [own] * len(mine)
                out["score"] += mine.tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "score": pa.array(out["score"], pa.int64())})

    local = _pair_blocks(asked, rows, n_query_blocks, n_blocks).applyInArrow(lists, "query_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    cutoff = local.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff"))
    informed = asked.join(cutoff, "id", "left")

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec": [], "score": []}
        if len(left) and len(right):
            qid, q = _matrix(left)
            cid, c = _matrix(right)
            q, c = _aligned(q, c)
            none = -(1 << 62)  # fewer than k rows: all are wanted
            cut = np.array([none if x is None else x for x in left.column("cutoff").to_pylist()], np.int64)
            parts = _parts(q.shape[1], slices)
            reached = np.zeros((len(qid), len(cid)), bool)
            for part in parts:
                reached |= _scores(q[:, part], c[:, part]) * len(parts) >= cut[:, None]
            for i, own in enumerate(qid):
                at = np.flatnonzero(reached[i] & (cid != own))
                score = _scores(q[i : i + 1], c[at])[0]
                at, score = at[score >= cut[i]], score[score >= cut[i]]
                best = _best(cid[at], score, k)
                out["query_id"] += [own] * len(best)
                out["vec"] += cid[at[best]].tolist()
                out["score"] += score[best].tolist()
        return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})

    reaching = _pair_blocks(informed, rows, n_query_blocks, n_blocks, ("cutoff",)).applyInArrow(
        resolve, "query_id bigint, vec bigint, score bigint"
    )
    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec")
    ranked = reaching.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec").alias("id"), "score")
