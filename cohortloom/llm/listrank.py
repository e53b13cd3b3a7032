"""Ranks and prefix sums along a linked list that is dealt over many tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import stored

#: Elements that one task contracts, on average.
BLOCK = 1 << 16


def contracted(element: np.ndarray, after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each element the first of its stretch (a position), the sums before it in the stretch,
    and whether the stretch ends with it.

    Elements that follow each other and are all given here form a stretch. ``element`` is sorted;
    ``after`` has -1 where nothing follows. Every round doubles how far an element looks back.
    """
    n = len(element)
    at = np.minimum(np.searchsorted(element, after), n - 1)
    here = element[at] == after
    back = np.arange(n)
    back[at[here]] = np.flatnonzero(here)
    sums = np.where((back == np.arange(n))[:, None], 0, weights[back])
    for _ in range(n.bit_length() + 1):
        further = back[back]
        if (further == back).all():
            return back, sums, ~here
        sums = sums + sums[back]
        back = further
    raise ValueError("the links form a cycle")


def _by_blocks(links: DataFrame, weights: Sequence[str], blocks: int) -> DataFrame:
    """``element``, ``head``, ``last``, ``next`` and the sums before (``b_``) and through (``t_``) it."""
    names = ["element", "head", "last", "next", *[f"b_{w}" for w in weights], *[f"t_{w}" for w in weights]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        element = whole.column("element").to_numpy()
        order = np.argsort(element)
        element = element[order]
        after = whole.column("next").fill_null(-1).to_numpy()[order]
        own = np.stack([whole.column(w).to_numpy()[order] for w in weights], axis=1)
        head, before, last = contracted(element, after, own)
        through = before + own
        nexts = pa.array(after, mask=~last | (after < 0))
        sums = [pa.array(np.ascontiguousarray(m[:, k])) for m in (before, through) for k in range(len(weights))]
        yield pa.RecordBatch.from_arrays([pa.array(element), pa.array(element[head]), pa.array(last), nexts, *sums], names)

    kinds = ["bigint", "bigint", "boolean", *["bigint"] * (1 + 2 * len(weights))]
    return links.repartitionByRange(blocks, "element").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _level(element: str, head: str, last: Column, after: Column, before: dict[str, Column], through: dict[str, Column]) -> Column:
    """A row as ``_by_blocks`` gives them."""
    sums = [*[c.alias(f"b_{w}") for w, c in before.items()], *[c.alias(f"t_{w}") for w, c in through.items()]]
    return F.struct(F.col(element).alias("element"), F.col(head).alias("head"), last.alias("last"), after.alias("next"), *sums)


def _by_coins(links: DataFrame, weights: Sequence[str], turn: int) -> DataFrame:
    """As ``_by_blocks``: an element whose coin is up joins the one before, if that one's is down."""
    up = F.xxhash64(F.lit(turn), "element").bitwiseAND(F.lit(1)) == 1
    follow = links.filter(up).select(*[F.col(c).alias(f"u_{c}") for c in ["element", "next", *weights]])
    first = links.filter(~up).join(follow, F.col("next") == F.col("u_element"), "left")
    pair = F.col("u_element").isNotNull()
    none = {w: F.lit(0).cast("bigint") for w in weights}
    own = {w: F.col(w) for w in weights}
    both = {w: F.col(w) + F.col(f"u_{w}") for w in weights}
    head = _level("element", "element", ~pair, F.when(~pair, F.col("next")), none, own)
    joined = _level("u_element", "element", F.lit(True), F.col("u_next"), own, both)
    out = first.select(F.inline(F.when(pair, F.array(head, joined)).otherwise(F.array(head))))
    taken = links.filter(~up).select(F.col("next").alias("element"))
    rest = links.filter(up).join(taken, "element", "left_anti").select(_level("element", "element", F.lit(True), F.col("next"), none, own).alias("r"))
    return out.unionByName(rest.select("r.*"))


def list_ranks(links: DataFrame, weights: Sequence[str], block: int = BLOCK) -> DataFrame:
    """``element`` and, for each weight, the sum over all elements before it in the list.

    ``links`` has different ``element`` (long, not negative), ``next`` (the following element; NULL
    at the end) and long weights. Tasks contract ranges of elements to their stretches, the
    stretches are a shorter list, and so on until one task's worth is left; then sums are handed
    back level by level. Where ranges hardly shorten the list, random coins do (a quarter at least
    is expected to go). Any list gives the same sums; elements that are close both in number and
    in the list only make it faster. Every level is written to the shared folder. A cycle is an
    error; no elements give no rows.
    """
    weights = list(weights)
    current, levels, turn = stored(links.select("element", "next", *weights), "links"), [], 0
    n = current.count()
    while True:
        blocks = max(1, -(-n // block))
        level = stored(_by_blocks(current, weights, blocks), "level")
        levels.append(level)
        if blocks == 1:
            break
        stretches = level.filter("last").select(F.col("head").alias("element"), "next", *[F.col(f"t_{w}").alias(w) for w in weights])
        m = stretches.count()
        while m > n // 2:
            turn += 1
            level = stored(_by_coins(stretches, weights, turn), "level")
            levels.append(level)
            stretches = level.filter("last").select(F.col("head").alias("element"), "next", *[F.col(f"t_{w}").alias(w) for w in weights])
            m = stretches.count()
        current, n = stretches, m
    sums = levels.pop().select("element", *[F.col(f"b_{w}").alias(w) for w in weights])
    while levels:
        heads = sums.select(F.col("element").alias("head"), *[F.col(w).alias(f"h_{w}") for w in weights])
        sums = levels.pop().join(heads, "head").select("element", *[(F.col(f"b_{w}") + F.col(f"h_{w}")).alias(w) for w in weights])
    return sums
