"""SimHash near-duplicates by an inverted index over byte positions with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import steps, stored, texts_of
from cohortloom.llm.components import components
from cohortloom.operators.skew import spread_join

BITS = 3
SHINGLE = 3
SEED = 42
POSITIONS = 8
#: Three differing bits touch at most three bytes: so many positions agree at least.
MIN_MATCHES = POSITIONS - BITS
#: Postings with more fingerprints than this are dealt anew by one more position.
HOT = 4096


def _position_sets() -> list[tuple[int, ...]]:
    """14 sets of four positions, of which every five positions contain one.

    Both halves of the eight positions, and the unions of a pair of the first half and a pair of the
    second that belong to matchings of the same number. Three positions of one half hold one pair
    of each of its three matchings.
    """
    halves = ((0, 1, 2, 3), (4, 5, 6, 7))
    pairs = []
    for a, b, c, d in halves:
        pairs.append((((a, b), (c, d)), ((a, c), (b, d)), ((a, d), (b, c))))
    mixed = [x + y for first, second in zip(*pairs) for x in first for y in second]
    return [*halves, *mixed]


SETS = _position_sets()


def _fingerprints(texts: list[bytes]) -> np.ndarray:
    """Unsigned 64-bit fingerprints of UTF-8 texts."""
    digest = xxhash.xxh64_intdigest
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        words = text.lower().split()  # of bytes: A-Z only, ASCII blanks only
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) < SHINGLE:
            own = [digest(joined, SEED)]
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-SHINGLE])).tolist()
            own = [digest(joined[s:e], SEED) for s, e in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
        big_endian = np.array(own, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = np.unpackbits(big_endian, axis=1).sum(axis=0, dtype=np.int32)
        out[i] = weights[2 * ones > len(own)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed long) of every row.

    A bit is set if it is set in more than half of the XXH64 of the 3-word shingles, repeats counted.
    Shorter texts have one shingle; NULL, empty and blank texts have fingerprint 0. Rows keep their
    number: repeated rows, equal and NULL keys give a row each.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            fp = _fingerprints(texts_of(batch)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["key", "fp"])

    return picked.mapInArrow(run, f"key {kind}, fp bigint").withColumnRenamed("key", key)


def _byte(i: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))


def _posting(number: int, positions: tuple[int, ...]) -> Column:
    """Set number and the bytes at its positions in one long."""
    key = F.lit(number).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(p))
    return key


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index connected with each of ``n`` indices by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]


def _close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Count filter, then check: enough equal byte positions and few differing bits."""
    differing = x ^ y
    bytes_ = differing.view(np.uint8).reshape(*differing.shape, POSITIONS)
    matches = (bytes_ == 0).sum(axis=-1)
    return (matches >= MIN_MATCHES) & (np.bitwise_count(differing) <= BITS)


def _wide_links(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one large posting as index pairs, as many as fingerprints at most.

    By blocks of pairs; beyond 16,384 fingerprints by looking up every text of up to three flipped
    bits among those bits that differ at all, which grows with the fingerprints, not their square.
    """
    n = len(fp)
    root = np.arange(n)
    if n <= 16_384:
        for i in range(0, n, 512):
            for j in range(i, n, 2048):
                hit = np.argwhere(_close(fp[i : i + 512, None], fp[None, j : j + 2048]))
                a, b = root[hit[:, 0] + i], root[hit[:, 1] + j]
                root = _roots(n, np.concatenate((np.arange(n), a)), np.concatenate((root, b)))
    else:
        order = np.argsort(fp)
        ranked = fp[order]
        free = [np.uint64(1) << np.uint64(b) for b in range(64) if ((fp ^ fp[0]) >> np.uint64(b) & np.uint64(1)).any()]
        for flips in chain.from_iterable(combinations(free, r) for r in range(1, BITS + 1)):
            other = fp ^ np.bitwise_or.reduce(np.array(flips, np.uint64))
            at = np.minimum(np.searchsorted(ranked, other), n - 1)
            a = np.flatnonzero(ranked[at] == other)
            root = _roots(n, np.concatenate((np.arange(n), a)), np.concatenate((root, order[at[a]])))
    own = np.flatnonzero(root != np.arange(n))
    return own, root[own]


def _links(posting: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within sorted postings: (fingerprint, least linked one), at most one for each row."""
    starts = np.flatnonzero(np.concatenate(([True], posting[1:] != posting[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(posting)])))
    size = np.repeat(sizes, sizes)
    small = (size > 1) & (size <= 64)
    a, b = [], []
    for lag in range(1, int(size[small].max()) if small.any() else 0):
        at = np.flatnonzero(small[:-lag] & (posting[lag:] == posting[:-lag]))
        at = at[_close(fp[at], fp[at + lag])]
        a.append(at + lag)
        b.append(at)
    for start, n in zip(starts[sizes > 64], sizes[sizes > 64]):
        x, y = _wide_links(fp[start : start + n])
        a.append(x + start)
        b.append(y + start)
    if not a:
        return fp[:0], fp[:0]
    root = _roots(len(fp), np.concatenate(a), np.concatenate(b))
    own = np.flatnonzero(root != np.arange(len(fp)))
    return fp[own], fp[root[own]]


def links(fps: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints ``fp`` that connect whatever is close.

    Two fingerprints with at most three differing bits agree in at least five of eight byte
    positions, so they meet in a posting of one of 14 sets of four positions. A posting with more
    than ``HOT`` fingerprints is replaced by postings of one more position (of the other four, one
    agrees at least), which hold at most 2^24 fingerprints. Within a posting shared positional
    bytes are counted, pairs with fewer than five dropped, the rest checked bit by bit; a spanning
    forest of the links leaves the task, not all pairs.
    """
    four = fps.select(
        "fp",
        F.explode(F.array(*[_posting(i, s) for i, s in enumerate(SETS)])).alias("posting"),
    )
    hot = four.groupBy("posting").count().filter(F.col("count") > HOT).select("posting", F.lit(True).alias("hot"))
    flagged = spread_join(four, hot, ["posting"], "left")
    more = F.lit(None)
    for i, s in enumerate(SETS):
        rest = [p for p in range(POSITIONS) if p not in s]
        five = F.array(*[_posting(len(SETS) + POSITIONS * i + p, (*s, p)) for p in rest])
        more = F.when(F.shiftright("posting", 32) == i, five).otherwise(more)
    finer = flagged.select("fp", F.explode(F.when(F.col("hot"), more).otherwise(F.array("posting"))).alias("posting"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_p, kept_f = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in chain(batches, [None]):
            if batch is not None:
                kept_p = np.concatenate((kept_p, batch.column(0).to_numpy()))
                kept_f = np.concatenate((kept_f, batch.column(1).to_numpy().view(np.uint64)))
                end = int(np.searchsorted(kept_p, kept_p[-1])) if len(kept_p) else 0
            else:
                end = len(kept_p)
            if end:
                u, v = _links(kept_p[:end], kept_f[:end])
                kept_p, kept_f = kept_p[end:], kept_f[end:]
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    dealt = finer.select("posting", "fp").repartition("posting").sortWithinPartitions("posting", "fp")
    return dealt.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the least key reachable over links) of every row.

    Equal fingerprints meet before links are sought, so a group of copies of any size is one
    fingerprint. A row with NULL key takes part but names no component unless it is alone (NULL).
    An empty table gives no rows; other columns of ``docs`` are ignored.
    """
    fps = stored(fingerprints(docs, key, text), "simhash")
    own = fps.groupBy("fp").agg(F.min(key).alias("least"))
    root = components(links(own.select("fp")))
    placed = own.join(root, own["fp"] == root["node"], "left").select(
        own["fp"], "least", F.coalesce("root", own["fp"]).alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = spread_join(placed.select("fp", "root"), named, ["root"], "left").select("fp", "component_id")
    return spread_join(fps, of_fp, ["fp"], "left").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least key.

    Rows that share that key stay if their own text belongs to the group, once for each different
    text. Rows with NULL key stay, once for each different text, where no row of their group has a
    key. Columns may have any names: rows travel as one value.
    """
    groups = stored(near_duplicates(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text"), "groups")
    packed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct("*").alias("row"))
    least = F.col("key") == F.col("component_id")
    rows = groups.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.max(least).alias("kept"))
    kept = rows.filter("kept")
    single = packed.join(kept.filter("n = 1").select("key"), "key", "left_semi")
    shared = _marked(packed.join(kept.filter("n > 1").select("key"), "key", "left_semi"))
    own = groups.filter(least).select("key", "fp").distinct()
    repeated = shared.join(own, ["key", "fp"], "left_semi").dropDuplicates(["key", "text"])
    # Groups in which no row has a key.
    wanted = groups.filter("component_id IS NULL").select("fp").distinct()
    unnamed = _marked(packed.filter("key IS NULL")).join(wanted, "fp", "left_semi").dropDuplicates(["text"])
    return single.select("row.*").unionByName(repeated.select("row.*")).unionByName(unnamed.select("row.*"))


def _marked(packed: DataFrame) -> DataFrame:
    """Rows of ``key``, ``text`` and ``row`` with the fingerprint of the text as ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            fp = pa.array(_fingerprints(texts_of(batch)).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fp], [*batch.schema.names, "fp"])

    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField("fp", T.LongType())]))
