"""Periodic runs of words by the branching-tandem test on enhanced suffix arrays."""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import steps, texts_of

#: A run has at least so many words and so many times its period.
LEAST, TIMES = 6, 4


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Places of ``x`` (numbers from 0) sorted by what follows them; an end sorts first.

    Groups of places that agree in their first words are refined by the groups at twice the depth;
    places that are told apart already rest.
    """
    n = len(x)
    sa = np.argsort(x, kind="stable")
    new = np.concatenate(([True], x[sa[1:]] != x[sa[:-1]]))
    group = np.full(n + 1, -1, np.int64)
    group[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth = 1
    while depth < n:
        shared = ~new
        shared[:-1] |= ~new[1:]
        at = np.flatnonzero(shared)
        if not len(at):
            break
        places = sa[at]
        key = group[places] * (n + 1) + group[np.minimum(places + depth, n)] + 1
        order = np.argsort(key, kind="stable")
        places, key = places[order], key[order]
        sa[at] = places
        differs = np.concatenate(([True], key[1:] != key[:-1]))
        new[at] = differs
        group[places] = np.maximum.accumulate(np.where(differs, at, 0))
        depth *= 2
    return sa


def _common_prefixes(x: array, sa: array, rank: array) -> array:
    """Words that each suffix shares with the one before it in ``sa`` (Kasai's rule), then -1."""
    n = len(x)
    out = array("q", bytes(8 * (n + 1)))
    h = 0
    for i in range(n):
        r = rank[i]
        if not r:
            h = 0
            continue
        j = sa[r - 1]
        most = n - (i if i > j else j)
        while h < most and x[i + h] == x[j + h]:
            h += 1
        out[r] = h
        if h:
            h -= 1
    out[n] = -1
    return out


def branching_tandems(x: np.ndarray) -> set[tuple[int, int]]:
    """``(depth, place)`` of each square whose two halves are followed by different words, up to a
    ``TIMES``-th of all words deep.

    Each interval of the suffix array holds the places that share ``depth`` words. For the suffixes
    of all its children but the largest, the inverse array says whether the places ``depth`` before
    and after are in the interval too, below another child.
    """
    n = len(x)
    order = suffix_array(x)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    sa, rank, words = (array("q", np.ascontiguousarray(a, np.int64).tobytes()) for a in (order, inverse, x))
    lcp = _common_prefixes(words, sa, rank)
    deepest = n // TIMES
    found: set[tuple[int, int]] = set()
    open_: list[tuple[int, int, list[int]]] = []  # depth, first row and where further children begin
    for k in range(1, n + 1):
        shared, low = lcp[k], k - 1
        while open_ and open_[-1][0] > shared:
            depth, low, cuts = open_.pop()
            if 0 < depth <= deepest:
                edges = [low, *cuts, k]
                largest = max(range(len(cuts) + 1), key=lambda c: edges[c + 1] - edges[c])
                for c in range(len(cuts) + 1):
                    if c == largest:
                        continue
                    first, end = edges[c], edges[c + 1]
                    for i in sa[first:end]:
                        if i + depth < n and low <= (r := rank[i + depth]) < k and not first <= r < end:
                            found.add((depth, i))
                        if i >= depth and low <= (r := rank[i - depth]) < k and not first <= r < end:
                            found.add((depth, i - depth))
        if open_ and open_[-1][0] == shared:
            open_[-1][2].append(k)
        else:
            open_.append((shared, low, [k]))
    return found


def _stretch_runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, length and period of each run of a stretch of words."""
    out: list[tuple[int, int, int]] = []
    ending: dict[int, list[tuple[int, int]]] = {}
    _, x = np.unique(x, return_inverse=True)
    # A branching square is the last of its run: squares to the left of it are its rotations.
    for period, place in sorted(branching_tandems(x)):
        end = place + 2 * period
        known = ending.setdefault(end, [])
        if any(period % q == 0 and start <= place for start, q in known):
            continue  # a square of squares: the run has a smaller period
        least = end - max(LEAST, TIMES * period)
        if least < 0 or not (x[least : end - period] == x[least + period : end]).all():
            continue
        width = 64
        start = least
        while start:
            step = min(width, start)
            same = x[start - step : start] == x[start - step + period : start + period]
            if not same.all():
                start -= int(np.argmin(same[::-1]))
                break
            start -= step
            width *= 2
        known.append((start, period))
        out.append((start, end - start, period))
    return out


def word_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of each run of ``words``, by start and period.

    A run is at least ``LEAST`` words and ``TIMES`` periods long, so each of its words occurs so
    often in it: words that are rarer in their stretch cut it, until nothing changes. What stays is
    searched with a suffix array of its own; a stretch of n words takes about 150 n bytes.
    """
    counts = Counter(words)
    often = {w: i for i, (w, n) in enumerate(counts.items()) if n >= TIMES}
    if not often:
        return []
    x = np.array([often.get(w, -1) for w in words], np.int64)
    out = []
    while True:
        edge = np.diff(np.concatenate(([0], (x >= 0).astype(np.int8), [0])))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - first >= LEAST
        for a, b in zip(first[~long], end[~long]):
            x[a:b] = -1
        first, end = first[long], end[long]
        if not len(first):
            return []
        at = np.flatnonzero(x >= 0)
        key = np.repeat(np.arange(len(first)), end - first) * len(counts) + x[at]
        _, which, n = np.unique(key, return_inverse=True, return_counts=True)
        rare = at[n[which] < TIMES]
        if not len(rare):
            break
        x[rare] = -1
    for a, b in zip(first.tolist(), end.tolist()):
        out += [(a + s, n, q) for s, n, q in _stretch_runs(x[a:b])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that stand in a run after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def looped(key: str | None, words: list[bytes]) -> list[bytes]:
    """Words of a document, a part of them repeated for one document in ten.

    With h the CRC-32 of the key's text and g = h // 10: where h % 10 is 0, the words from
    g % n on become repetitions of their first 1 + (n - g % n) // (3 + g % 8).
    """
    n = len(words)
    h = zlib.crc32(key.encode()) if key is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a : a + p] * (-(-(n - a) // p))
    return words[:a] + again[: n - a]


def run_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Callable[[str | None, list[bytes]], list[bytes]] | None = None, texts: bool = True
) -> DataFrame:
    """``key``, ``n_runs``, ``start``, ``length``, ``period``, ``exponent_milli`` of the run with the
    most periods, ``runs_sha256``, ``collapsed_sha256`` and, with ``texts``,
    ``collapsed`` (the words that stay, joined by blanks) of every row.

    Each whole text is worked on by itself, without a shuffle. NULL texts have no words. ``edit``
    may change the words of a key (its text; NULL for a NULL key). Rows keep their number and their
    keys, NULL or repeated; an empty table gives no rows. Other columns are ignored.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(key).cast("string").alias("name"))
    kind = picked.schema["key"].dataType.simpleString()
    names = ["key", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed"]
    kinds = [*[pa.int64()] * 5, *[pa.string()] * 3]
    width = len(names) if texts else len(names) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for name, own in zip(batch.column("name").to_pylist(), texts_of(batch)):
                words = own.split()
                if edit is not None:
                    words = edit(name, words)
                runs = word_runs(words)
                best: tuple[int, int, int] | None = None
                for r in runs:  # by start and period: the first of equals stays
                    if best is None or r[1] * best[2] > best[1] * r[2]:
                        best = r
                told = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
                kept = b" ".join(collapsed(words, runs))
                most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                rows.append((len(runs), *most, hashlib.sha256(told).hexdigest(), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if texts else None))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds[: width - 1])]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names[:width])

    schema = f"key {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string" + ", collapsed string" * texts
    return picked.mapInArrow(run, schema).withColumnRenamed("key", key)
