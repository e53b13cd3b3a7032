"""Exact deduplication of repeated passages with suffix arrays.

Every string of ``LENGTH`` bytes has one anchor: the place of the least hash of its ``GRAM``-byte
grams. Equal strings have equal anchor grams, so only passages around grams that occur twice can
repeat. Those passages (one copy of each text of them for each task) are dealt to shards by their
anchor gram. A shard gets a suffix array by Larsson-Sadakane refinement and common prefixes by
Kasai's rule; where a shard border cuts the passages of one gram, the later shard is searched by
bisection for the strings before it. Strings that occur twice are joined back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import STEP_BYTES, steps, stored, texts_of
from cohortloom.operators.skew import spread_join

LENGTH = 200
GRAM = 64
#: Bytes of passages that one suffix array covers.
SHARD = 1 << 20
#: Passages of an anchor gram that occurs more often than this are cut into pieces of so many
#: strings, which are dealt by all that the strings of a piece have in common.
HOT, PIECE = 1024, 16
#: Where even so more different passages than this share a key, single strings are counted instead.
DEEP = 50_000
_SEGMENT = 1 << 20
_BYTE = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:8], "big") for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on; a power of two, built by doubling."""
    h, span, base = _BYTE[data], 1, _BASE
    while span < GRAM:
        h = h[:-span] * np.uint64(base) + h[span:]
        span, base = 2 * span, base * base % (1 << 64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of all strings inside the texts that begin at ``starts`` in ``data``.

    For each: text number, place of the anchor, first and last string it stands for (places in
    ``data``), and the hash of its gram. Each string has exactly one anchor.
    """
    ends = np.append(starts[1:], len(data))
    found = []
    width = length - GRAM + 1
    for s in range(0, len(data) - length + 1, _SEGMENT):
        n = min(_SEGMENT, len(data) - length + 1 - s)
        h = _gram_hashes(data[s : s + n + length - 1])
        m = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        m = np.minimum(m[:n], m[width - span : width - span + n])
        at = (m & np.uint64(0xFFFFFF)).astype(np.int64)
        doc = np.searchsorted(starts, np.arange(s, s + n), side="right") - 1
        inside = np.arange(s, s + n) + length <= ends[doc]
        new = np.concatenate(([True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]))) | ~inside
        new[1:] |= ~inside[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], n) - 1
        first, last = first[inside[first]], last[inside[first]]
        found.append((doc[first], at[first] + s, first + s, last + s, h[at[first]].view(np.int64)))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian number; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(7 + LENGTH + 8, np.uint8))).astype(np.uint64)
    w = padded
    for span in (1, 2, 4):
        w = (w[:-span] << np.uint64(8 * span)) | w[span:]
    return w


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places sorted by what follows them.

    Larsson-Sadakane: places sorted by eight bytes form groups; a group that isn't sorted yet is
    refined by the group numbers at twice the depth, groups of one rest.
    """
    n = len(data)
    w = _words(data)[:n]
    sa = np.argsort(w)
    ranked = w[sa]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if n else np.empty(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else new
    group = np.empty(n + 1, np.int64)
    group[n] = -1
    group[sa] = head
    h = 8
    while h < 2 * n:
        open_ = ~new
        open_[:-1] |= ~new[1:]
        at = np.flatnonzero(open_)
        if not len(at):
            break
        places = sa[at]
        key = group[places] * (n + 2) + group[np.minimum(places + h, n)] + 1
        order = np.argsort(key)
        places, key = places[order], key[order]
        sa[at] = places
        differs = np.concatenate(([True], key[1:] != key[:-1]))
        new[at] = differs
        group[places] = np.maximum.accumulate(np.where(differs, at, 0))
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``sa``, ``depth`` at most.

    Kasai's rule: the place after one that shares h bytes shares h - 1 at least. Stretches of the
    text go side by side, one place at a time.
    """
    n = len(sa)
    if not n:
        return np.empty(0, np.int64)
    w = _words(data)
    rank = np.empty(n, np.int64)
    rank[sa] = np.arange(n)
    before = np.where(rank > 0, sa[rank - 1], -1)
    out = np.zeros(n, np.int64)
    stretch = 64
    lanes = np.arange(0, n, stretch)
    h = np.zeros(len(lanes), np.int64)
    for t in range(stretch):
        i = lanes + t
        live = np.flatnonzero(i < n)
        i = i[live]
        j = before[i]
        own = np.where(j < 0, 0, np.maximum(h[live] - 1, 0))
        going = np.flatnonzero((j >= 0) & (own < depth))
        while len(going):
            x = w[i[going] + own[going]] ^ w[j[going] + own[going]]
            equal = np.zeros(len(going), np.int64)
            for bits in range(56, -1, -8):
                equal += (x >> np.uint64(bits)) == 0
            own[going] += equal
            going = going[(equal == 8) & (own[going] < depth)]
        own = np.minimum(np.minimum(own, depth), n - np.maximum(i, j))  # words end in zeros
        h[live] = own
        out[i] = own
    return out[sa]


def _search(data: np.ndarray, sa: np.ndarray, other: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Rank in ``sa`` of a suffix of ``data`` that begins with each string of ``other``, or -1."""
    w, v = _words(data), _words(other)

    def below(at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        less, same = np.zeros(len(at), bool), np.ones(len(at), bool)
        for k in range(0, length - 7, 8):
            a, b = w[at + k], v[place + k]
            less |= same & (a < b)
            same &= a == b
        if length % 8:
            a, b = (x >> np.uint64(64 - 8 * (length % 8)) for x in (w[at + length - length % 8], v[place + length - length % 8]))
            less |= same & (a < b)
            same &= a == b
        return less, same

    low, high = np.zeros(len(places), np.int64), np.full(len(places), len(sa))
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        less, _ = below(sa[middle], places[open_])
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    hit = np.full(len(places), -1)
    some = np.flatnonzero(low < len(sa))
    _, same = below(sa[low[some]], places[some])
    hit[some[same]] = low[some[same]]
    return hit


class _Shard:
    """Suffix array of some passages, and how often each of their strings occurs here."""

    def __init__(self, passages: list[bytes], copies: np.ndarray, length: int):
        self.data, self.starts = _joined(passages)
        sizes = np.diff(np.append(self.starts, len(self.data)))
        self.sa = suffix_array(self.data)
        shared = common_prefixes(self.data, self.sa, length)
        self.run = np.cumsum(shared < length) - 1  # equal strings follow each other
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.inside = np.arange(len(self.data)) + length <= (self.starts + sizes)[owner]
        times = np.where(self.inside, copies[owner], 0)
        self.count = np.bincount(self.run, times[self.sa], len(self.sa)).astype(np.int64)
        rank = np.empty(len(self.sa), np.int64)
        rank[self.sa] = np.arange(len(self.sa))
        self.run_of = self.run[rank]

    def repeats(self) -> np.ndarray:
        """Whether the string at each place occurs twice."""
        return self.inside & (self.count[self.run_of] > 1)


def _runs(flags: np.ndarray) -> np.ndarray:
    """First and last place of each run of true flags, in one flat array."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1), axis=1).ravel()


def repeated_strings(gram: np.ndarray, passages: list[bytes], copies: np.ndarray, length: int = LENGTH, shard: int = SHARD) -> list[np.ndarray]:
    """For each passage, runs of places where a string starts that occurs twice among all.

    ``gram`` is sorted; only passages of one gram can share strings. Shards take passages in order.
    """
    ends = np.cumsum(np.fromiter(map(len, passages), np.int64, len(passages)))
    flags: list[np.ndarray] = []
    earlier: list[tuple[_Shard, int, int]] = []  # shards that share their last gram with the next
    start = 0
    while start < len(passages):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + shard, side="right")))
        own = _Shard(passages[start:stop], copies[start:stop], length)
        twice = own.repeats()
        earlier = [e for e in earlier if gram[e[2] - 1] == gram[start]]
        for other, first, last in earlier:
            k = int(np.searchsorted(gram[first:last], gram[start]))
            places = np.flatnonzero(other.inside)
            places = places[places >= other.starts[k]]
            hit = _search(own.data, own.sa, other.data, places, length)
            places, run = places[hit >= 0], own.run[hit[hit >= 0]]
            real = own.count[run] > 0
            met = np.zeros(len(own.sa), bool)
            met[run[real]] = True
            twice |= own.inside & met[own.run_of]
            back = np.concatenate(flags[first:last])
            back[places[real]] = True
            for i, (a, b) in enumerate(zip(other.starts, [*other.starts[1:], len(other.data)])):
                flags[first + i] = back[a:b]
        flags += [twice[a:b] for a, b in zip(own.starts, [*own.starts[1:], len(own.data)])]
        earlier.append((own, start, stop))
        start = stop
    return [_runs(f) for f in flags]


def _pieces(passage: bytes, at: int, length: int) -> list[tuple[int, int, bytes]]:
    """Offset, key and bytes of the pieces of a passage whose anchor is at ``at``.

    Equal strings have their anchor at the same distance, so they fall into pieces of the same
    number, and all strings of a piece hold the bytes that are its key.
    """
    out = []
    last = len(passage) - length
    for j in range((at - last) // PIECE, at // PIECE + 1):
        high = at - PIECE * j
        core = passage[high : high - PIECE + 1 + length]
        low, high = max(0, high - PIECE + 1), min(last, high)
        out.append((low, xxhash.xxh3_64_intdigest(core, 2 + j) - (1 << 63), passage[low : high + length]))
    return out


def removals(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``d1``, ``d2`` (digests of a text) and ``runs``: flat first and last places of the strings
    of ``length`` bytes that also start elsewhere. Texts without any are left out."""
    texts = _digested(docs.select(F.col(text).cast("string").alias("text")))
    long_texts = texts.filter(F.octet_length("text") >= length)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, starts = _joined(texts_of(batch))
            doc, at, first, last, gram = anchors(data, starts, length)
            spot = ((first - starts[doc]) << 25) | ((at - first) << 13) | ((last - first) << 1)
            columns = [pa.array(gram), *(batch.column(d).take(pa.array(doc)) for d in ("d1", "d2")), pa.array(spot)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "d1", "d2", "spot"])

    grams = long_texts.mapInArrow(find, "gram bigint, d1 bigint, d2 int, spot bigint")
    again = grams.groupBy("gram").count().filter("count > 1")
    again = again.select("gram", (F.col("count") > HOT).cast("bigint").alias("frequent"))
    near = spread_join(grams, again, ["gram"], "inner").select("d1", "d2", F.col("spot").bitwiseOR(F.col("frequent")).alias("spot"))
    spots = near.groupBy("d1", "d2").agg(F.collect_set("spot").alias("spots"))
    spots = stored(spots.withColumn("doc", F.monotonically_increasing_id()), "spots")

    names = ["doc", "first", "gram", "digest", "copies", "passage"]
    kinds = [*[pa.int64()] * 5, pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each passage of each text, and one for each different passage with its bytes."""

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        held: dict[tuple[int, int], list] = {}
        met: set[int] = set()
        size = 0
        for batch in steps(batches):
            rows = []
            for doc, text_, own in zip(batch.column("doc").to_pylist(), texts_of(batch), batch.column("spots").to_pylist()):
                new = doc not in met  # the places of a repeated text are asked for once
                met.add(doc)
                for spot in own:
                    first, at, more = spot >> 25, spot >> 13 & 0xFFF, spot >> 1 & 0xFFF
                    passage = text_[first : first + more + length]
                    gram = xxhash.xxh3_64_intdigest(passage[at : at + GRAM]) - (1 << 63)
                    parts = [(0, gram, passage)] if not spot & 1 else _pieces(passage, at, length)
                    for offset, key, part in parts:
                        digest = xxhash.xxh3_64_intdigest(part, 1) - (1 << 63)
                        if new:
                            rows.append((doc, first + offset, key, digest, None, None))
                        if (known := held.get((key, digest))) is not None:
                            known[0] += 1
                        else:
                            held[key, digest] = [1, part]
                            size += len(part)
            if size > 4 * STEP_BYTES:
                rows += [(None, None, *k, *v) for k, v in held.items()]
                held, size = {}, 0
            if len(met) > 1_000_000:
                met.clear()
            if rows:
                yield out(rows)
        if held:
            yield out([(None, None, *k, *v) for k, v in held.items()])

    with_spots = long_texts.join(spots.hint("shuffle_hash"), ["d1", "d2"]).select("doc", "text", "spots")
    schema = "doc bigint, first bigint, gram bigint, digest bigint, copies bigint, passage binary"
    met = stored(with_spots.mapInArrow(cut, schema), "passages")
    given = met.filter("doc is null").select("gram", "digest", "passage", "copies")
    deep = given.groupBy("gram").count().filter(F.col("count") > DEEP).select("gram")
    deep = stored(deep, "deep")
    some_deep = not deep.isEmpty()

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        gram = np.array([r[0] for r in rows], np.int64)
        copies = np.array([r[3] for r in rows], np.int64)
        starts = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        # Where every passage of a gram has copies, all of their strings repeat anyway.
        single = np.minimum.reduceat(copies, starts) == 1
        asked = np.flatnonzero(np.repeat(single, np.diff(np.append(starts, len(rows)))))
        runs = [np.array([0, len(r[2]) - length]) for r in rows]
        if len(asked):
            for i, own in zip(asked, repeated_strings(gram[asked], [rows[i][2] for i in asked], copies[asked], length)):
                runs[i] = own
        some = [i for i, r in enumerate(runs) if len(r)]
        columns = [pa.array([rows[i][c] for i in some], pa.int64()) for c in (0, 1)]
        columns.append(pa.array([runs[i].tolist() for i in some], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, ["gram", "digest", "found"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in steps(batches, "passage")):
            if held and row[:2] == held[-1][:2]:  # the same passage, met by another task
                held[-1] = (*held[-1][:3], held[-1][3] + row[3])
                continue
            if size > 4 * SHARD and row[0] != held[-1][0]:
                yield solved(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2])
        if held:
            yield solved(held)

    found = "gram bigint, digest bigint, found array<int>"
    usual = spread_join(given, deep, ["gram"], "left_anti") if some_deep else given
    dealt = usual.select("gram", "digest", "passage", "copies").repartition("gram").sortWithinPartitions("gram", "digest")
    repeats = dealt.mapInArrow(shards, found)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "passage"):
            passages = batch.column("passage").to_pylist()
            counts = np.array([len(p) - length + 1 for p in passages], np.int64)
            row = pa.array(np.repeat(np.arange(len(passages)), counts))
            own = [xxhash.xxh3_128_digest(p[i : i + length]) for p, n in zip(passages, counts.tolist()) for i in range(n)]
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in counts]) if len(counts) else np.empty(0, np.int32)
            columns = [*(batch.column(c).take(row) for c in ("gram", "digest", "copies")), pa.array(places), pa.array(own, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "digest", "copies", "place", "string"])

    if some_deep:
        given = spread_join(given, deep, ["gram"], "left_semi").select("gram", "digest", "passage", "copies")
        single = given.mapInArrow(strings, "gram bigint, digest bigint, copies bigint, place int, string binary")
        twice = single.groupBy("string").agg(F.sum("copies").alias("n")).filter("n > 1").select("string")
        by_string = spread_join(single, twice, ["string"], "left_semi").groupBy("gram", "digest")
        by_string = by_string.agg(F.flatten(F.collect_set(F.array("place", "place"))).alias("found"))
        repeats = repeats.unionByName(by_string)
    wanted = met.filter("doc is not null").select("doc", "first", "gram", "digest")
    placed = spread_join(wanted, repeats, ["gram", "digest"], "inner")
    moved = placed.select("doc", F.transform("found", lambda x: x + F.col("first")).alias("found"))
    runs = moved.groupBy("doc").agg(F.flatten(F.collect_set("found")).alias("runs"))
    return spots.select("doc", "d1", "d2").join(runs, "doc").select("d1", "d2", "runs")


def _digested(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumns({"d1": F.xxhash64(text), "d2": F.hash(text)})


def _spans(runs: list[int] | None, size: int, length: int) -> np.ndarray:
    """Removed spans (first, end) of a text, merged and in order."""
    change = np.zeros(size + 1, np.int64)
    pairs = np.array(runs or [], np.int64).reshape(-1, 2)
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 1] + length, -1)
    covered = np.cumsum(change[:-1]) > 0
    flat = _runs(covered).reshape(-1, 2)
    flat[:, 1] += 1
    return flat


def removed_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``text``, ``row`` (the other columns of ``docs``) and ``runs``, from which ``_spans`` gives what
    to remove (NULL: nothing)."""
    runs = removals(docs, text, length)
    own = F.col(text).cast("string")
    row = F.struct(F.lit(0).alias(text), *[c for c in docs.columns if c != text])
    marked = docs.select(own.alias("text"), row.alias("row"), F.xxhash64(own).alias("d1"), F.hash(own).alias("d2"))
    return marked.join(runs.hint("shuffle_hash"), ["d1", "d2"], "left").select("text", "row", "runs")


def removal_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row.

    Each byte goes that is covered by a string of ``length`` bytes which also starts anywhere else,
    in this or another row; overlapping starts count. NULL texts are empty. Rows are told apart,
    so repeated rows (equal, NULL or differing keys alike) remove all of their text if it is long
    enough. Other columns are ignored.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for own, runs in zip(texts_of(batch), batch.column("runs").to_pylist()):
                spans = _spans(runs, len(own), length)
                rows.append((len(own), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), hashlib.sha256(_kept(own, spans)).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return removed_spans(picked, "text", length).select("row.key", "text", "runs").mapInArrow(run, schema).withColumnRenamed("key", key)


def _kept(text: bytes, spans: np.ndarray) -> bytes:
    cuts = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def without_repeats(docs: DataFrame, text: str = "text", chars: str = "n_chars", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated passages removed from the texts and ``chars``, if there, counted anew.

    Removal goes by bytes; what it leaves of a cut character is dropped. NULL texts stay NULL.
    Columns may have any names: rows travel as one value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            new: list[str | None] = []
            null = batch.column("text").is_null().to_pylist()
            for own, runs, empty in zip(texts_of(batch), batch.column("runs").to_pylist(), null):
                new.append(None if empty else _kept(own, _spans(runs, len(own), length)).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()), batch.column("row")], ["new", "row"])

    marked = removed_spans(docs, text, length)
    made = marked.mapInArrow(run, T.StructType([T.StructField("new", T.StringType()), marked.schema["row"]]))
    counted = F.char_length("new").cast(docs.schema[chars].dataType) if chars in docs.columns else None
    return made.select(*[F.col("new").alias(c) if c == text else counted.alias(c) if c == chars else F.col("row")[c].alias(c) for c in docs.columns])
