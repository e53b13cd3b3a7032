"""Byte-level BPE encoding by segment trees over adjacent pair ranks, and decoding."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import steps, texts_of

#: Texts are cut into these pieces before any merge (the byte-level rule of the vocabulary).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encodings of pieces that a task remembers; it forgets all and goes on beyond that.
REMEMBERED = 500_000
NONE = np.int64(1) << 62
#: Pieces of more bytes than this go alone where fewer than so many of their length come together.
LONE, LANES = 1024, 32


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges by rank and special strings of a byte-level BPE file."""

    def __init__(self, text: str):
        file = json.loads(text)
        letters = byte_letters()
        ids: dict[str, int] = file["model"]["vocab"]
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in added.items()}
        self.bytes_of = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for s, i in ids.items():
            self.bytes_of[i] = bytes(letters[c] for c in s)
        for s, i in added.items():
            self.bytes_of[i] = s.encode()
        self.first = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.first[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.span = len(self.bytes_of)
        pair = np.array([ids[a] * self.span + ids[b] for a, b in merges], np.int64)
        order = np.argsort(pair)
        self.pair, self.rank = pair[order], order.astype(np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.by_pair: dict[int, int] | None = None
        self.cut = regex.compile(PIECES)
        longest = sorted(self.special, key=len, reverse=True)
        self.mark = regex.compile("|".join(map(regex.escape, longest))) if longest else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NONE where they don't merge or one is missing (-1)."""
        key = a.astype(np.int64) * self.span + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (a >= 0) & (b >= 0), self.rank[at], NONE)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each piece; pieces of like length go in lockstep.

        Each piece has a segment tree whose leaves are the ranks of its adjacent pairs, tied to
        their places, so that its root is the leftmost lowest-rank merge. A merge changes three
        leaves (the pair itself, the one before, the one that vanishes) and the nodes above them.
        """
        out = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        shorter, width = 0, 2
        while (lengths > shorter).any():
            at = np.flatnonzero((lengths > shorter) & (lengths <= width))
            if width > LONE and len(at) < LANES:  # too few for a lockstep to pay
                for i in at.tolist():
                    out[i] = self._alone(pieces[i])
                at = at[:0]
            most = max(1, (1 << 20) // width)
            for i in range(0, len(at), most):
                self._lockstep(pieces, at[i : i + most], lengths, width, out)
            shorter, width = width, 2 * width
        return out

    def _lockstep(self, pieces: list[bytes], at: np.ndarray, lengths: np.ndarray, width: int, out: list[bytes]) -> None:
        if not len(at):
            return
        n, size = len(at), lengths[at]
        kind = np.int32 if self.span * width < 1 << 31 else np.int64
        none = np.iinfo(kind).max
        inside = np.arange(width) < size[:, None]
        ids = np.full((n, width + 1), -1, np.int32)  # the last column stands for "no symbol"
        ids[:, :-1][inside] = self.first[np.frombuffer(b"".join([pieces[i] for i in at]), np.uint8)]
        after = np.broadcast_to(np.arange(1, width + 1, dtype=np.int32), (n, width)).copy()
        after[after >= size[:, None]] = width
        before = np.broadcast_to(np.arange(-1, width, dtype=np.int32), (n, width + 1)).copy()
        tree = np.full((n, 2 * width), none, kind)
        rank = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        tree[:, width:] = np.where(rank < NONE, rank * width + np.arange(width), none)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = tree[:, level : 2 * level].reshape(n, -1, 2).min(axis=2)
            level //= 2
        flat, symbols, nexts, lasts = tree.reshape(-1), ids.reshape(-1), after.reshape(-1), before.reshape(-1)
        row = np.flatnonzero(tree[:, 1] < none)
        while len(row):
            rank, p = np.divmod(tree[row, 1].astype(np.int64), width)
            at_next, at_id, at_tree = row * width, row * (width + 1), row * (2 * width)
            q = nexts[at_next + p].astype(np.int64)
            r = nexts[at_next + q].astype(np.int64)
            made = self.made[rank]
            symbols[at_id + p] = made
            symbols[at_id + q] = -1
            nexts[at_next + p] = r
            o = lasts[at_id + p].astype(np.int64)
            lasts[at_id + r] = p
            right = self.ranks(made, symbols[at_id + r])
            left = self.ranks(np.where(o < 0, -1, symbols[at_id + o]), made)
            o = np.where(o < 0, q, o)  # without a pair before, the vanished leaf is set again
            leaf = np.concatenate((q, p, o))
            rank = np.concatenate((np.full(len(row), NONE), right, np.where(o == q, NONE, left)))
            base = np.concatenate((at_tree, at_tree, at_tree))
            node = width + leaf
            flat[base + node] = np.where(rank < NONE, rank * width + leaf, none)
            while (node := node >> 1)[0]:
                below = base + 2 * node
                flat[base + node] = np.minimum(flat[below], flat[below + 1])
            row = row[tree[row, 1] < none]
        ids = ids[:, :-1]
        kept = ids >= 0
        joined = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 4
        start = 0
        for i, end in zip(at.tolist(), ends.tolist()):
            out[i] = joined[start:end]
            start = end

    def _alone(self, piece: bytes) -> bytes:
        """Ids of one long piece by the same tree, a merge at a time."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        if self.by_pair is None:
            self.by_pair = dict(zip(self.pair.tolist(), self.rank.tolist()))
        by_pair, span, made_of = self.by_pair, self.span, self.made
        first = self.first[np.frombuffer(piece, np.uint8)]
        rank = self.ranks(first[:-1], first[1:])
        level = np.full(width, NONE)
        level[: n - 1] = np.where(rank < NONE, rank * width + np.arange(n - 1), NONE)
        levels = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2).min(axis=1)
            levels.append(level)
        none = int(NONE)
        tree = array("q", np.concatenate(([NONE], *reversed(levels))).tobytes())
        ids = array("q", first.astype(np.int64).tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n))

        def put(leaf: int, value: int) -> None:
            node = width + leaf
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            order, p = divmod(tree[1], width)
            q = after[p]
            r = after[q]
            made = int(made_of[order])
            ids[p], ids[q], after[p], before[r] = made, -1, r, p
            put(q, none)
            order = by_pair.get(made * span + ids[r]) if r < n else None
            put(p, none if order is None else order * width + p)
            o = before[p]
            if o >= 0:
                order = by_pair.get(ids[o] * span + made)
                put(o, none if order is None else order * width + o)
        left = np.frombuffer(ids, np.int64)
        return left[left >= 0].astype("<u4").tobytes()

    def encode(self, texts: list[str], known: dict[str, bytes]) -> list[bytes]:
        """Ids of each whole text, special strings included. ``known`` remembers pieces."""
        cut, mark = self.cut, self.mark
        pieces: list[list[str]] = []
        for text in texts:
            if mark is None or mark.search(text) is None:
                pieces.append(cut.findall(text))
                continue
            own, start = [], 0
            for m in mark.finditer(text):
                own += [*cut.findall(text[start : m.start()]), m[0]]
                start = m.end()
            pieces.append(own + cut.findall(text[start:]))
        if len(known) > REMEMBERED:
            known.clear()
            known.update(self.special)
        new = list({p for own in pieces for p in own if p not in known})
        known.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        return [b"".join([known[p] for p in own]) for own in pieces]

    def decode(self, ids: bytes) -> str:
        """Text of ids, special strings kept; malformed UTF-8 becomes replacement characters."""
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` of every row's whole text.

    ``path`` is a byte-level BPE file of the tokenizers library; the driver reads it and sends it
    to the tasks (its size is that of the vocabulary). NULL texts count as empty: no ids, empty
    text. Rows keep their number and their keys, NULL or repeated. Other columns are ignored.
    """
    return _mapped(docs, path, key, text, "ids binary, decoded string", lambda ids, back: [pa.array(ids), pa.array(back)])


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and the SHA-256 of the ids and of the text decoded from them."""

    def made(ids: list[bytes], back: list[str]) -> list[pa.Array]:
        return [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back]),
        ]

    return _mapped(docs, path, key, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", made)


def _mapped(docs: DataFrame, path: str, key: str, text: str, schema: str, made) -> DataFrame:
    with open(path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    names = ["key", *[c.split(" ")[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        known = dict(vocabulary.special)
        for batch in steps(batches):
            ids = vocabulary.encode([t.decode("utf-8", "replace") for t in texts_of(batch)], known)
            columns = made(ids, [vocabulary.decode(x) for x in ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return picked.mapInArrow(run, f"key {kind}, {schema}").withColumnRenamed("key", key)
