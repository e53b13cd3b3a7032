"""Token ids in word-aligned binary files (Simple-8b), in the order of the documents' keys."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm.bpe import byte_letters
from cohortloom.llm.common import steps, texts_of
from cohortloom.session import delete_on_exit, new_shared_path

# Fixed values of the format: how many ids a word packs under each selector, and of how many bits.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC, END = b"S8BFRAME", "\nS8BEND\n"
#: Payload of a word whose id stands among the escapes.
ESCAPE = np.uint64((1 << 60) - 1)
#: Ids of a block; a block starts at a word of its own.
BLOCK = 256
#: A frame is closed at the end of the document that brings it to so many ids.
FRAME = 1 << 18
#: Frames of a file.
FRAMES = 16
#: Bytes of text of a part, on average.
PART = 64 << 20
#: Encodings of pieces that a task remembers; it forgets all and goes on beyond that.
REMEMBERED = 300_000
_HEAD = "<8sIIQQQQQQ"


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words``, first word of each block (``offsets``) and ``escapes`` of unsigned 64-bit ids.

    A word has its selector in the upper four bits and takes as many of the next ids of its block
    as fit. Blocks go in lockstep, a word of each block at a time. Ids of 2^60 - 1 and above are
    escapes, kept apart in order.
    """
    n = len(ids)
    n_blocks = -(-n // block)
    values = np.zeros(n_blocks * block + COUNTS[0], np.uint64)
    values[:n] = ids
    escapes = values[values >= ESCAPE]
    values = np.minimum(values, ESCAPE)
    need = np.frexp((values >> np.uint64(30)).astype(np.float64))[1].astype(np.uint8)
    need = np.where(need, need + 30, np.frexp((values & np.uint64((1 << 30) - 1)).astype(np.float64))[1]).astype(np.uint8)
    # Past the end of its block a word may take anything: those bits are written as zeros.
    grid = np.zeros((n_blocks, block + COUNTS[0]), np.uint8)
    grid[:, :block] = need[: n_blocks * block].reshape(-1, block)
    choice = np.full((n_blocks, block), 255, np.uint8)
    most = {1: grid}
    for count in sorted(set(COUNTS.tolist()) - {1}):
        half = max(c for c in most if c < count)
        shift = count - half
        if shift > half:  # two windows of the largest width so far don't reach
            double = most[half].copy()
            double[:, :-half] = np.maximum(double[:, :-half], most[half][:, half:])
            most[2 * half] = double
            half, shift = 2 * half, count - 2 * half
        wide = most[half].copy()
        if shift:
            wide[:, :-shift] = np.maximum(wide[:, :-shift], most[half][:, shift:])
        most[count] = wide
    for selector in range(len(COUNTS) - 1, -1, -1):
        choice[most[int(COUNTS[selector])][:, :block] <= BITS[selector]] = selector
    lane = np.arange(n_blocks)
    at = np.zeros(n_blocks, np.int64)
    size = np.minimum(block, n - lane * block)
    lanes, places = [], []
    while len(lane):
        lanes.append(lane)
        places.append(at)
        at = at + COUNTS[choice[lane, at]]
        going = at < size[lane]
        lane, at = lane[going], at[going]
    if not lanes:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), escapes
    order = np.argsort(np.concatenate(lanes), kind="stable")
    lane, at = np.concatenate(lanes)[order], np.concatenate(places)[order]
    selector = choice[lane, at]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        for j in range(COUNTS[s] if BITS[s] else 0):
            inside = of[at[of] + j < size[lane[of]]]
            words[inside] |= values[lane[inside] * block + at[inside] + j] << np.uint64(j * BITS[s])
    return words, np.searchsorted(lane, np.arange(n_blocks)).astype(np.uint32), escapes


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids that ``pack`` made ``words`` of; all blocks are decoded at once."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    before = np.cumsum(count) - count
    lane = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    at = before - before[offsets][lane]
    out = np.zeros((len(offsets), block + COUNTS[0]), np.uint64)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(COUNTS[s] if BITS[s] else 0):
            out[lane[of], at[of] + j] = (words[of] >> np.uint64(j * BITS[s])) & mask
    ids = out[:, :block].reshape(-1)[:n].copy()
    marked = np.flatnonzero(ids == ESCAPE)
    if len(marked) != len(escapes):
        raise ValueError(f"{len(escapes)} escapes for {len(marked)} marks")
    ids[marked] = escapes
    return ids


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def frame_bytes(part: int, frame: int, start: int, keys: list[str | None], ids: list[np.ndarray]) -> bytes:
    """A frame of whole documents: head, keys, ids per document, block offsets, words, escapes.

    Every section is filled up to whole 64-bit words, all numbers are little-endian. ``start`` is
    the number of ids of the part before the frame.
    """
    names = [b"" if k is None else k.encode() for k in keys]
    sizes = np.array([-1 if k is None else len(b) for k, b in zip(keys, names)], "<i8")
    words, offsets, escapes = pack(np.concatenate(ids) if ids else np.empty(0, np.uint64))
    text = b"".join(names)
    lengths = np.fromiter(map(len, ids), "<u8", len(ids))
    head = struct.pack(_HEAD, MAGIC, part, frame, start, len(ids), int(lengths.sum()), len(text), len(words), len(escapes))
    parts = [sizes.tobytes(), _padded(text), lengths.tobytes(), _padded(offsets.astype("<u4").tobytes())]
    return b"".join([head, *parts, words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def frames_of(data: bytes) -> Iterator[tuple[int, int, list[str | None], np.ndarray, np.ndarray]]:
    """Part, start in the part, keys, ids per document and all ids of each frame of a file."""
    at, end = 0, END.encode()
    while at < len(data):
        magic, part, _, start, n_docs, n_ids, n_text, n_words, n_escapes = struct.unpack_from(_HEAD, data, at)
        if magic != MAGIC:
            raise ValueError(f"no frame at byte {at}")
        at += struct.calcsize(_HEAD)
        n_blocks = -(-n_ids // BLOCK)

        def took(n: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += -(-found.nbytes // 8) * 8
            return found

        sizes, text = took(n_docs, "<i8"), took(n_text, "u1").tobytes()
        lengths, offsets = took(n_docs, "<u8").astype(np.int64), took(n_blocks, "<u4")
        words, escapes = took(n_words, "<u8"), took(n_escapes, "<u8")
        if data[at : at + len(end)] != end or lengths.sum() != n_ids:
            raise ValueError(f"frame before byte {at} is cut")
        at += len(end)
        stops = np.cumsum(np.maximum(sizes, 0))
        keys = [None if n < 0 else text[s - n : s].decode() for n, s in zip(sizes.tolist(), stops.tolist())]
        yield part, start, keys, lengths, unpack(words, offsets, escapes, n_ids)


# Characters of the cut that have kept their class in all versions of Unicode since 1.1.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"


class Encoder:
    """Encodes whole texts as the library does, each different piece of common letters only once.

    Texts of characters of Latin script below U+0180 (but U+0130, which is lower-cased to two) are
    in normal form, so the file's rule cuts them after lower-casing; the library's model encodes
    each piece. Texts with any other character, and those with special strings, go to the library
    whole. A file of another kind of rule goes to the library throughout.
    """

    def __init__(self, file: str):
        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        marks = "'s|'t|'re|'ve|'m|'ll|'d|"
        rule = marks + r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        lower = '"Lowercase"' in file and '"NFC"' in file and '"</w>"' in file
        self.known: dict[str, bytes] | None = {} if lower and rule.replace("\\", "\\\\") in file else None
        self.plain = re.compile("[\t\n\r\x20-\x7e¡-įı-ſ]*")
        self.cut = re.compile(f"{marks}[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = {b: c for c, b in byte_letters().items()}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        by_pieces = [self.known is not None and self.plain.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts]
        whole = iter(self.library.encode_batch([t for t, p in zip(texts, by_pieces) if not p], add_special_tokens=False))
        return [self._pieces(t) if p else np.array(next(whole).ids, "<u4") for t, p in zip(texts, by_pieces)]

    def _pieces(self, text: str) -> np.ndarray:
        pieces, known = self.cut.findall(text.lower()), self.known
        for p in set(pieces).difference(known):
            form = p if p.isascii() else "".join([self.letters[b] for b in p.encode()])
            known[p] = np.array([t.id for t in self.library.model.tokenize(form)], "<u4").tobytes()
        joined = b"".join([known[p] for p in pieces])
        if len(known) > REMEMBERED:
            known.clear()
        return np.frombuffer(joined, "<u4")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, part: int = PART) -> None:
    """Encode whole texts, each followed by ``end_id``, into files below ``path``.

    ``tokenizer`` is a file of the tokenizers library; the driver reads it and sends it to the
    tasks. Documents are dealt by ranges of their key (NULL first), rows of one key by a digest of
    their text, equal rows by their place in the input, so no key is bound to one task. Each part
    writes its frames to ``kind=ids`` and one line (part, ids) to ``kind=index`` in one commit of
    Spark's text writer, which keeps bytes as they are: lost executors leave no half files. A file
    holds ``FRAMES`` frames of whole documents, so its size is bounded by that of a document.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    order = ["key", "tie", "place"]
    rows = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(max(1, -(-size // part)), *[F.asc_nulls_first(c) for c in order])
    dealt = dealt.sortWithinPartitions(*[F.asc_nulls_first(c) for c in order]).select(F.col("key").cast("string").alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        number = TaskContext.get().partitionId()
        keys: list[str | None] = []
        held: list[np.ndarray] = []
        frame = total = since = 0

        def row(kind: str, value: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([frame], pa.int64()), pa.array([value], pa.binary())], ["kind", "frame", "value"])

        for batch in steps(batches):
            encoded = encoder.encode([t.decode("utf-8", "replace") for t in texts_of(batch)])
            for k, ids in zip(batch.column("key").to_pylist(), encoded):
                keys.append(k)
                held.append(np.append(ids, np.uint32(end_id)))
                total += len(held[-1])
                if total - since >= FRAME:
                    yield row("ids", frame_bytes(number, frame, since, keys, held))
                    keys, held, since, frame = [], [], total, frame + 1
        if held:
            yield row("ids", frame_bytes(number, frame, since, keys, held))
        if total:
            yield row("index", f"{number},{total}".encode())

    made = dealt.mapInArrow(run, "kind string, frame bigint, value binary").sortWithinPartitions("kind", "frame")
    made = made.select("kind", F.col("value").cast("string").alias("value"))
    made.write.partitionBy("kind").option("lineSep", END).option("maxRecordsPerFile", FRAMES).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``key`` (text), ``start``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of every
    document of the files below ``path``. A file is read by one task; a malformed one fails.

    ``start``, the ids of all documents before it, is its start in its part plus the ids of the
    parts before, from the index (one row for each part of some 64 MB of text).
    """
    names = ["part", "key", "at", "n_tokens", "ids"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for part, start, keys, lengths, ids in frames_of(content.as_py()):
                    stops = np.cumsum(lengths)
                    data = memoryview(ids.astype("<u4").tobytes())
                    own = [bytes(data[4 * (s - n) : 4 * s]) for n, s in zip(lengths.tolist(), stops.tolist())]
                    columns = [[part] * len(keys), keys, start + stops - lengths, lengths, own]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    index = spark.read.schema("value string").option("lineSep", END).text(f"{path}/kind=index").select(F.split("value", ",").cast("array<bigint>").alias("v"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.select(F.col("v")[0].alias("part"), F.col("v")[1].alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/kind=ids").select("content")
    found = files.mapInArrow(run, "part bigint, key string, at bigint, n_tokens bigint, ids binary")
    return found.join(parts, "part").select("key", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def filed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 1) -> DataFrame:
    """Write the documents' token files to the shared folder and read them back: ``key``,
    ``start``, ``n_tokens``, ``ids_crc32`` of every row.

    NULL and empty texts have the end id only. NULL keys come first; rows of one key are ordered by
    a digest of their text. Repeated rows keep their number. An empty table gives no rows. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    if docs.isEmpty():
        return spark.createDataFrame([], f"{key} {kind.simpleString()}, start bigint, n_tokens bigint, ids_crc32 bigint")
    path = new_shared_path(spark, "llm-tokens")
    write_token_files(docs, tokenizer, path, key, text, end_id)
    delete_on_exit(spark, path)
    return read_token_files(spark, path).select(F.col("key").cast(kind).alias(key), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
