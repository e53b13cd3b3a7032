"""Prefix tries of conversations with subtree sums by the Euler-tour technique.

A node is a different sequence of first turns. Its key is its depth and the exclusive-or of two
64-bit hashes of each turn with its place, so keys of long conversations are put together from
pieces that different tasks have worked on. Each node has an enter and an exit arc; the arcs form
one list, the tour, and what lies below a node stands between its two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored
from cohortloom.llm.listrank import list_ranks
from cohortloom.operators.skew import spread_join

#: Nodes of one range of node numbers, on average.
RANGE = 1 << 15
#: Bytes of text that a digest takes at a time.
CHUNK = 1 << 20


def _place() -> Column:
    """Upper part of a number by ``monotonically_increasing_id``: the partition."""
    return F.shiftright("at", 33)


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``p`` (1, 2, ...), ``part``, ``n_own`` and the digests and bytes of every turn.

    Turns are ordered by ``turn`` (NULL first), then role and text (NULL is empty), equal ones by
    their place in the input. Ranges of that order are dealt out, so that a conversation of very
    many turns stands in several tasks; ``part`` tells which. Rows without a conversation are left
    out.
    """
    clean = conversations.select(
        F.col(conv).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))],
        F.monotonically_increasing_id().alias("place"),
    ).filter("conv IS NOT NULL")
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "text", "place")]
    digests = [F.xxhash64(F.lit(s), "role", "text").alias(f"d{s}") for s in (1, 2)]
    ranged = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.select("conv", *digests, F.octet_length("text").cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("at")), "turns")
    pieces = rows.groupBy("conv", _place().alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("conv")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"), F.sum("n").over(own).alias("n_own"))
    joined = rows.withColumn("part", _place()).join(pieces, ["conv", "part"])
    return joined.select("conv", (F.col("at") + F.col("shift")).alias("p"), "part", "n_own", "d1", "d2", "bytes")


def rebuilt(turns: DataFrame, every: int = 5, kinds: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the turns of another: ``turns`` and ``convs`` for ``trie``.

    ``turns`` are those of ``numbered``. Conversation c gets the first h turns of c - c % ``every``
    (all if it has fewer, none if there is no such one), then its own after the first h, with h the
    CRC-32 of c in decimals modulo ``kinds``.
    """
    turns = stored(turns, "numbered")
    heads = turns.filter(F.col("p") < kinds).groupBy(F.col("conv").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("p", "d1", "d2", "bytes"))).alias("head"))
    convs = turns.filter("p = 1").select("conv", "n_own", (F.crc32(F.col("conv").cast("string")) % kinds).cast("int").alias("h"))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % every).join(heads, "base", "left")
    convs = convs.withColumn("head", F.when(F.col("head").isNull(), F.array()).otherwise(F.slice("head", 1, F.col("h"))))
    convs = stored(convs.select("conv", "h", "head", (F.size("head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n")), "conversations")
    first = convs.select("conv", F.lit(-1).cast("bigint").alias("part"), F.posexplode("head").alias("i", "t"))
    first = first.select("conv", (F.col("i") + 1).cast("bigint").alias("depth"), "part", "t.d1", "t.d2", "t.bytes")
    own = spread_join(turns, convs.select("conv", "h", F.size("head").alias("k")), ["conv"], "inner").filter("p > h")
    own = own.select("conv", (F.col("k") + F.col("p") - F.col("h")).alias("depth"), "part", "d1", "d2", "bytes")
    return first.unionByName(own), convs.select("conv", "n")


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Key (``depth``, ``x1``, ``x2``), key of the parent, bytes and ``ends`` for each turn of each
    conversation, and the root for each conversation."""
    marks = {f"g{s}": F.xxhash64(F.lit(s), "depth", "d1", "d2") for s in (1, 2)}
    marked = stored(turns.withColumns(marks).select("conv", "depth", "part", "bytes", "g1", "g2"), "marked")
    # Ranges of a conversation follow the order of its turns, that of the borrowed ones comes first.
    pieces = marked.groupBy("conv", "part").agg(*[F.bit_xor(f"g{s}").alias(f"b{s}") for s in (1, 2)])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumns({f"b{s}": F.coalesce(F.bit_xor(f"b{s}").over(before), F.lit(0)) for s in (1, 2)})
    inside = Window.partitionBy("conv", "part").orderBy("depth")
    run = marked.join(pieces, ["conv", "part"]).withColumns({f"x{s}": F.bit_xor(f"g{s}").over(inside).bitwiseXOR(F.col(f"b{s}")) for s in (1, 2)})
    run = spread_join(run, convs, ["conv"], "inner")
    rows = run.select("conv", "depth", "x1", "x2", *[F.col(f"x{s}").bitwiseXOR(F.col(f"g{s}")).alias(f"p{s}") for s in (1, 2)], "bytes", (F.col("depth") == F.col("n")).alias("ends"))
    zero = F.lit(0).cast("bigint")
    roots = convs.select("conv", *[zero.alias(c) for c in ("depth", "x1", "x2")], *[F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2")], zero.alias("bytes"), (F.col("n") == 0).alias("ends"))
    return rows.unionByName(roots)


def list_digests(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` and ``sha256`` of each key's values as text, ascending, joined by commas.

    Ranges of key and value are put into pieces of text first; then one task for each key reads the
    pieces in order, one at a time, as the digest asks for. No key is NULL.
    """
    keys = list(keys)
    order = [*keys, value]
    dealt = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    names = [*keys, "at", "piece"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, held, size = None, 0, [], 0
        out: list[tuple] = []
        for batch in batches:
            for *own, value_, at in zip(*[c.to_pylist() for c in batch.columns]):
                if own != key or size > CHUNK:
                    if held:
                        out.append((*key, start, ",".join(held)))
                    key, start, held, size = own, at, [], 0
                held.append(str(value_))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*key, start, ",".join(held)))], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        out: list[tuple] = []
        for batch in batches:
            for *own, _, piece in zip(*[c.to_pylist() for c in batch.columns]):
                if own == key:
                    digest.update(b"," + piece.encode())
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(piece.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*keys, "sha256"])
                out = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*key, digest.hexdigest()))], [*keys, "sha256"])

    key_types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    cut = dealt.mapInArrow(pieces, f"{key_types}, at bigint, piece string")
    return cut.repartition(*keys).sortWithinPartitions(*keys, "at").mapInArrow(digests, f"{key_types}, sha256 string")


def _next_siblings(kids: DataFrame) -> DataFrame:
    """``node`` and ``sibling``: the next child of the same parent by ``conv_id``, if any.

    Children are dealt by ranges of parent and conversation, so a parent of very many children
    stands in several tasks; the first row of the next range closes the gap at each border.
    """
    order = ["parent", "conv_id"]
    ranged = kids.filter("parent IS NOT NULL").select(*order, "node").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "children").withColumn("range", _place())
    firsts = rows.groupBy("range").agg(F.min_by(F.struct("parent", "node"), "at").alias("row"))
    borders = firsts.select("range", F.lead("row").over(Window.orderBy("range")).alias("border"))
    follow = rows.withColumn("row", F.lead(F.struct("parent", "node")).over(Window.partitionBy("range").orderBy("at"))).join(borders, "range")
    found = F.coalesce("row", "border")
    return follow.select("node", F.when(found["parent"] == F.col("parent"), found["node"]).alias("sibling"))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of sequences: ``conv_id`` (least member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and ``rank``, the
    place of the node's enter arc in the Euler tour.

    ``turns`` has ``conv``, ``depth`` (1, 2, ... without gaps), ``part`` (pieces in order of depth),
    ``d1``, ``d2``, ``bytes``; ``convs`` has every ``conv`` with its number of turns ``n``. Children
    are visited by ``conv_id``. Without conversations there are no nodes.
    """
    rows = stored(_prefixes(turns, convs), "prefixes")
    key = ["depth", "x1", "x2"]
    nodes = rows.groupBy(*key).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *[F.min(c).alias(c) for c in ("bytes", "p1", "p2")])
    nodes = stored(nodes, "nodes")
    # Numbers follow conversations downwards, so that neighbours in the tour mostly are in one range.
    ranges = max(1, -(-nodes.count() // RANGE))
    order = ["conv_id", "depth"]
    nodes = stored(nodes.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id()), "numbered-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    kids = stored(nodes.join(above, ["depth", "p1", "p2"], "left"), "kids")
    first = kids.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"), F.min(F.struct("conv_id", "node"))["node"].alias("child"))
    linked = kids.join(first, "node", "left").join(_next_siblings(kids), "node", "left").fillna(0, ["n_children"])
    linked = stored(linked, "linked")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    enter = F.struct(
        (2 * F.col("node")).alias("element"),
        F.coalesce(2 * F.col("child"), 2 * F.col("node") + 1).alias("next"),
        one.alias("rank"),
        F.col("child").isNull().cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    leave = F.struct(
        (2 * F.col("node") + 1).alias("element"),
        F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1).alias("next"),
        one.alias("rank"),
        zero.alias("leaves"),
        zero.alias("saved"),
    )
    ranks = list_ranks(linked.select(F.inline(F.array(enter, leave))), ["rank", "leaves", "saved"])
    # Sums grow along the tour: what lies between both arcs is the difference.
    below = ranks.groupBy(F.shiftright("element", 1).alias("node")).agg(
        F.min("rank").alias("rank"), *[(F.max(c) - F.min(c)).alias(n) for c, n in (("leaves", "n_leaves"), ("saved", "saved_tokens"))]
    )
    ends = list_digests(rows.filter("ends"), key, "conv").withColumnRenamed("sha256", "ends_sha256")
    whole = linked.join(below, "node").join(ends, key, "left")
    empty = hashlib.sha256().hexdigest()
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "rank")


def rebuilt_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: int = 5, kinds: int = 9) -> DataFrame:
    """The trie of the conversations as ``rebuilt`` makes them.

    NULL roles and texts are empty, NULL turns come first, rows without a conversation are left
    out, repeated rows are repeated turns. An empty table has no nodes. Other columns are ignored.
    """
    return trie(*rebuilt(numbered(conversations, conv, turn, role, text), every, kinds))


ORACLE = """
WITH own AS (
    SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l,
           list_transform(range(1, len(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT)) AS digits
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), counted AS (
    SELECT c, l, xor(list_reduce(list_prepend(4294967295, digits), lambda x, b:
        list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 9 AS h
    FROM own
), rebuilt AS (
    SELECT a.c, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS l FROM counted a LEFT JOIN own b ON b.c = a.c - a.c % 5
), prefixes AS (
    SELECT c, d, l[1:d] AS p, len(l) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE strlen(l[d].t) END AS bytes
    FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY d, p
), children AS (
    SELECT n.d - 1 AS d, m.conv_id, count(*) AS n_children
    FROM nodes n JOIN nodes m ON m.d = n.d - 1 AND m.p = n.p[1:n.d - 1] WHERE n.d > 0 GROUP BY ALL
), above AS (
    SELECT f.c, f.d, n.conv_id FROM prefixes f JOIN nodes n ON n.d = f.d AND n.p = f.p
), below AS (
    SELECT a.conv_id, a.d, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
    FROM nodes n JOIN above a ON a.c = n.conv_id AND a.d <= n.d LEFT JOIN children k ON k.conv_id = n.conv_id AND k.d = n.d GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.conv_id = n.conv_id AND b.d = n.d LEFT JOIN children k ON k.conv_id = n.conv_id AND k.d = n.d
LEFT JOIN above a ON a.c = n.conv_id AND a.d = n.d - 1
"""
