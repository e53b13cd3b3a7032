"""Document fingerprints from closed syncmers, matched by place, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored

#: A k-mer is so many units, its inner substrings so many.
K, S = 4, 2
#: A word of more characters than ``LONG`` is not one unit: each ``GRAM`` of its characters is one.
LONG, GRAM = 24, 8
#: Places of a matched anchor in two texts may drift by a ``BAND``-th of the longer text, or by so many.
BAND, DRIFT = 16, 8


def units(text: str) -> Column:
    """Words of a text; those of more than ``LONG`` characters as their overlapping ``GRAM``s."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def grams(chars: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(chars) - (GRAM - 1)), lambda i: F.array_join(F.slice(chars, i, GRAM), ""))

    def cut(w: Column) -> Column:
        # The characters are bound once for each word, so a long one costs in proportion.
        long = F.flatten(F.transform(F.array(F.filter(F.split(w, ""), lambda c: c != "")), grams))
        return F.when(F.char_length(w) > LONG, long).otherwise(F.array(w))

    def whole(ws: Column) -> Column:
        return F.when(F.exists(ws, lambda w: F.char_length(w) > LONG), F.flatten(F.transform(ws, cut))).otherwise(ws)

    return F.flatten(F.transform(F.array(words), whole))


def anchors(docs: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """``docs`` with column ``name``: the closed syncmers of a text as hashes of 32 bits, by place.

    A k-mer of units is chosen if the least hash of its inner s-unit strings is that of the first or
    the last of them; nothing outside the k-mer matters, so an edit moves no anchors but its own.
    Every k-mer has an entry in order of place, NULL if it is not chosen. A text of fewer than k
    units is one anchor, an empty one has none.
    """
    inner = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_units") - s, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("_units", i + j) for j in range(s)]),
    )

    def closed(i: Column) -> Column:
        ends = F.least(F.get("_inner", i), F.get("_inner", i + (k - s)))
        between = [F.get("_inner", i + j) for j in range(1, k - s)]
        return ends <= (F.least(*between) if len(between) > 1 else between[0])

    held = [j * s for j in range(k // s)] + ([k - s] if k % s else [])  # inner strings that make up a k-mer

    def half(h: Column) -> Column:
        return F.shiftright(h, 32).cast("int")

    def kmer(i: Column) -> Column:
        return half(F.xxhash64(*[F.get("_inner", i + j) for j in held]))

    at = F.sequence(F.lit(0), F.size("_units") - k)
    short = F.array(half(F.xxhash64(F.array_join("_units", " "))))
    found = (
        F.when(F.size("_units") >= k, F.transform(at, lambda i: F.when(closed(i), kmer(i))))
        .when(F.size("_units") > 0, short)
        .otherwise(F.array().cast("array<int>"))
    )
    # Step by step, so that units and inner hashes are made once for each text.
    return (
        docs.withColumn("_units", units(text))
        .withColumn("_inner", inner)
        .withColumn(name, found)
        .drop("_units", "_inner")
    )


def _firsts(docs: DataFrame, anchors: str, name: str, side: int) -> DataFrame:
    """``docs`` with ``name``: each different anchor with its first place and ``side`` (0 or 1),
    packed into a number that sorts by anchor."""
    packed = F.transform(anchors, lambda h, i: F.shiftleft(h.cast("bigint"), 32).bitwiseOR((2 * i + side).cast("bigint")))
    first = F.filter(name, lambda x, i: (i == 0) | (F.shiftright(F.get(name, i - 1), 32) != F.shiftright(x, 32)))
    return docs.withColumn(name, F.sort_array(F.array_compact(packed))).withColumn(name, first)


def likeness(docs: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``docs`` with ``name``, how alike two arrays of ``anchors`` are, from 0 to 1.

    Each anchor that both have votes for an offset, the distance of its first places in both.
    Matched are the anchors of the best band of offsets, a ``BAND``-th of the longer text wide, in
    either of two grids half a band apart; ``name`` is their share of all different anchors. Parts
    that stand elsewhere, as swapped halves do, don't match. Two texts without anchors are alike.
    """
    both = _firsts(_firsts(docs, a, "_a", 0), b, "_b", 1)
    both = both.withColumn("_all", F.sort_array(F.concat("_a", "_b")))

    def place(i: Column) -> Column:
        return F.shiftright(F.get("_all", i).bitwiseAND(F.lit(0xFFFFFFFF)), 1)

    def shared(i: Column) -> Column:
        return F.shiftright(F.get("_all", i), 32) == F.shiftright(F.get("_all", i + 1), 32)

    def offset(i: Column) -> Column:
        apart = place(i + 1) - place(i)
        return F.when(F.get("_all", i).bitwiseAND(F.lit(1)) == 0, apart).otherwise(-apart)

    pairs = F.filter(F.sequence(F.lit(0), F.size("_all") - 2), shared)
    both = both.withColumn("_offsets", F.when(F.size("_all") > 1, F.transform(pairs, offset)).otherwise(F.array().cast("array<bigint>")))
    both = both.withColumn("_width", F.greatest(F.lit(DRIFT), F.floor(F.greatest(F.size(a), F.size(b)) / BAND)))
    votes = []
    for grid in (0, 1):
        cell, runs = f"_cell{grid}", f"_runs{grid}"
        shift = F.floor(F.col("_width") / 2) if grid else F.lit(0)
        both = both.withColumn(cell, F.sort_array(_cells(shift)))
        starts = F.filter(F.sequence(F.lit(0), F.size(cell) - 1), _changes(cell))
        both = both.withColumn(runs, F.when(F.size(cell) > 0, starts))
        votes.append(F.coalesce(F.array_max(_lengths(runs, cell)), F.lit(0)))
    matched = F.greatest(*votes)
    every = F.size("_a") + F.size("_b")
    share = F.when(every == 0, F.lit(1.0)).otherwise(F.col("_matched") / (every - F.col("_matched")))
    found = both.withColumn("_matched", matched).withColumn(name, share)
    return found.drop("_a", "_b", "_all", "_offsets", "_width", "_matched", *[f"_{c}{g}" for c in ("cell", "runs") for g in (0, 1)])


def _cells(shift: Column) -> Column:
    return F.transform("_offsets", lambda o: F.floor((o + shift) / F.col("_width")))


def _changes(cell: str):
    return lambda i: (i == 0) | (F.get(cell, i - 1) != F.get(cell, i))


def _lengths(runs: str, cell: str) -> Column:
    """Lengths of the runs of equal numbers that start at ``runs``."""
    return F.transform(runs, lambda s, i: F.coalesce(F.get(runs, i + 1), F.size(cell)) - s)


def written(anchors: str) -> Column:
    """Anchors as text: eight hexadecimal digits for each, ``-`` for NULL."""
    return F.array_join(F.transform(anchors, lambda h: F.lower(F.lpad(F.hex(h.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "", "-")


def followers(keys: DataFrame) -> DataFrame:
    """Each row of ``keys`` with ``next``, the following row in order of the columns, as a struct.

    After the last row comes the first. The rows are cut into ranges; in each a window looks one
    row ahead, and the first rows of the ranges, one for each, close the gaps.
    """
    order = [F.col(c).asc_nulls_first() for c in keys.columns]
    kept = stored(keys.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "order")
    row = F.struct(*[F.col(c) for c in keys.columns])
    firsts = kept.groupBy("_range").agg(F.min(row).alias("_first"))
    by_range = Window.orderBy("_range")
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("_first").over(by_range), F.first("_first").over(whole))
    borders = firsts.select("_range", after.alias("_after"))
    inside = kept.withColumn("_next", F.lead(row).over(Window.partitionBy("_range").orderBy(*order)))
    joined = inside.join(borders, "_range")
    return joined.select(*keys.columns, F.coalesce("_next", "_after").alias("next"))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` of every row.

    Fingerprints are all anchors at their places as text: for each k-mer in order eight hexadecimal
    digits, or ``-`` if it is no anchor. Nearness is the ``likeness`` of two fingerprints.

    The edited text has the last half of the code points replaced by the first ones of the next
    document in order of the key, as many or all; after the last document comes the first. Rows
    of one key follow each other by length and hash of the text; equal ones are one document in
    several rows. NULL keys come first, NULL texts are empty. Equal texts have equal fingerprints.
    Other columns are ignored.

    The texts are shuffled once by document and, as far as they are inserted into others, once more
    to those.
    """
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), own.alias("text"))
    rows = rows.withColumns({"n": F.char_length("text").cast("bigint"), "h": F.xxhash64("text")})
    keys = rows.groupBy("id", "n", "h").agg(F.count("*").alias("times"))

    def tag(at: str = "") -> Column:
        return F.xxhash64(F.lit(7), F.col(f"{at}id"), F.col(f"{at}n"))

    follows = followers(keys).withColumns({"t": tag(), "next_t": tag("next."), "next_h": F.col("next.h"), "next_times": F.col("next.times")})
    follows = stored(follows.select("id", "t", "h", "n", "next_t", "next_h", "next_times"), "next")
    before = follows.select(
        F.col("next_t").alias("t"), F.col("next_h").alias("h"), F.col("t").alias("to_t"), F.col("h").alias("to_h"), F.floor(F.col("n") / 2).cast("int").alias("asked"), "next_times"
    )
    # Both uses of this table read the same columns, so its shuffle is made once.
    placed = rows.withColumn("t", tag()).select("t", "h", "text").repartition("t", "h")
    head = F.substring("text", F.lit(1), F.col("asked")).alias("head")

    def given(part: DataFrame) -> DataFrame:
        joined = anchors(placed.join(part.hint("shuffle_hash"), ["t", "h"]), "text", "_anchors")
        return joined.select(F.col("to_t").alias("t"), F.col("to_h").alias("h"), head, F.col("_anchors").alias("_next"))

    once = given(before.filter("next_times = 1"))
    again = given(before.filter("next_times > 1")).dropDuplicates(["t", "h"])
    known = placed.join(follows.select("t", "h", "id", "n").hint("shuffle_hash"), ["t", "h"])
    both = known.join(once.unionByName(again), ["t", "h"])
    kept = F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 2)).cast("int"))
    edited = both.withColumn("edited", F.concat(kept, "head"))
    done = anchors(anchors(edited, "text", "_own"), "edited", "_edited")
    done = likeness(likeness(done, "_own", "_edited", "near_edited"), "_own", "_next", "near_next")
    return done.select(
        F.col("id").alias(key),
        F.col("n").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written("_own").alias("fingerprint"),
        written("_edited").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
