"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import WORD, prefix_sums, stored

WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source; no document is taken more often.
REPEATS = 3
#: Bits of the hash that each histogram looks at, and how many are nested.
BITS, LEVELS = 12, 5


def words_in(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_of(key: Column, text: Column) -> Column:
    """60 bits of the MD5 of a row's key and text, so that rows of one key, or of none, differ."""
    named = F.when(key.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), key.cast("string")))
    digest = F.md5(F.concat(named, F.lit("|"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target`` of each source.

    Sources by code point, NULL last, take the weights in turn and share the sum of all sizes.
    Targets stop at ``repeats`` times their source; the excess goes to the others by weight until
    none is above. That is one level for all: a source whose limit for each unit of weight is below
    the level stops, and what the others share gives the level. Numbers and sums in order of the
    sources come from ``prefix_sums``, so there may be any number of sources.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    turn = F.col("before_one") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    numbered = prefix_sums(per_source, [F.col("source").asc_nulls_last()], ["one"])
    limited = stored(numbered.withColumn("weight", weight).withColumn("ratio", repeats * F.col("source_size") / F.col("weight")), "limits")
    total, total_weight = limited.agg(F.sum("source_size"), F.sum("weight")).first()
    by_ratio = limited.groupBy("ratio").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    cuts = prefix_sums(by_ratio, [F.col("ratio").asc()], ["size", "weight"])
    # The level if all sources with a lower limit than this one have stopped.
    level = (F.lit(total) - repeats * F.col("before_size")).cast("double") / (F.lit(total_weight) - F.col("before_weight"))
    found = cuts.withColumn("level", level).filter("ratio >= level").agg(F.min_by("level", "ratio")).first()[0]
    target = F.least(F.lit(found).cast("double") * F.col("weight"), F.lit(float(repeats)) * F.col("source_size"))
    return limited.select("source", "source_size", target.alias("target"))


def _name(source: str) -> Column:
    """A name of each source that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on ``source``, where NULL is a source as well."""
    name = _name("source")
    return left.withColumn("_of", name).join(right.withColumn("_of", name).drop("source"), "_of").drop("_of")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = REPEATS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``key``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` of every row.

    A source whose target is q times its size and a rest has every document q times, and once more
    those with the least hashes of key and text whose sizes fill the rest; the document on the edge
    is added if that comes nearer to the target. Hashes are compared with a threshold, never sorted:
    a histogram of sizes by source and hash bucket finds the bucket where the budget ends, and only
    that bucket is counted anew with finer buckets, nested until it holds one hash. Rows of one hash
    are equal rows; of those on the edge as many are taken as fit. A NULL source is a source, NULL
    and empty texts have size 0. Reruns agree, since nothing but keys, sources and texts decides;
    which of equal rows are taken shows in no value. Other columns are ignored.
    """
    own = F.col(text).cast("string")
    sizes = stored(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            words_in(own).alias("size"),
            hash_of(F.col(key), own).alias("hash"),
        ),
        "sizes",
    )
    return _taken(_join(sizes, _rules(sizes, weights, repeats)), repeats).select(
        F.col("key").alias(key), "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _rules(sizes: DataFrame, weights: Sequence[float], repeats: int) -> DataFrame:
    """``base``, ``left``, ``threshold`` and ``quota`` of each source, with its size and target.

    Rows with a hash below the threshold are taken once more than ``base`` times, and ``quota`` of
    those on it; without a threshold all are, if anything is left. ``sizes`` has ``source``, ``size`` and ``hash`` of every row.
    """
    planned = targets(sizes, weights, repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = planned.withColumn("base", whole.cast("bigint")).withColumn(
        "left", F.col("target") - F.col("base") * F.col("source_size")
    )
    edge = stored(budget, "targets")
    state = edge.select("source", "left", F.lit(0).cast("bigint").alias("prefix"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = _join(sizes.select("source", "size", "hash"), state.withColumnRenamed("prefix", "upper"))
        inside = inside.filter(F.shiftright("hash", shift + BITS) == F.col("upper"))
        bucket = F.shiftright("hash", shift)
        histogram = inside.groupBy("source", "left", bucket.alias("prefix")).agg(F.sum("size").alias("here"), F.max("size").alias("one"))
        up_to = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = histogram.withColumn("up_to", F.sum("here").over(up_to)).filter("up_to > left")
        last = summed.groupBy("source").agg(F.min(F.struct("prefix", "up_to", "here", "left", "one")).alias("b"))
        state = last.select(
            "source", (F.col("b.left") - F.col("b.up_to") + F.col("b.here")).alias("left"), F.col("b.prefix").alias("prefix"), F.col("b.one").alias("one")
        )
    # Budgets that end nowhere take all.
    whole = F.floor(F.col("left") / F.col("one"))
    rest = F.col("left") - whole * F.col("one")
    quota = whole + (F.col("one") - rest < rest).cast("bigint")
    threshold = state.select(_name("source").alias("_of"), F.col("prefix").alias("threshold"), quota.alias("quota"))
    return edge.withColumn("_of", _name("source")).join(threshold, "_of", "left").drop("_of")


def _taken(ruled: DataFrame, repeats: int) -> DataFrame:
    """``ruled`` with ``copies``, how often each row is taken.

    ``ruled`` has ``hash``, ``source`` and the rule of its source. The rows on an edge, equal ones, are
    stored and numbered: by the ranges they were stored in, so that there may be many.
    """
    on_edge = F.coalesce((F.col("hash") == F.col("threshold")) & (F.col("left") > 0), F.lit(False))

    def copies(more: Column) -> Column:
        return F.least(F.col("base") + more.cast("bigint"), F.lit(repeats))

    below = F.coalesce(F.col("hash") < F.col("threshold"), F.lit(True)) & (F.col("left") > 0)
    plain = ruled.filter(~on_edge).withColumn("copies", copies(below))
    edge = stored(ruled.filter(on_edge), "edge").withColumns({"_at": F.monotonically_increasing_id(), "_of": _name("source")})
    edge = edge.withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = edge.groupBy("_of", "_part").count().select("_of", "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_shift"))
    number = F.row_number().over(Window.partitionBy("_of", "_part").orderBy("_at")) + F.col("_shift")
    numbered = edge.join(shifts, ["_of", "_part"]).withColumn("copies", copies(number <= F.col("quota")))
    return plain.unionByName(numbered.select(*plain.columns))


def repeated(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = REPEATS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` as the mix takes them: rows left out, once, or repeated; columns as they are.

    Each row is decided by the rule of its own source and its own key and text, as in ``mix``.
    Columns may have any names.
    """
    own = F.col(text).cast("string")
    marked = docs.select(
        F.struct("*").alias("row"), F.col(source).cast("string").alias("source"), words_in(own).alias("size"), hash_of(F.col(key), own).alias("hash")
    )
    rules = stored(_rules(stored(marked.drop("row"), "sizes"), weights, repeats), "rules")
    taken = _taken(_join(marked.drop("size"), rules), repeats).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


ORACLE = """
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           CAST('0x' || substr(md5(coalesce('=' || CAST(doc_id AS VARCHAR), '-') || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
    FROM documents
), per_source AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
    FROM sized GROUP BY source
), limits AS (
    SELECT *, 3 * source_size / weight AS ratio FROM per_source
), cuts AS (
    SELECT a.ratio,
           (SELECT sum(source_size) FROM limits) - coalesce(3 * (SELECT sum(source_size) FROM limits b WHERE b.ratio < a.ratio), 0) AS open_size,
           (SELECT sum(weight) FROM limits) - coalesce((SELECT sum(weight) FROM limits b WHERE b.ratio < a.ratio), 0) AS open_weight
    FROM (SELECT DISTINCT ratio FROM limits) a
), level AS (
    SELECT max(CAST(open_size AS DOUBLE) / open_weight) AS level FROM cuts WHERE ratio >= CAST(open_size AS DOUBLE) / open_weight AND
        ratio = (SELECT min(ratio) FROM cuts WHERE ratio >= CAST(open_size AS DOUBLE) / open_weight)
), targets AS (
    SELECT source, source_size, least(level * weight, 3.0::DOUBLE * source_size) AS target FROM limits, level
), rules AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM targets
), ordered AS (
    SELECT s.*, r.source_size, r.target, r.base, r.target - r.base * r.source_size AS remaining,
           CAST(sum(size) OVER (PARTITION BY s.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS up_to
    FROM sized s JOIN rules r ON s.source IS NOT DISTINCT FROM r.source
), decided AS (
    SELECT *, least(3, base + CASE WHEN remaining <= 0 THEN 0 WHEN up_to <= remaining THEN 1
                            WHEN up_to - size <= remaining AND up_to - remaining < remaining - (up_to - size) THEN 1 ELSE 0 END) AS copies
    FROM ordered
)
SELECT doc_id, source, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken FROM decided
"""
