"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import materialise

_RANGE = ["_measure", "_part"]


def join_null_safe(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys are equal; the keys of ``a`` stay."""
    renamed = b.withColumnsRenamed({c: f"_other_{c}" for c in on})
    test = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in on], F.lit(True))
    return a.join(renamed, test, how).drop(*[f"_other_{c}" for c in on])


def _ranks(total: Column, p: float, interpolated: bool) -> tuple[Column, Column, Column]:
    """Ranks (from 1) of the values on both sides of a quantile, and the share of the upper one."""
    if not interpolated:
        rank = F.greatest(F.lit(1), F.ceil(total * F.lit(p))).cast("bigint")
        return rank, rank, F.lit(0.0)
    at = (total - 1) * F.lit(float(p))
    return (F.floor(at) + 1).cast("bigint"), (F.ceil(at) + 1).cast("bigint"), at - F.floor(at)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], cols: Sequence[str], probs: Sequence[float], *, interpolated: bool = True
) -> DataFrame:
    """``by`` and, for each of ``cols``, an array ``<col>_quantiles`` with a double for each of ``probs``.

    Quantiles lie between the two nearest values (linear interpolation), or are the least value
    with at least that share of the values up to it. NULL values do not count; a group without
    values has no row, one without values in a column has NULL there. NULL keys are a group.

    Values are counted first, so a repeated one is one row. Counted values are dealt by ranges of
    group and value and stored once; the sums of the ranges, one small row each, say which range
    holds a wanted rank, and running sums are formed inside those ranges only. No group is held in
    one task or one buffer.
    """
    by, cols = list(by), list(cols)
    keys = [f"_k{i}" for i in range(len(by))]
    cells = F.array(*[F.struct(F.lit(c).alias("_measure"), F.col(c).cast("double").alias("_value")) for c in cols])
    long = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.inline(cells)).where(F.col("_value").isNotNull())
    counted = long.groupBy(*keys, "_measure", "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranged = counted.repartitionByRange(*keys, "_measure", "_value").withColumn("_part", F.spark_partition_id())
    counted = materialise(ranged, "quantiles")

    group = Window.partitionBy(*keys, "_measure")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy(*keys, *_RANGE).agg(F.sum("_n").alias("_sum"))
    sums = sums.select(*keys, *_RANGE, "_sum", F.sum("_sum").over(group).alias("_total"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    wanted = F.array_distinct(F.array(*[r for p in probs for r in _ranks(F.col("_total"), p, interpolated)[:2]]))
    here = F.filter(wanted, lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_sum")))
    hit = sums.select(*keys, *_RANGE, "_total", "_before", here.alias("_wanted")).where(F.size("_wanted") > 0)

    inside = Window.partitionBy(*keys, *_RANGE).orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = join_null_safe(counted, hit, [*keys, *_RANGE], "inner").withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    own = F.filter("_wanted", lambda r: (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_n")))
    found = placed.select(*keys, "_measure", "_total", F.explode(own).alias("_rank"), "_value")
    picked = found.groupBy(*keys, "_measure", "_total").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def between(p: float) -> Column:
        low, high, share = _ranks(F.col("_total"), p, interpolated)
        a, b = (F.try_element_at("_at", r) for r in (low, high))
        return F.when(a == b, a).otherwise(a + (b - a) * share)

    quantiles = picked.select(*keys, "_measure", F.array(*[between(p) for p in probs]).alias("_q"))
    out = quantiles.groupBy(*keys).agg(*[F.first(F.when(F.col("_measure") == c, F.col("_q")), ignorenulls=True).alias(f"{c}_quantiles") for c in cols])
    return out.withColumnsRenamed(dict(zip(keys, by, strict=True)))
