"""Joins and numberings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def spread_join(
    many: DataFrame, one: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join of a large side with a side that was aggregated by the same keys.

    Joined directly, the aggregate's own shuffle would serve the join as well, and the adaptive
    skew rule, which only looks at shuffles right below a join, could not act: a key with a third
    of the rows would go to one task. Joining on the keys plus a value computed from them forces a
    fresh shuffle of the (small) aggregate. Then every partition that turns out too large, that of
    the NULL keys included, is split over several tasks at run time, and a small aggregate is
    broadcast once its size is known. Supports inner, left, left_semi and left_anti.
    """
    on = list(on)
    digest = F.pmod(F.xxhash64(*on), F.lit(64))
    return (
        many.withColumn("_digest", digest)
        .join(one.withColumn("_digest", digest), [*on, "_digest"], how)
        .drop("_digest")
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: dict[str, Column],
    *,
    name: str = "ordinal",
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """``row_number`` (and ``lag``) within ``keys`` without putting a whole key into one task.

    ``slices`` cuts each key into ranges that follow ``order`` (for example the month of the first
    order column, then a prefix of the tie-break column). Rows are numbered inside a slice; the
    row counts and last rows of the earlier slices, one small row per slice, supply the offset.
    ``previous`` maps a source column to the name that receives its value in the preceding row.
    """
    keys, order, previous = list(keys), list(order), dict(previous or {})
    cuts = [f"_slice_{s}" for s in slices]
    sliced = df.withColumns({f"_slice_{s}": c for s, c in slices.items()})

    # Text stand-ins without NULLs let the join and the window share one shuffle of the rows.
    stand_in = {
        c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
        for c in [*keys, *cuts]
    }
    places = [f"_at_{c}" for c in stand_in]
    key_places = places[: len(keys)]
    sliced = sliced.withColumns({f"_at_{c}": e for c, e in stand_in.items()})

    order_key = F.struct(*[F.col(c) for c in order])
    last = F.struct(*[F.col(c) for c in previous]) if previous else F.lit(None)
    per_slice = sliced.groupBy(*places).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max_by(last, order_key).alias("_last"),
        *[F.first(c).alias(c) for c in cuts],
    )
    across = Window.partitionBy(*key_places).orderBy(*cuts)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *places,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.lag("_last").over(across).alias("_carried"),
    )
    inside = Window.partitionBy(*places).orderBy(*order)
    numbered = sliced.join(offsets, places, "inner").withColumn("_rn", F.row_number().over(inside))
    added = {name: (F.col("_rn") + F.col("_offset")).cast("bigint")}
    for source, target in previous.items():
        added[target] = F.when(F.col("_rn") == 1, F.col(f"_carried.{source}")).otherwise(
            F.lag(source).over(inside)
        )
    return numbered.withColumns(added).select(*df.columns, *added)
