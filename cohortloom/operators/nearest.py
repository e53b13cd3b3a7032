"""Nearest-in-time and interval matching.

Times are timestamps, dates or text; ``functions.dates.time_span`` says what counts as one and what
it covers. A time of day without its day is no time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.dates import time_span
from cohortloom.operators.skew import spread_join

DAY_MICROS = 86_400_000_000


def _spanned(df: DataFrame, name: str) -> Column:
    return time_span(name, df.schema[name].dataType.typeName())


def nearest_per_key(
    base: DataFrame,
    events: DataFrame,
    key: str,
    base_time: str,
    event_time: str,
    tie: str,
    *,
    how: str = "left",
    by: str = "start",
    suffix: str = "_first",
) -> DataFrame:
    """For every key the event closest in time to its base row, before or after.

    For bases with one row per key (of several, the one closest to an event stays). The sides are
    joined by key and each key keeps its least row by ``min_by``, in one pass over the joined rows
    without sorting them by time; a key with very many events is split by the join.

    ``by="start"`` measures between the starts of both times, so a month counts from its first day;
    ``by="gap"`` measures what lies between the spans they cover, 0 where they overlap, then between
    their starts. Equal distances resolve to the earlier start, equal starts to the smaller ``tie``.
    Events without a readable time never match; a base row without such a time or a key has no
    match. ``how="left"`` keeps keys without a match (and base rows without a key), ``"inner"`` drops
    them. ``event_time`` comes out with ``suffix``.
    """
    if by not in ("start", "gap"):
        raise ValueError(f"by must be 'start' or 'gap', not {by!r}")
    taken = [c for c in events.columns if c != key]
    left = base.select(F.col(key).alias("_k"), _spanned(base, base_time).alias("_at"), F.struct("*").alias("_b"))
    right = events.select(
        F.col(key).alias("_k"), _spanned(events, event_time).alias("_seen"), F.struct(*taken).alias("_e"), F.col(tie).alias("_tie")
    ).where(F.col("_k").isNotNull() & F.col("_seen").isNotNull())
    apart = F.abs(F.col("_at.start") - F.col("_seen.start"))
    gap = F.greatest(F.lit(0), F.col("_at.start") - F.col("_seen.end"), F.col("_seen.start") - F.col("_at.end"))
    distance = apart if by == "start" else F.when(apart.isNotNull(), gap)
    matched = apart.isNotNull()
    rank = F.struct(~matched, distance, apart, F.col("_seen.start"), F.col("_tie"), F.col("_at.start"))
    row = F.struct(F.col("_b"), F.when(matched, F.col("_e")).alias("_e"))
    joined = left.where(F.col("_k").isNotNull()).join(right, "_k", how)
    best = joined.groupBy("_k").agg(F.min_by(row, rank).alias("_r")).select("_r.*")
    if how == "left":
        keyless = left.where(F.col("_k").isNull())
        best = best.unionByName(keyless.select("_b", F.lit(None).cast(best.schema["_e"].dataType).alias("_e")))
    else:
        best = best.where(F.col("_e").isNotNull())
    return _flat(best, base.columns, taken, event_time, suffix)


def _flat(matched: DataFrame, base: list[str], taken: list[str], event_time: str, suffix: str) -> DataFrame:
    return matched.select(
        *[F.col(f"_b.{c}").alias(c) for c in base],
        *[F.col(f"_e.{c}").alias(c + suffix if c == event_time else c) for c in taken],
    )


def nearest_event(
    base: DataFrame,
    events: DataFrame,
    key: str,
    base_time: str,
    event_time: str,
    tie: str,
    *,
    how: str = "left",
    slice_days: int = 1,
    suffix: str = "_first",
    each: str | None = None,
    values: Sequence = (),
) -> DataFrame:
    """For every base row the event of the same key closest in time, before or after.

    For several base rows per key; with one row per key ``nearest_per_key`` needs no sorting. Partial
    dates count from their start. Both sides are stacked and sorted once by key and time; a running "last event seen" in each
    direction finds the two neighbours, so no base-event pairs are built. The stack is cut into
    time slices of ``slice_days``: a key with very many events is shared by many tasks, and the
    nearest event outside the slice comes from a summary with one row per key and slice.

    Equal distances resolve to the earlier event, equal times to the smaller ``tie``. Events
    without a readable time never match; a base row without such a time or a key has no match. ``how="left"``
    keeps unmatched base rows, ``"inner"`` drops them. ``event_time`` comes out with ``suffix``.

    ``each`` names an event column: every base row then meets, for each of ``values``, the closest
    event with that value there, without a row of its own for each value on the way. Only for
    ``how="inner"``; other events never match.
    """
    if each is not None and how != "inner":
        raise ValueError(f"each goes with how='inner', not {how!r}")
    if each is not None:
        events = events.where(F.col(each).isin(*values))
    width = slice_days * DAY_MICROS
    taken = [c for c in events.columns if c != key]
    event_type = events.select(F.struct(*taken).alias("e")).schema["e"].dataType
    base_type = base.select(F.struct("*").alias("b")).schema["b"].dataType

    left = base.select(
        F.col(key).alias("_k"),
        _spanned(base, base_time)["start"].alias("_t"),
        F.lit(None).cast(event_type).alias("_e"),
        F.struct("*").alias("_b"),
        F.lit(None).cast(events.schema[tie].dataType).alias("_tie"),
    )
    right = events.select(
        F.col(key).alias("_k"),
        _spanned(events, event_time)["start"].alias("_t"),
        F.struct(*taken).alias("_e"),
        F.lit(None).cast(base_type).alias("_b"),
        F.col(tie).alias("_tie"),
    ).where(F.col("_k").isNotNull() & F.col("_t").isNotNull())
    placed = left.where(F.col("_k").isNotNull() & F.col("_t").isNotNull()).unionByName(right)
    # Dealt once, for the summary and for the windows.
    placed = placed.withColumn("_slice", F.floor(F.col("_t") / F.lit(width))).repartition("_k", "_slice")

    # One row per key and slice with its earliest and latest event (smallest tie at equal times), all
    # of it once for every wanted value.
    seen = F.struct("_t", "_e")
    is_event = F.col("_e").isNotNull()
    wanted = [is_event] if each is None else [is_event & (F.col(f"_e.{each}") == F.lit(v)) for v in values]
    numbers = range(len(wanted))
    earliest, latest = F.struct(F.col("_t"), F.col("_tie")), F.struct(-F.col("_t"), F.col("_tie"))
    summary = placed.groupBy("_k", "_slice").agg(
        *[F.min_by(seen, F.when(test, earliest)).alias(f"_lo{i}") for i, test in enumerate(wanted)],
        *[F.min_by(seen, F.when(test, latest)).alias(f"_hi{i}") for i, test in enumerate(wanted)],
        F.bool_or(F.col("_b").isNotNull()).alias("_asked"),
    )
    before = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy("_k").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = summary.select(
        "_k",
        "_slice",
        "_asked",
        *[F.last(f"_hi{i}", ignorenulls=True).over(before).alias(f"_carry_prev{i}") for i in numbers],
        *[F.last(f"_lo{i}", ignorenulls=True).over(after).alias(f"_carry_next{i}") for i in numbers],
    )
    carried = carried.where("_asked").drop("_asked")

    up = (
        Window.partitionBy("_k", "_slice")
        .orderBy("_t", F.col("_b").isNotNull(), F.desc("_tie"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    down = (
        Window.partitionBy("_k", "_slice")
        .orderBy(F.desc("_t"), F.col("_b").isNotNull(), F.desc("_tie"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = {f"_prev{i}": F.last(F.when(test, seen), ignorenulls=True).over(up) for i, test in enumerate(wanted)}
    inside |= {f"_next{i}": F.last(F.when(test, seen), ignorenulls=True).over(down) for i, test in enumerate(wanted)}
    outside = {f"{side}{i}": F.coalesce(f"{side}{i}", f"_carry{side}{i}") for side in ("_prev", "_next") for i in numbers}
    neighbours = (
        placed.withColumns(inside)
        .where(F.col("_b").isNotNull())
        .join(carried, ["_k", "_slice"], "left")
        .withColumns(outside)
    )

    def nearer(i: int) -> Column:
        prev, following = F.col(f"_prev{i}"), F.col(f"_next{i}")
        use_prev = prev.isNotNull() & (
            following.isNull() | (F.col("_t") - prev["_t"] <= following["_t"] - F.col("_t"))
        )
        return F.when(use_prev, prev["_e"]).otherwise(following["_e"])

    if each is not None:
        found = F.explode(F.array_compact(F.array(*[nearer(i) for i in numbers])))
        return _flat(neighbours.select("_b", found.alias("_e")), base.columns, taken, event_time, suffix)
    matched = neighbours.select("_b", nearer(0).alias("_e"))
    if how == "left":
        unplaced = left.where(F.col("_k").isNull() | F.col("_t").isNull()).select("_b", "_e")
        matched = matched.unionByName(unplaced)
    else:
        matched = matched.where(F.col("_e").isNotNull())
    return _flat(matched, base.columns, taken, event_time, suffix)


def in_treatment_window(
    labs: DataFrame,
    doses: DataFrame,
    key: str,
    lab_time: str,
    dose_time: str,
    days: int = 60,
) -> DataFrame:
    """Lab rows between ``days`` before the first and ``days`` after the last dose of the key."""
    bounds = (
        doses.where(F.col(key).isNotNull() & F.col(dose_time).isNotNull())
        .groupBy(key)
        .agg(
            (F.min(dose_time) - F.make_dt_interval(F.lit(days))).alias("_from"),
            (F.max(dose_time) + F.make_dt_interval(F.lit(days))).alias("_to"),
        )
    )
    joined = spread_join(labs, bounds, [key], "inner")
    return joined.where(F.col(lab_time).between(F.col("_from"), F.col("_to"))).drop("_from", "_to")
