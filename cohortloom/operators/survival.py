"""Survival curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.skew import spread_join


def kaplan_meier(
    df: DataFrame, time: str, strata: Sequence[str], event: str | None = None
) -> DataFrame:
    """Survival probability per stratum and time; without ``event`` every row is an event.

    Rows are first counted per stratum and time, so the windows run over distinct days only. The
    number at risk is the sum of everyone leaving now or later; survival is the running product of
    the share that stays, computed in logarithms, and 0 from the time nobody stays.
    """
    happened = F.lit(1) if event is None else F.col(event).cast("int")
    per_time = (
        df.where(F.col(time).isNotNull())
        .groupBy(*strata, F.col(time).alias("time"))
        .agg(F.count(F.lit(1)).alias("n_leaving"), F.sum(happened).alias("n_event"))
    )
    part = Window.partitionBy(*(strata or [F.lit(0)]))
    at_risk = F.sum("n_leaving").over(
        part.orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    risked = per_time.withColumn("n_risk", at_risk)
    so_far = part.orderBy("time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stays = 1 - F.col("n_event") / F.col("n_risk")
    emptied = F.max(F.when(F.col("n_event") == F.col("n_risk"), 1).otherwise(0)).over(so_far)
    log_sum = F.sum(F.when(stays > 0, F.ln(stays)).otherwise(F.lit(0.0))).over(so_far)
    return risked.select(
        *strata,
        "time",
        "n_risk",
        "n_event",
        F.when(emptied == 1, F.lit(0.0)).otherwise(F.exp(log_sum)).alias("survival"),
    )


def kaplan_meier_per_group(
    df: DataFrame, time: str, group: str, stratum: str, min_n: int = 50, event: str | None = None
) -> DataFrame:
    """Curves inside every group with more than ``min_n`` rows and at least two strata."""
    usable = (
        df.where(F.col(time).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"), F.count_distinct(stratum).alias("_strata"))
        .where((F.col("_n") > min_n) & (F.col("_strata") >= 2))
        .select(group)
    )
    return kaplan_meier(spread_join(df, usable, [group], "left_semi"), time, [group, stratum], event)
