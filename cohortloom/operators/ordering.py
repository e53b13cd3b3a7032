"""First, latest and repeated rows per key; shares and running counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.skew import number_rows, spread_join


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank_as: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key.

    ``row_number() <= n`` lets Spark cut every group to ``n`` rows before the shuffle
    (window group limit), so a hot key sends at most ``n`` rows per map task.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col("_rn") <= n)
    return kept.withColumnRenamed("_rn", rank_as) if rank_as else kept.drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str]) -> DataFrame:
    """Earliest row per key; NULL dates last, ``tie`` columns decide equal dates."""
    return top_per_key(df, keys, [F.col(by).asc_nulls_last(), *[F.col(t).asc() for t in tie]])


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str]) -> DataFrame:
    """Newest row per key; NULL dates last, smallest ``tie`` wins."""
    return top_per_key(df, keys, [F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in tie]])


def keep_first_sorted(df: DataFrame, cols: Sequence[str], date: str, tie: Sequence[str]) -> DataFrame:
    """One row per column set: the earliest diagnosis."""
    return first_per_key(df, cols, date, tie)


def first_event_with_ties(
    df: DataFrame, key: str, date: str, event_id: str, *, keep_undated: bool = False
) -> DataFrame:
    """First event of each key with all of its rows (one event may carry several causes).

    An event without a date is dropped even if it is the only one, unless ``keep_undated``.
    """
    known = df.where(F.col(key).isNotNull())
    if not keep_undated:
        known = known.where(F.col(date).isNotNull())
    order = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last(), event_id)
    # One scan; ``rank() = 1`` is cut to the leading rows of each key before the shuffle.
    return known.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(key)
    )


def multi_flag(df: DataFrame, key: str, name: str = "double_patid") -> DataFrame:
    """1 when the key occurs more than once, else 0; NULL keys get 0."""
    flagged = repeated_keys(df, key).withColumn("_many", F.lit(1))
    return spread_join(df, flagged, [key], "left").withColumn(
        name, F.coalesce("_many", F.lit(0))
    ).drop("_many")


def dup_members(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once."""
    return spread_join(df, repeated_keys(df, key), [key], "left_semi")


def number_malignancies(df: DataFrame, patient: str, date: str, condition: str) -> DataFrame:
    """Ordinal, previous date and gap in months and years per tumour of a patient.

    Slices are days, then ranges of the condition id: the part behind ``Condition/`` by its first
    three characters, so that a common day of the NULL patient is shared by tasks.
    """
    name = F.col(condition).cast("string")
    start = F.when(F.contains(name, F.lit("/")), F.instr(name, "/") + 3).otherwise(F.lit(3))
    numbered = number_rows(
        df,
        [patient],
        [date, condition],
        {
            "day": F.col(date),
            "id": F.substring(name, F.lit(1), start),
        }
        if dict(df.dtypes)[condition] == "string"
        else {"day": F.col(date), "id": F.floor(F.col(condition) / F.lit(1_000_000))},
        name="malignancy_number",
        previous={date: "date_prev"},
    )
    gap = F.months_between(F.col(date), F.col("date_prev"))
    return numbered.withColumns(
        {"years_between": F.round(gap / 12, 2), "months_between": F.round(gap, 1)}
    )


def share_within_group(
    df: DataFrame, group: Sequence[str], n: str = "n", name: str = "percentage"
) -> DataFrame:
    """Percentage of ``n`` within each group of an already aggregated table."""
    return df.withColumn(
        name, F.col(n) / F.sum(n).over(Window.partitionBy(*group)) * F.lit(100.0)
    )


def share_of_total(df: DataFrame, n: str = "count", name: str = "percentage") -> DataFrame:
    """Percentage of ``n`` over the whole of an already aggregated table."""
    return df.withColumn(name, F.col(n) / df.agg(F.sum(n)).scalar() * F.lit(100.0))


def running_count(
    df: DataFrame, value: str, group: Sequence[str] = (), name: str = "cumulative"
) -> DataFrame:
    """Cumulative number of cases up to each distinct value.

    Rows are counted per value first. The running sum then covers one row per distinct value: day
    differences, so never more than the days of a study, however many cases there are.
    """
    per_value = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_value.withColumn(name, F.sum("n").over(frame))
