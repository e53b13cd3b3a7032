"""Merging aggregate tables of several sites into one."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.delimited import csv_files_by_header


def read_site_tables(spark: SparkSession, paths: Iterable[str], keys: Sequence[str], sep: str = ";") -> DataFrame:
    """All sites' tables under one header: trimmed names, index column gone, by name.

    Sites with the same header are read in one scan. A site whose table lacks a key column is an
    error that names it.
    """
    frames = []
    for names, df in csv_files_by_header(spark, paths, sep, trim=True).items():
        if missing := sorted(set(keys) - set(names)):
            raise ValueError(f"{df.select('_path').first()[0]} has no column {', '.join(missing)}")
        frames.append(df.drop("_path", *[c for c in names if c.startswith("_c")]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_sites(
    df: DataFrame,
    keys: Sequence[str],
    counts: Sequence[str] | None = None,
    *,
    normalise_keys: bool = False,
) -> DataFrame:
    """Sum the counts of all sites by key; ``normalise_keys`` lower-cases and trims the keys."""
    wanted = list(counts or [c for c in df.columns if c == "count" or c.endswith("_count")])
    ready = df.withColumns({c: F.lower(F.trim(c)) for c in keys}) if normalise_keys else df
    return (
        ready.groupBy(*keys)
        .agg(*[F.sum(F.col(c).try_cast("double")).alias(c) for c in wanted])
        .orderBy(*keys)
    )


def split_metastatic_pivot(df: DataFrame, label: str = "combo_label", count: str = "count") -> DataFrame:
    """Counts per label beside each other for both metastatic states, with their total."""
    wide = (
        df.groupBy(label)
        .pivot("metastatic_flag", ["metastatic", "non_metastatic"])
        .agg(F.sum(count))
        .fillna(0, subset=["metastatic", "non_metastatic"])
    )
    return wide.withColumn("total", F.col("metastatic") + F.col("non_metastatic"))


AGE_COUNTS = [
    "count",
    "cohort_count",
    "gleason_6_count",
    "gleason_7_count",
    "gleason_8_count",
    "gleason_9_count",
    "gleason_10_count",
]


def with_no_gleason(df: DataFrame) -> DataFrame:
    """Rows of a bucket without any score."""
    scored = reduce(lambda a, b: a + b, [F.col(c) for c in AGE_COUNTS if c.startswith("gleason")])
    return df.withColumn("no_gleason_count", F.col("count") - scored)


def collapse_tail_classes(df: DataFrame, lo: int = 45, hi: int = 80, width: int = 5) -> DataFrame:
    """Age classes below ``lo`` and above ``hi`` become one bucket each, with labels."""
    numbers = with_no_gleason(
        df.withColumns(
            {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in [*AGE_COUNTS, "age_class"]}
        )
    )
    a = F.col("age_class").cast("int")
    label = (
        F.when(a < lo, F.lit(f"<{lo}"))
        .when(a > hi, F.lit(f">={hi + width}"))
        .otherwise(F.concat(a.cast("string"), F.lit(" - "), (a + width - 1).cast("string")))
    )
    rank = F.when(a < lo, F.lit(lo - width)).when(a > hi, F.lit(hi + width)).otherwise(a)
    return (
        numbers.groupBy(rank.alias("age_class"), label.alias("age_class_label"))
        .agg(*[F.sum(c).alias(c) for c in [*AGE_COUNTS, "no_gleason_count"]])
        .orderBy("age_class")
    )


def min_cell_filter(
    df: DataFrame,
    n: int = 3,
    overall: str = "overall_count",
    cohort: str = "cohort_count",
    kind: str = "metastasis_kind",
) -> DataFrame:
    """Cells large enough to publish, without the bucket of no metastasis."""
    return df.where(((F.col(overall) > n) | (F.col(cohort) > n)) & (F.col(kind) != "NON"))


def recent_years(df: DataFrame, year: str = "diagnosis_year", since: int = 1990) -> DataFrame:
    return df.where(F.col(year).try_cast("double") >= since)
