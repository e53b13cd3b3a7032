"""Data-quality reports: uncoded texts, duplicate keys, counters beside the data path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortloom.operators.ordering import dup_members


def mapping_template(
    df: DataFrame, by: Sequence[str], blanks: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Uncoded texts with their frequency and empty columns to be filled in by hand.

    Most frequent first; ``order`` sorts by those columns, descending, instead.
    """
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))
    keys = [F.desc(c) for c in order] if order else [F.desc("count"), *[F.asc(c) for c in by]]
    return counted.orderBy(*keys).select(*by, *[F.lit("").alias(b) for b in blanks], "count")


def uncoded_medications(statements: DataFrame) -> DataFrame:
    return mapping_template(statements, ["Substanzbezeichnung"], ["ATC-Code"])


def uncoded_classifications(observations: DataFrame) -> DataFrame:
    return mapping_template(
        observations,
        ["name", "stadium"],
        ["snomed_code", "snomed_display", "value_snomed_code", "value_snomed_display"],
        ["name", "stadium"],
    )


def uncoded_side_effects(events: DataFrame) -> DataFrame:
    return mapping_template(
        events,
        ["nebenwirkung_bezeichnung"],
        ["snomed_code", "snomed_display"],
        ["nebenwirkung_bezeichnung"],
    )


def counted(df: DataFrame, label: str, key: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows (and NULL keys) while the data flows by; read ``observation.get`` after the write."""
    seen = Observation(label)
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    if key is not None:
        metrics.append(F.count_if(F.col(key).isNull()).alias("n_null_keys"))
    return df.observe(seen, *metrics), seen


def stage_counts(df: DataFrame, label: str, key: str) -> DataFrame:
    """Rows and distinct keys of a stage as a table."""
    return df.agg(
        F.lit(label).alias("stage"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
    )


def duplicate_key_report(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
        .orderBy(F.desc("count"), key)
    )


__all__ = [
    "counted",
    "dup_members",
    "duplicate_key_report",
    "mapping_template",
    "stage_counts",
    "uncoded_classifications",
    "uncoded_medications",
    "uncoded_side_effects",
]
