"""Date handling over whole tables, one projection each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dates as D


def cast_dates(df: DataFrame, cols: Iterable[str], allow_datetime: bool = False) -> DataFrame:
    """Partial-date text -> DATE, plus ``<col>_precision``."""
    new = {}
    for c in cols:
        new[c] = D.parse_partial_date(c, allow_datetime)
        new[f"{c}_precision"] = D.date_precision(c)
    return df.withColumns(new)


def compute_age(
    df: DataFrame, ref: str = "asserted_date", birth: str = "birthdate", name: str = "age_at_diagnosis"
) -> DataFrame:
    return df.withColumn(name, D.age_at(ref, birth))


def months_diff(df: DataFrame, col: str, ref: str) -> DataFrame:
    return df.withColumn(f"{col}_diff", D.months_since(col, ref))


def _dated(columns: Sequence[str], excluded: Sequence[str]) -> list[str]:
    return [
        c for c in columns if "date" in c.lower() and not any(x in c.lower() for x in excluded)
    ]


def months_to_reference_all(df: DataFrame, ref: str = "asserted_date") -> DataFrame:
    """``months_between_asserted_<c>`` for every date column besides the reference."""
    cols = _dated(df.columns, ["asserted_date", "diff", "precision", "year"])
    return df.withColumns({f"months_between_asserted_{c}": D.months_since(c, ref) for c in cols})


def drop_date_columns(df: DataFrame) -> DataFrame:
    return df.drop(*_dated(df.columns, ["precision", "between", "year"]))


YEAR_COLUMNS = {
    "asserted_date": "asserted_year",
    "deceased_datetime": "deceased_datetime_year",
    "date_death": "date_death_year",
    "therapy_start_date": "therapy_start_date_year",
}


def year_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({y: F.year(d) for d, y in YEAR_COLUMNS.items() if d in df.columns})


def year_range(df: DataFrame, date: str = "asserted_date") -> DataFrame:
    return df.agg(F.min(F.year(date)).alias("year_min"), F.max(F.year(date)).alias("year_max"))


def date_range_profile(df: DataFrame, dates: Sequence[str], patient: str) -> DataFrame:
    """Earliest and latest of several dates and the number of patients, in one pass."""
    bounds = [f(c).alias(f"{p}_{c}") for c in dates for p, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.count_distinct(patient).alias("n_patients"), *bounds)
