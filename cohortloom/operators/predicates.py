"""Cohort filters and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filter_primary_diagnosis(df: DataFrame, profile: str = "meta_profile") -> DataFrame:
    """For flat tables; ``views.primary_conditions`` tests the same before projecting."""
    return df.where(F.col(profile).startswith(K.PRIMARY_TUMOUR))


# Leukaemia and lymphoma selection.
LEUKAEMIA_EXACT = ["C83.3", "C83.1"]
LEUKAEMIA_PREFIXES = ["C90", "C91", "C92", "C93", "C94", "C95", "D46", "C82", "C85"]


def filter_icd_codes(
    df: DataFrame,
    code: str = "icd10_code",
    exact: Sequence[str] = LEUKAEMIA_EXACT,
    prefixes: Sequence[str] = LEUKAEMIA_PREFIXES,
) -> DataFrame:
    return df.where(
        F.col(code).isin(list(exact)) | F.col(code).rlike("^(" + "|".join(prefixes) + ")")
    )


def filter_entity_window(
    df: DataFrame,
    code: str = "icd10_code",
    date: str = "asserted_date",
    years: tuple[int, int] = (2018, 2025),
) -> DataFrame:
    """Oesophagus, colon, lung, exocrine pancreas and brain within the diagnosis years."""
    c = F.col(code)
    pancreas = c.startswith("C25") & ~c.startswith("C25.4")
    wanted = (
        c.startswith("C15") | c.startswith("C18") | c.startswith("C34") | pancreas | c.startswith("C71")
    )
    return df.where(wanted & F.year(date).between(*years))


PLACEHOLDER_UNTIL = "1970-12-31"


def clean_conditions(
    df: DataFrame,
    date: str = "asserted_date",
    age: str = "age_at_diagnosis",
    code: str | None = "icd10_code",
) -> DataFrame:
    """Drop placeholder dates, non-positive ages and, given ``code``, skin and in-situ codes."""
    out = df.where((F.col(date).cast("date") > F.lit(PLACEHOLDER_UNTIL).cast("date")) & (F.col(age) > 0))
    if code is not None:
        out = out.where(~F.col(code).startswith("C44") & ~F.col(code).startswith("D04"))
    return out


def drop_exact_placeholders(df: DataFrame, date: str) -> DataFrame:
    """Drop only the two dates that a missing year or month turns into."""
    d = F.col(date).cast("date")
    bad = d.isin(F.lit("1970-01-01").cast("date"), F.lit("1970-07-01").cast("date"))
    return df.where(~F.coalesce(bad, F.lit(False)))


def flag_cohort(
    df: DataFrame,
    age: str = "age_at_diagnosis",
    score: str = "gleason_score",
    max_age: float = 65,
    min_score: int = 8,
    name: str = "cohort_flag",
) -> DataFrame:
    """Young and high-risk; unknown values give 0."""
    hit = (F.col(age) < max_age) & (F.col(score) >= min_score)
    return df.withColumn(name, F.when(hit, F.lit(1)).otherwise(F.lit(0)))


def code_value_in(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def before_after(
    df: DataFrame, by: Sequence[str], patient: str, date_text: str, reference: str
) -> DataFrame:
    """Patients before, and on or after, a reference date; partial dates compare as text."""
    early = F.col(date_text) < F.lit(reference)
    per_patient = df.groupBy(*by, patient).agg(
        F.bool_or(early).alias("_before"), F.bool_or(~early).alias("_after")
    )
    known = F.col(patient).isNotNull()
    return per_patient.groupBy(*by).agg(
        F.count_if(known & F.col("_before")).alias("num_patients_before"),
        F.count_if(known & F.col("_after")).alias("num_patients_after"),
    )


def has_second_tumour(df: DataFrame, col: str = "condition_id_2") -> DataFrame:
    return df.where(F.trim(F.col(col)) != "")


def drop_sentinel(df: DataFrame, col: str, sentinel: str = "*** VALUE NOT FOUND ***") -> DataFrame:
    """Rows whose pseudonym is known; NULL goes with the sentinel."""
    return df.where(F.col(col) != sentinel)


def row_digest(df: DataFrame) -> Column:
    """Row id that depends on the content only, so it needs no global order."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)


def fill_missing_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add absent columns: a Column is taken as it is, other values become literals."""
    absent = {
        c: d if isinstance(d, Column) else F.lit(d).cast("string") if d is None else F.lit(d)
        for c, d in defaults.items()
        if c not in df.columns
    }
    return df.withColumns(absent) if absent else df


def classification_is(
    text: Column | str, code: Column | str, word: str = "who", codes: Sequence[str] = ("IV", "4")
) -> Column:
    return F.lower(_col(text)).contains(word) & _col(code).isin(list(codes))


def limit_entities(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows of the first ``n`` keys, for looking at a study by eye."""
    few = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)
    return df.join(few, key, "left_semi")


# Half-open diagnosis periods.
YEAR_SLICES = [
    ("1990-2000", "1990-01-01", "2000-01-01"),
    ("2000-2010", "2000-01-01", "2010-01-01"),
    ("2010-2020", "2010-01-01", "2020-01-01"),
    ("2020-2026", "2020-01-01", "2026-12-31"),
]


def year_slice(date: Column | str, slices: Sequence[tuple[str, str, str]] = YEAR_SLICES) -> Column:
    """Label of the period a date falls into, NULL outside: one grouping column, one job."""
    d = _col(date).cast("date")
    out = None
    for label, start, end in slices:
        inside = (d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date"))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out
