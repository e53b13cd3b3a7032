"""Patients with one and with two tumours: numbering, wide tables, pair statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.codes import icd_category
from cohortloom.operators.predicates import classification_is
from cohortloom.operators.quantiles import exact_quantiles, join_null_safe
from cohortloom.operators.skew import spread_join
from cohortloom.session import materialise

PATIENT = "patient_resource_id"
# Tasks that share the rows of one patient at most.
SLICES = 64


def two_malignancies(
    df: DataFrame,
    patient: str = PATIENT,
    date: str = "asserted_date",
    condition: str = "condition_id",
    flag: str | None = "double_patid",
) -> DataFrame:
    """The first two tumours of every patient who still has at least two.

    The rows of a patient are dealt over slices; each slice is counted and cut to its first two rows
    in one pass, and the patient's two come from those. They carry ordinal, total, previous date, and
    the gap in months and years.
    """
    multi = df.where(F.col(patient).isNotNull())
    if flag is not None:
        multi = multi.where(F.col(flag) == 1)
    order = [F.col(date).asc_nulls_first(), F.col(condition).asc()]
    sliced = Window.partitionBy(patient, "_slice")
    leading = (
        multi.withColumn("_slice", F.pmod(F.xxhash64(date, condition), F.lit(SLICES)))
        .withColumn("_rows", F.count(F.lit(1)).over(sliced))
        .withColumn("_place", F.row_number().over(sliced.orderBy(*order)))
        .where(F.col("_place") <= 2)
    )
    of_patient = Window.partitionBy(patient)
    by_order = of_patient.orderBy(*order)
    gap = F.months_between(F.col(date), F.col("date_prev"))
    return (
        leading.withColumn("malignancy_count", F.sum(F.when(F.col("_place") == 1, F.col("_rows"))).over(of_patient))
        .withColumns({"malignancy_number": F.row_number().over(by_order), "date_prev": F.lag(date).over(by_order)})
        .where((F.col("malignancy_number") <= 2) & (F.col("malignancy_count") >= 2))
        .select(
            patient,
            *[c for c in df.columns if c != patient],
            "malignancy_number",
            "malignancy_count",
            "date_prev",
            F.round(gap / 12, 2).alias("years_between"),
            F.round(gap, 1).alias("months_between"),
        )
    )


def one_malignancy(df: DataFrame, flag: str = "double_patid") -> DataFrame:
    return df.where(F.col(flag) == 0)


def one_row_per_patient(df: DataFrame, patient: str = PATIENT) -> DataFrame:
    """Consistency report: rows should equal distinct patients."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(patient).alias("n_patients")
    )


TUMOUR_COLUMNS = [
    "condition_id",
    "asserted_date",
    "icd10_code",
    "icd10_parent_code",
    "entity_or_parent",
    "age_at_diagnosis",
]


def pivot_tumours(
    two: DataFrame,
    one: DataFrame,
    cols: Sequence[str] = TUMOUR_COLUMNS,
    patient: str = PATIENT,
    keep: Sequence[str] = ("gender", "double_patid"),
    number: str = "malignancy_number",
) -> DataFrame:
    """One row per patient with ``<col>_1`` and ``<col>_2``; single tumours fill ``_1`` only."""
    first = [F.first(c, ignorenulls=True).alias(c) for c in cols]
    wide = two.groupBy(patient, *keep).pivot(number, [1, 2]).agg(*first)
    wide = wide.select(
        patient, *keep, *[F.col(f"{n}_{c}").alias(f"{c}_{n}") for c in cols for n in (1, 2)]
    )
    single = one.select(patient, *keep, *[F.col(c).alias(f"{c}_1") for c in cols])
    return wide.unionByName(single, allowMissingColumns=True)


def tumour_pairs(
    two: DataFrame,
    entity: str = "entity_or_parent",
    patient: str = PATIENT,
    age: str = "age_at_diagnosis",
    gap: str = "months_between",
    number: str = "malignancy_number",
) -> DataFrame:
    """One row per patient: both entities, both ages, the gap, gender."""

    def at(c: str, n: int) -> Column:
        return F.max(F.when(F.col(number) == n, F.col(c)))

    return (
        two.groupBy(patient)
        .agg(
            at(entity, 1).alias(f"{entity}_1"),
            at(entity, 2).alias(f"{entity}_2"),
            at(age, 1).alias("age_1"),
            at(age, 2).alias("age_2"),
            at(gap, 2).alias("months_between_2"),
            at("gender", 1).alias("gender"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where(F.col("_n") == 2)
        .drop("_n")
    )


_MEASURES = {"age_1": ("age", "1"), "age_2": ("age", "2"), "months_between_2": ("months_between", "2")}


def pair_statistics(pairs: DataFrame, entity: str = "entity_or_parent") -> DataFrame:
    """Counts, extremes and quartiles per pair of entities, sorted by pair.

    Quartiles are values of the data, exact for pairs of any frequency. The pairs are written once:
    counts and quartiles both read them.
    """
    keys = [f"{entity}_1", f"{entity}_2"]
    pairs = materialise(pairs.select(*keys, "gender", *_MEASURES), "pairs")
    counts = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count_pair"),
        F.count_if(F.col("gender") == "male").alias("count_male_pair"),
        F.count_if(F.col("gender") == "female").alias("count_female_pair"),
        *[f(c).alias(f"{c}_{n}") for c in _MEASURES for n, f in (("min", F.min), ("max", F.max))],
    )
    quartiles = exact_quantiles(pairs, keys, list(_MEASURES), [0.25, 0.5, 0.75], interpolated=False)
    joined = join_null_safe(counts, quartiles, keys)
    stats = []
    for c, (stem, n) in _MEASURES.items():
        stats += [F.col(f"{c}_{x}").alias(f"{stem}_{x}_{n}") for x in ("min", "max")]
        stats += [F.col(f"{c}_quantiles")[i].alias(f"{stem}_{x}_{n}") for i, x in enumerate(("q1", "median", "q3"))]
    return joined.select(*keys, "count_pair", "count_male_pair", "count_female_pair", *stats).orderBy(*keys)


def pair_outliers(pairs: DataFrame, entity: str = "entity_or_parent") -> DataFrame:
    """Values beyond the Tukey fences of their pair, one row per value.

    Kept in long form: a frequent pair may have any number of outliers, which as a list in one
    cell would all pass through one task. The pairs are written once: fences and values both read them.
    """
    keys = [f"{entity}_1", f"{entity}_2"]
    pairs = materialise(pairs.select(*keys, *_MEASURES), "pairs")
    fences = exact_quantiles(pairs, keys, list(_MEASURES), [0.25, 0.75], interpolated=False)
    long = spread_join(pairs, fences, keys, "inner")
    checks = []
    for c in _MEASURES:
        q1, q3 = F.col(f"{c}_quantiles")[0], F.col(f"{c}_quantiles")[1]
        iqr = q3 - q1
        outside = (F.col(c) < q1 - F.lit(1.5) * iqr) | (F.col(c) > q3 + F.lit(1.5) * iqr)
        checks.append(
            F.when(outside, F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")))
        )
    return long.select(
        *keys, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("_o")
    ).select(*keys, "_o.measure", "_o.value")


def gender_counts(
    df: DataFrame,
    code: str = "icd10_code",
    gender: str = "gender",
    text: str = "weitere_klassifikation_code_text",
    grade: str = "weitere_klassifikation_code",
) -> DataFrame:
    """Total, male and female per ICD category, and the high-grade brain tumours as a row."""

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("icd10_parent").agg(
            F.count(F.lit(1)).alias("total_count"),
            F.count_if(F.col(gender) == "male").alias("male_count"),
            F.count_if(F.col(gender) == "female").alias("female_count"),
        )

    base = df.withColumn("icd10_parent", icd_category(code))
    grade4 = df.where(F.col(code).startswith("C71") & classification_is(text, grade)).withColumn(
        "icd10_parent", F.lit("C71_IV")
    )
    return counted(base).unionByName(counted(grade4)).orderBy("icd10_parent")
