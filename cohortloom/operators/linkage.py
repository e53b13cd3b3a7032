"""Joins between resource tables.

Large sides meet in ordinary joins, whose hot keys the adaptive skew join splits at run time. Where
one side is aggregated first - which hides its shuffle from that rule - ``spread_join`` is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.deid import clean_mrn
from cohortloom.operators.ordering import top_per_key
from cohortloom.operators.skew import spread_join


def conditions_with_patients(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    return conditions.join(
        patients, F.col("condition_patient_resource_id") == F.col("patient_resource_id"), "left"
    )


def attach_deaths(df: DataFrame, deaths: DataFrame, patient: str = "patient_resource_id") -> DataFrame:
    return df.join(
        deaths, F.col(patient) == F.col("observation_death_patient_resource_id"), "left"
    )


def attach_to_all_conditions(facts: DataFrame, conditions: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every cohort condition with its facts, NULL where there are none."""
    return conditions.join(facts, list(on), "left")


def attach_left(facts: DataFrame, conditions: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every fact with its condition where known."""
    return facts.join(conditions, list(on), "left")


def restrict_inner(facts: DataFrame, conditions: DataFrame, on: Sequence[str]) -> DataFrame:
    return facts.join(conditions, list(on), "inner")


def tnm_with_parent(tnm: DataFrame, parents: DataFrame, observation: str = "observation_id") -> DataFrame:
    return tnm.join(parents, F.col(observation) == F.col("has_member"), "left")


def cohort_semi(df: DataFrame, keys: DataFrame, df_key: str, cohort_key: str) -> DataFrame:
    """Rows whose key is in the cohort; never fans out and never visits the driver."""
    wanted = keys.select(F.col(cohort_key).alias(df_key))
    return df.join(wanted, df_key, "left_semi")


condition_semi = cohort_semi


def exclude_codes(df: DataFrame, codes: DataFrame, col: str, code_col: str) -> DataFrame:
    return df.join(codes.select(F.col(code_col).alias(col)), col, "left_anti")


def code_list_join(df: DataFrame, codes: DataFrame, col: str, code_col: str) -> DataFrame:
    """Rows whose code is listed. The list is made distinct, so nothing is multiplied."""
    return spread_join(df, codes.select(F.col(code_col).alias(col)).distinct(), [col], "inner")


def resolve_medication(
    statements: DataFrame,
    medications: DataFrame,
    text: str = "medication_statement_text",
    atc: str = "medication_statement_atc_code",
) -> DataFrame:
    """Text and ATC code of a statement, from the referenced medication where not inline."""
    joined = statements.join(
        medications, F.col("medication_reference") == F.col("medication_id"), "left"
    )
    return joined.withColumns(
        {
            text: F.coalesce(text, "medication_medication_text"),
            atc: F.coalesce(atc, "medication_medication_atc_code"),
        }
    ).drop("medication_id", "medication_medication_text", "medication_medication_atc_code")


def parent_child_join(
    parents: DataFrame, children: DataFrame, parent_id: str, child_parent: str, prefix: str = "child_"
) -> DataFrame:
    """Procedures with their parts; clashing child columns get ``prefix``."""
    renamed = children.select(
        *[
            F.col(c).alias(prefix + c if c in parents.columns else c)
            for c in children.columns
        ]
    )
    key = prefix + child_parent if child_parent in parents.columns else child_parent
    return parents.join(renamed, F.col(parent_id) == F.col(key), "left")


def first_mrn(patients: DataFrame, reference: str, mrn: str) -> DataFrame:
    """One record number per patient reference, the smallest, and how many there were."""
    cleaned = patients.select(reference, clean_mrn(mrn).alias(mrn))
    return (
        cleaned.where(F.col(mrn).isNotNull())
        .groupBy(reference)
        .agg(F.min(mrn).alias(mrn), F.count_distinct(mrn).alias("n_mrns"))
    )


def lookup_first_mrn(
    df: DataFrame, patients: DataFrame, df_reference: str, reference: str, mrn: str
) -> DataFrame:
    lookup = first_mrn(patients, reference, mrn).select(
        F.col(reference).alias(df_reference), mrn
    )
    return spread_join(df, lookup, [df_reference], "left")


def mrn_conflicts(patients: DataFrame, reference: str, mrn: str) -> DataFrame:
    return first_mrn(patients, reference, mrn).where(F.col("n_mrns") > 1)


def link_by_mrn(df: DataFrame, reference: DataFrame, df_mrn: str, pseudonym: str) -> DataFrame:
    """Left join of record numbers to the cohort's ``Patient/`` pseudonyms."""
    prefixed = df.withColumn("patient_id_prefixed", F.concat(F.lit("Patient/"), F.col(df_mrn)))
    return prefixed.join(
        reference.withColumnRenamed(pseudonym, "patient_id_prefixed"), "patient_id_prefixed", "left"
    )


def link_by_reference(
    tumours: DataFrame, facts: DataFrame, patient: str, fact_patient: str, number: str | None = None
) -> DataFrame:
    """Left join on the patient; of numbered tumours only the first takes part."""
    base = tumours if number is None else tumours.where(F.col(number) == 1)
    return base.join(facts.withColumnRenamed(fact_patient, patient), patient, "left")


def display_lookup(
    df: DataFrame, book: DataFrame, code: str, book_code: str, title: str, name: str
) -> DataFrame:
    """Label of a code. The code book is reduced to one title per code first."""
    labels = book.groupBy(F.col(book_code).alias(code)).agg(F.min(title).alias(name))
    return spread_join(df, labels, [code], "left")


def unmapped_codes(
    df: DataFrame, book: DataFrame, cols: Sequence[str], code: str, book_code: str
) -> DataFrame:
    """Distinct codes without a label, sorted."""
    return (
        df.select(*cols)
        .where(F.col(code).isNotNull())
        .distinct()
        .join(book.select(F.col(book_code).alias(code)), code, "left_anti")
        .select(*cols)
        .orderBy(*cols)
    )


def matched_subset(
    labs: DataFrame, patients: DataFrame, drugs: DataFrame, lab_ref: str, ref: str, mrn: str, drug_mrn: str
) -> DataFrame:
    """Labs of the patients that occur in a drug table."""
    found = patients.join(drugs.select(F.col(drug_mrn).alias(mrn)), mrn, "left_semi")
    return labs.join(found.select(F.col(ref).alias(lab_ref)), lab_ref, "left_semi")


def match_report(patients: DataFrame, drugs: DataFrame, mrn: str, drug_mrn: str) -> DataFrame:
    """How many patients of either side find a partner."""
    a = patients.select(F.col(mrn).alias("k"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    b = drugs.select(F.col(drug_mrn).alias("k"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    sides = (
        a.unionByName(b)
        .where(F.col("k").isNotNull())
        .groupBy("k")
        .agg(F.max("a").alias("a"), F.max("b").alias("b"))
    )
    return sides.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_patients"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("n_drug_patients"),
        F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("n_matched"),
    )


def column_bind(a: DataFrame, b: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """Add ``columns`` of a row-aligned table by a shared row number.

    A row without partner on either side makes the job fail instead of shifting values.
    """
    left = a.withColumn("_l", F.lit(True))
    right = b.select(row, *columns, F.lit(True).alias("_r"))
    joined = left.join(right, row, "full")
    aligned = F.col("_l") & F.col("_r")
    checked = F.when(aligned, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("row without partner: "), F.col(row).cast("string"))).cast("boolean")
    )
    return joined.withColumn("_ok", checked).where("_ok").drop("_l", "_r", "_ok")


def pair_self_join(df: DataFrame, patient: str, number: str, cols: Sequence[str]) -> DataFrame:
    """Tumour 1 beside tumour 2 of a patient, from one conditional aggregation."""

    def pick(c: str, n: int) -> Column:
        return F.max(F.when(F.col(number) == n, F.col(c))).alias(f"{c}_{n}")

    return (
        df.where(F.col(number).isin(1, 2))
        .groupBy(patient)
        .agg(
            F.count_distinct(F.col(number)).alias("_n"),
            *[pick(c, n) for c in cols for n in (1, 2)],
        )
        .where(F.col("_n") == 2)
        .drop("_n")
    )


def drop_duplicates_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the same one in every run."""
    return top_per_key(df, keys, [F.col(o).asc_nulls_last() for o in order])
