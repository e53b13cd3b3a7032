"""How many prostate patients staged N0 or M0 received a drug, before and after a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from cohortloom import constants as K
from cohortloom.operators import dates as OD
from cohortloom.operators import linkage as L
from cohortloom.operators import predicates as PR
from cohortloom.operators import stats as S
from cohortloom.operators import views as V
from cohortloom.operators.nearest import nearest_per_key
from cohortloom.plans.base import Source, Tables

REFERENCE_DATE = "2024-04-01"


def treatment_question(
    source: Source,
    drug: str = K.ENZALUTAMIDE,
    reference: str = REFERENCE_DATE,
    codes: Sequence[str] = (K.PROSTATE,),
) -> Tables:
    conditions = V.prostate_conditions(source["Condition"], codes)
    staging = V.tnm_nm_staging(source["Observation"])
    statements = L.resolve_medication(
        V.medication_statements(source["MedicationStatement"]), V.medications(source["Medication"])
    ).select(
        "medication_statement_id",
        F.col("subject_reference").alias("medication_statement_patient_id"),
        F.col("reason_reference").alias("condition_id"),
        F.col("medication_statement_start_date").alias("medication_start_date"),
        F.col("medication_statement_text").alias("medication_text"),
        F.col("medication_statement_atc_code").alias("medication_atc_code"),
    )
    nearest = nearest_per_key(
        conditions.withColumnRenamed("patient_id", "condition_patient_id"),
        staging,
        "condition_id",
        "asserted_date",
        "effective_date_time",
        "observation_id",
        how="inner",
    )
    early = PR.code_value_in(nearest, "tnm_value", K.EARLY_STAGES)
    treated = early.join(statements, "condition_id", "inner")
    cohort = treated.where(F.col("medication_atc_code") == drug).select(
        "condition_id",
        "observation_id",
        "patient_id",
        "effective_date_time_first",
        "code_coding_sct",
        "tnm_value",
        "code",
        "display",
        "condition_patient_id",
        "asserted_date",
        "recorded_date",
        "medication_statement_id",
        "medication_statement_patient_id",
        "medication_start_date",
        "medication_text",
        "medication_atc_code",
    )
    # One flag table for the funnel: conditions, with staging and treatment where present.
    drug_rows = statements.where(F.col("medication_atc_code") == drug).select(
        "condition_id", "medication_start_date", F.lit(True).alias("_treated")
    )
    flags = (
        conditions.join(
            early.select("condition_id", F.lit(True).alias("_early")), "condition_id", "left"
        )
        .join(drug_rows, "condition_id", "left")
    )
    is_early = F.col("_early").isNotNull()
    is_treated = is_early & F.col("_treated").isNotNull()
    start = F.col("medication_start_date")
    funnel = S.cohort_funnel(
        flags,
        {
            "all": F.lit(True),
            "early_stage": is_early,
            "treated": is_treated,
            "before": is_treated & (start < F.lit(reference)),
            "after": is_treated & (start >= F.lit(reference)),
        },
        "patient_id",
    )
    return Tables({
        "cohort": lambda: cohort,
        "medication_counts": lambda: S.distinct_patients_by(
            treated, ["medication_text", "medication_atc_code"], "patient_id"
        ),
        "staging_counts": lambda: S.distinct_patients_by(
            nearest, ["code", "display", "tnm_value"], "patient_id"
        ),
        "before_after": lambda: PR.before_after(
            cohort, ["medication_atc_code"], "patient_id", "medication_start_date", reference
        ),
        "funnel": lambda: funnel,
        "ranges": lambda: OD.date_range_profile(conditions, ["asserted_date", "recorded_date"], "patient_id"),
    })
