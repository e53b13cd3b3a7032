"""Deaths: consolidation of several reports, flags, precedence of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.dates import parse_iso
from cohortloom.operators.skew import spread_join

PATIENT = "observation_death_patient_resource_id"


def _first_flag() -> Column:
    """Known tumour flag of the smallest observation id, the smaller flag where one has several."""
    flag = F.col("death_cause_tumor")
    return F.min_by(flag, F.when(flag.isNotNull(), F.struct(F.col("observation_resource_id"), flag)))


def consolidate_deaths(deaths: DataFrame) -> DataFrame:
    """One row per patient out of repeated death observations.

    Repeats of a cause and date collapse first, and a tumour code (C..) with an unknown or negative
    tumour flag counts as death by tumour. Per patient follow the earliest date, the smallest
    observation id and tumour flag, and all causes as a sorted set.
    """
    per_cause = deaths.groupBy(PATIENT, "death_cause_icd10", "date_death").agg(
        F.min("observation_resource_id").alias("observation_resource_id"),
        _first_flag().alias("death_cause_tumor"),
    )
    by_tumour = F.col("death_cause_icd10").startswith("C") & F.col("death_cause_tumor").isin("U", "N")
    fixed = per_cause.withColumn(
        "death_cause_tumor", F.when(by_tumour, F.lit("J")).otherwise(F.col("death_cause_tumor"))
    )
    return fixed.groupBy(PATIENT).agg(
        F.min("date_death").alias("date_death"),
        F.min("observation_resource_id").alias("observation_resource_id"),
        _first_flag().alias("death_cause_tumor"),
        F.nullif(
            F.array_join(F.sort_array(F.collect_set("death_cause_icd10")), "|"), F.lit("")
        ).alias("death_cause_icd10"),
    )


def tumour_flag_fixes(deaths: DataFrame) -> DataFrame:
    """How many flags the consolidation turns into death by tumour."""
    hit = F.col("death_cause_icd10").startswith("C") & F.col("death_cause_tumor").isin("U", "N")
    return deaths.agg(F.count_if(hit).alias("n_fixed"))


def is_deceased(df: DataFrame) -> DataFrame:
    """True on any sign of death: the flag itself, a date, a cause."""
    signs = ["deceased_datetime", "date_death", "death_cause_icd10", "death_cause_tumor"]
    any_sign = F.coalesce(F.col("deceased_boolean"), F.lit(False))
    for c in signs:
        any_sign = any_sign | F.col(c).isNotNull()
    return df.withColumn("is_deceased", any_sign)


def death_precedence(
    patients: DataFrame,
    registry_deaths: DataFrame,
    vital_status: DataFrame,
    mrn: str = "patient_mrn",
) -> DataFrame:
    """Final time of death and last follow-up per patient row.

    The latest registry death overrides the server's; the latest vital status ``T`` overrides both;
    the latest status ``L`` is the last follow-up. All three come from one row per patient.
    """
    reg_time = parse_iso(F.col("death_dateTime").cast("string"))
    facts = F.struct("death_caused_by_tumor", "cause_of_death")
    registry = (
        registry_deaths.where(reg_time.isNotNull() & F.col(mrn).isNotNull())
        .groupBy(mrn)
        .agg(
            F.max(reg_time).alias("_registry"),
            F.max_by(facts, F.struct(reg_time, F.col("cause_of_death"))).alias("_facts"),
        )
    )
    seen = parse_iso(F.col("effective_dateTime").cast("string"))
    status = (
        vital_status.where(F.col(mrn).isNotNull() & F.col("vitalstatus_code").isin("T", "L"))
        .groupBy(mrn)
        .agg(
            F.max(F.when(F.col("vitalstatus_code") == "T", seen)).alias("_status_death"),
            F.max(F.when(F.col("vitalstatus_code") == "L", seen)).alias("last_follow_up_datetime"),
        )
    )
    joined = spread_join(spread_join(patients, registry, [mrn]), status, [mrn])
    server = parse_iso(F.col("deceased_dateTime").cast("string"))
    time = F.coalesce("_status_death", "_registry", server)
    return joined.withColumns(
        {
            "deceased_dateTime": time,
            "deceased": F.coalesce(F.col("deceased_boolean"), F.lit(False)) | time.isNotNull(),
            "death_caused_by_tumor": F.col("_facts.death_caused_by_tumor"),
            "cause_of_death": F.col("_facts.cause_of_death"),
        }
    ).drop("_registry", "_facts", "_status_death")
