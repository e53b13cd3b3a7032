"""De-identification of tables: keyed hashes, one day shift per run, dropped columns."""

from __future__ import annotations

import re
import secrets
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dates as D
from cohortloom.functions import text as X
from cohortloom.functions.deid import hmac_sha256
from cohortloom.operators import dates as OD
from cohortloom.operators.predicates import drop_sentinel, fill_missing_columns, row_digest

# Columns replaced by ``<name>_hash``, and columns that leave the table.
HASHED = [
    "condition_id",
    "condition_id_1",
    "condition_id_2",
    "condition_id_mii",
    "patient_resource_id",
    "patid_pseudonym",
    "condition_patient_reference",
    "parent_tnm_observation_id",
    "uicc_observation_id",
    "has_member",
    "patient_mrn",
    "all_condition_patient_reference",
    "condition_encounter_reference",
    "focus_reference",
]
IDENTIFYING = [
    "meta_profile",
    "condition_patient_resource_id",
    "patid_pseudonym",
    "deceased_boolean",
    "observation_death_patient_resource_id",
    "observation_resource_id",
    "reason_reference",
    "subject_reference",
    "therapy_id",
    "therapy_id_child",
    "observation_id",
    "observation_gleason_resource_id",
    "observation_gleason_condition_resource_id",
    "observation_gleason_patient_resource_id",
    "observation_metastasis_resource_id",
    "observation_patient_reference",
    "patient_id",
    "patient_id_prefixed",
    # Not a fixed value: a raw reference to another procedure must not survive either.
    "part_of_reference",
]
SERVER_HASHED = [
    "condition_id",
    "condition_patient_reference",
    "observation_patient_reference",
    "all_condition_patient_reference",
    "condition_encounter_reference",
]

# Columns of the study tables that may leave as they are (dates leave as years and months). A column
# that is neither here nor hashed nor dropped has no rule, and its table isn't released.
PLAIN = frozenset(
    """
    age_at_diagnosis age_class age_max age_median age_min age_q1 age_q3 asserted_date
    asserted_date_precision bin birthdate birthdate_precision cohort_count cohort_flag col
    combo_label condition_verificationStatus count count_female_pair count_male_pair count_pair
    cumulative date date1 date2 date_death date_death_precision date_prev death_cause_icd10
    death_cause_tumor deceased_datetime diagnosis_onsetDateTime diagnosis_recordedDate
    diagnosis_year distant_metastasis_status double_patid ecog_performance_status effective_dateTime
    effective_dateTime_precision entity_label entity_or_parent female_ratio gender gleason_10_count
    gleason_6_count gleason_7_count gleason_8_count gleason_9_count gleason_date gleason_date_diff
    gleason_date_precision gleason_score gleason_sct grading grading_date grading_date_precision
    gruppe icd10_code icd10_parent_code icd_code icdo3_morphology icdo3_topography is_deceased
    karnofsky_performance_status location lymph_node_status m_tnm m_tnm_c_p_snomed_prefix m_tnm_date
    m_tnm_date_precision m_tnm_prefix m_tnm_prefix_sct malignancy_count malignancy_number max mean
    mean_age measure medication_statement_atc_code medication_statement_text
    meta_1_before_T2_interval meta_at_first meta_before_dx_T1_interval_yes meta_before_dx_T2
    meta_date meta_date1 meta_date2 metastasis_date metastasis_date_first metastasis_date_first_diff
    metastasis_date_first_precision metastasis_date_precision metastasis_kind metastasis_loc
    metastatic_flag min months_between months_between_max months_between_median months_between_min
    months_between_q1 months_between_q3 months_diff n n_event n_implausible_year n_inconsistent n_na
    n_nonempty n_parsed n_patients n_risk n_rows n_tnm n_tnm_c_p_snomed_prefix n_tnm_date
    n_tnm_date_precision n_tnm_prefix n_tnm_prefix_sct n_total negative ops_code
    overall_assessment_of_tumor_regression overall_count parent_tnm_date parent_tnm_date_precision
    pattern percentage positive prec_day prec_month prec_year primary_tumor_status q00 q01 q05 q100
    q50 q95 q99 recorded_date stellung_op surgery_outcome survival synchron_count t_tnm
    t_tnm_c_p_snomed_prefix t_tnm_date t_tnm_date_precision t_tnm_prefix t_tnm_prefix_sct
    therapy_end_date therapy_end_date_precision therapy_end_reason therapy_intention
    therapy_protocol_text therapy_start_date therapy_start_date_precision therapy_type time timediff
    uicc_tnm uicc_tnm_c_p_snomed_prefix uicc_tnm_date uicc_tnm_date_precision uicc_tnm_prefix_sct
    valid value vitalstatus_code vitalstatus_system weitere_klassifikation_date
    weitere_klassifikation_date_precision weitere_klassifikation_name
    weitere_klassifikation_value_code weitere_klassifikation_value_system
    weitere_klassifikation_value_text y_tnm y_tnm_date y_tnm_date_precision year_max year_min
    year_slice years_between zero zielgebiet
    loinc_code loinc_display lab_dateTime lab_quantity_value lab_quantity_unit lab_codeableconcept_code
    """.split()
)


class UnknownColumn(ValueError):
    """A column without a rule for de-identification."""


@dataclass(frozen=True)
class RunSecret:
    """One key and one day shift for all tables of a run, so that hashes still join."""

    key: bytes = field(repr=False)
    day_shift: int = field(repr=False)


def run_secret(key: bytes | None = None, day_shift: int | None = None, size: int = 32) -> RunSecret:
    """Fresh secret, or the injected one. The shift lies between -30 and +30 days."""
    return RunSecret(
        secrets.token_bytes(size) if key is None else key,
        secrets.randbelow(61) - 30 if day_shift is None else day_shift,
    )


def hash_columns(
    df: DataFrame, key: bytes, cols: Sequence[str], *, suffix: str = "_hash", drop: bool = True
) -> DataFrame:
    there = [c for c in cols if c in df.columns]
    out = df.withColumns({c + suffix: hmac_sha256(c, key) for c in there})
    return out.drop(*there) if drop and suffix else out


def _named(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """Columns with one of the names, or with one of them and an ordinal (``therapy_id_3``)."""
    return [c for c in columns if c in names or re.sub(r"_\d+$", "", c) in names]


def deidentify(
    df: DataFrame,
    key: bytes,
    *,
    drop_original: bool = True,
    identifying: Sequence[str] = IDENTIFYING,
    plain: Sequence[str] = (),
) -> DataFrame:
    """Hash the keys, drop what identifies, turn dates into months since diagnosis and years.

    Every other column must be in ``PLAIN`` or named in ``plain``, else this raises.
    """
    ruled = _named(df.columns, [*HASHED, *identifying, *PLAIN, *plain])
    dated = [c for c, t in df.dtypes if t in ("date", "timestamp")]
    if unknown := sorted(set(df.columns) - set(ruled) - set(dated)):
        raise UnknownColumn(f"no rule for {', '.join(unknown)}")
    out = hash_columns(df, key, _named(df.columns, HASHED), drop=drop_original)
    out = out.drop(*_named(out.columns, identifying))
    if "asserted_date" in out.columns:
        out = OD.months_to_reference_all(out)
    return OD.drop_date_columns(OD.year_columns(out))


def deidentify_server(df: DataFrame, key: bytes, *, drop_original: bool = True) -> DataFrame:
    """Variant for server extracts: key and reference columns, dates untouched."""
    return hash_columns(df, key, SERVER_HASHED, drop=drop_original)


@dataclass(frozen=True)
class TableSpec:
    """What happens to the columns of one exported table.

    ``hashed`` are replaced in place, ``shifted`` parsed and moved by the run's days, ``dropped``
    removed. ``parse`` is ``coerce`` (bad text becomes NULL) or ``raise``.
    """

    hashed: tuple[str, ...]
    shifted: tuple[str, ...] = ()
    parse: str = "coerce"
    dropped: tuple[str, ...] = ()
    birth_date: str | None = None
    defaults: Mapping[str, object] = field(default_factory=dict)
    day_first: tuple[str, ...] = ()


# The letter's key starts with the record number.
_FINDINGS = TableSpec(("patient_mrn", "account_id", "source_file", "letter_key"), ("document_date", "date"))
_REGISTRY_OBSERVATION = ("observation_id", "observation_patient_reference", "patient_mrn", "patient_id")
_REGISTRY_CONDITION = TableSpec(
    ("condition_id", "condition_patient_reference", "patient_mrn", "patient_id"),
    ("diagnosis_recordedDate", "diagnosis_onsetDateTime", "diagnosis_assertedDateTime"),
    "raise",
)

TABLE_SPECS = {
    "patients": TableSpec(
        ("condition_id", "condition_patient_reference", "patient_mrn"),
        (
            "diagnosis_onsetDateTime",
            "diagnosis_recordedDate",
            "deceased_dateTime",
            "last_follow_up_datetime",
        ),
        birth_date="birth_date",
    ),
    "conditions": TableSpec(
        ("condition_id", "all_condition_patient_reference", "condition_encounter_reference", "patient_mrn"),
        ("diagnosis_recordedDate", "diagnosis_onsetDateTime"),
    ),
    "encounters": TableSpec(
        ("encounter_id", "encounter_patient_reference", "patient_mrn"),
        ("enc_period_start", "enc_period_end"),
    ),
    "genes": _FINDINGS,
    "karyotypes": _FINDINGS,
    "eln_risk": _FINDINGS,
    "medication_events": TableSpec(
        ("id", "patient_reference", "patient_mrn", "medication_reference"), ("datetime", "period_end")
    ),
    "medications": TableSpec(("medication_id",)),
    "procedures": TableSpec(
        ("procedure_id", "procedure_patient_reference", "patient_mrn"), ("timestamp",)
    ),
    "classifications": TableSpec(
        (*_REGISTRY_OBSERVATION, "observation_condition_reference"), ("effective_dateTime",), "raise"
    ),
    "ecog": TableSpec(_REGISTRY_OBSERVATION, ("effective_dateTime",), "raise"),
    "progressions": TableSpec(_REGISTRY_OBSERVATION, ("effective_dateTime",), "raise"),
    "tumour_conditions": _REGISTRY_CONDITION,
    "all_tumour_conditions": _REGISTRY_CONDITION,
    "system_therapies": TableSpec(
        ("medication_statement_id", "patient_reference", "condition_id", "patient_mrn", "patient_id"),
        ("medication_start_date",),
        "raise",
    ),
    "tumour_procedures": TableSpec(
        (
            "procedure_id",
            "procedure_patient_reference",
            "procedure_condition_reference",
            "patient_mrn",
            "patient_id",
        ),
        ("performed_period_start", "performed_period_end"),
        "raise",
    ),
    "genetic_variants": TableSpec(
        (*_REGISTRY_OBSERVATION, "observation_condition_reference"), ("effective_dateTime",), "raise"
    ),
    "prescriptions": TableSpec(
        ("REZEPT_ID", "patient_mrn"),
        ("REZEPT_DATUM", "AUFNAHME_DATUM"),
        dropped=("FALL_ID", "TEILFALL_ID"),
        defaults={"AUFNAHME_DATUM": None},
        day_first=("REZEPT_DATUM",),
    ),
    "labs": TableSpec(
        ("observation_id", "observation_patient_reference", "patient_mrn"), ("lab_dateTime",)
    ),
    # Findings of the letter extractor
    "letter_findings": TableSpec(
        ("patient_mrn", "account_id", "source_file"), ("document_date", "date")
    ),
}


# Names of columns that hold ids, references or record numbers.
_TELLING = re.compile(r"reference|(^|_)id(_|$)|mrn|identifier|pseudonym|source_file|letter_key|account", re.IGNORECASE)


def deidentify_table(df: DataFrame, spec: TableSpec, secret: RunSecret) -> DataFrame:
    """Apply a table specification in one projection.

    A column whose name tells of an id, a reference or a record number must have a rule.
    """
    ruled = {*spec.hashed, *spec.shifted, *spec.dropped, *spec.defaults, spec.birth_date}
    if unknown := [c for c in df.columns if _TELLING.search(c) and c not in ruled]:
        raise UnknownColumn(f"no rule for {', '.join(sorted(unknown))}")
    if "REZEPT_ID" in spec.hashed and "REZEPT_ID" not in df.columns:
        df = df.withColumn("REZEPT_ID", row_digest(df))
    df = fill_missing_columns(df, spec.defaults)
    new: dict[str, Column] = {}
    for c in spec.hashed:
        if c in df.columns:
            new[c] = hmac_sha256(c, secret.key)
    for c in spec.shifted:
        if c in df.columns:
            ts = (
                D.mixed_dayfirst(F.col(c).cast("string"))
                if c in spec.day_first
                else D.parse_iso(F.col(c).cast("string"), spec.parse)
            )
            new[c] = D.shift_days(ts, secret.day_shift)
    gone = list(spec.dropped)
    if spec.birth_date and spec.birth_date in df.columns:
        new["birth_year"] = F.year(D.parse_iso(F.col(spec.birth_date).cast("string")))
        gone.append(spec.birth_date)
    return df.withColumns(new).drop(*gone) if new else df.drop(*gone)


# Drug-preparation exports ---------------------------------------------------------------------

DRUG_DEFAULTS = {
    "Retoure": "FALSCH",
    "Applikationsart": None,
    "Zeit": "08:00",
    "Therapieprotokoll": None,
}
CASE_COLUMNS = ["FALL_ID", "TEILFALL_ID", "Datum", "Zeit", "Herstellungsdatum", "Herstellungszeit", "KIS-Patienten-ID"]


def drop_case_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in [*CASE_COLUMNS, *extra] if c in df.columns])


def deidentify_drug_export(df: DataFrame, patient_column: str, secret: RunSecret) -> DataFrame:
    """Drug preparations: shifted local time of use, one label text, hashed ids, no case columns."""
    known = drop_sentinel(df, patient_column)
    if "Herstellungs-ID" not in known.columns:
        known = known.withColumn("Herstellungs-ID", row_digest(known))
    known = fill_missing_columns(known, DRUG_DEFAULTS)
    used_at = D.shift_days(
        D.localize(D.combine_date_time("Datum", "Zeit")), secret.day_shift
    )
    label = X.labelled(
        [
            ("Wirkstoff: ", F.col("Wirkstoff")),
            (" (Dosis: ", F.col("Dosis")),
            (") Protokoll: ", F.col("Therapieprotokoll")),
            (" Applikationsart: ", F.col("Applikationsart")),
            (" Retoure?: ", F.col("Retoure")),
        ]
    )
    out = known.withColumns(
        {
            "Applikationszeitpunkt": used_at,
            "label": label,
            "Herstellungs-ID": hmac_sha256("`Herstellungs-ID`", secret.key),
            "_mrn": hmac_sha256(f"`{patient_column}`", secret.key),
        }
    )
    return drop_case_columns(out.drop(patient_column)).withColumnRenamed("_mrn", "patient_mrn")


def mrn_lookup_table(df: DataFrame, mrn: str, key: bytes) -> DataFrame:
    """Record number and hash; belongs outside every de-identified folder."""
    return (
        df.select(mrn)
        .where(F.col(mrn).isNotNull())
        .distinct()
        .withColumn(f"{mrn}_hash", hmac_sha256(mrn, key))
    )


def clean_literals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``NaN`` and ``nan`` text becomes NULL."""
    wanted = cols or [c for c, t in df.dtypes if t == "string"]
    return df.withColumns(
        {c: F.when(~F.col(c).isin("NaN", "nan"), F.col(c)) for c in wanted}
    )


# Nested resources -----------------------------------------------------------------------------

IDENTIFIER_TYPES = "http://terminology.hl7.org/CodeSystem/v2-0203"


def _hash_reference(ref: Column, key: bytes) -> Column:
    """``Type/id`` keeps its type and hashes its id."""
    text = ref["reference"]
    kind = F.substring_index(text, "/", 1)
    hashed = F.concat(kind, F.lit("/"), hmac_sha256(F.substring_index(text, "/", -1), key))
    return F.when(ref.isNotNull(), ref.withField("reference", F.when(text.isNotNull(), hashed)))


def _hash_identifier(identifier: Column, key: bytes) -> Column:
    secret_kind = F.coalesce(
        F.exists(
            identifier["type"]["coding"],
            lambda c: (c["system"] == IDENTIFIER_TYPES) & c["code"].isin("MR", "VN"),
        ),
        F.lit(False),
    )
    return F.when(
        secret_kind, identifier.withField("value", hmac_sha256(identifier["value"], key))
    ).otherwise(identifier)


def pseudonymise_resources(df: DataFrame, key: bytes) -> DataFrame:
    """Hash ids, references and record numbers of typed resources; redact names.

    The columns to treat follow from the schema. Only projections, so it serves batch and stream.
    """
    new: dict[str, Column] = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if f.name == "id":
            new[f.name] = hmac_sha256(f.name, key)
        elif f.name == "name":
            new[f.name] = F.lit(None).cast(f.dataType)
        elif f.name == "identifier":
            new[f.name] = F.transform(f.name, lambda i: _hash_identifier(i, key))
        elif kind.startswith("struct<reference:"):
            new[f.name] = _hash_reference(F.col(f.name), key)
        elif kind.startswith("array<struct<reference:"):
            new[f.name] = F.transform(f.name, lambda r: _hash_reference(r, key))
    return df.withColumns(new)
