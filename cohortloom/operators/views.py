"""Flat tables out of nested resources.

``view`` filters resources before it projects them, so that profile and code tests run inside the
scan stage and only the nested fields a view needs are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import constants as K
from cohortloom.functions import codes as C
from cohortloom.functions import fhir as P


def view(
    df: DataFrame,
    select: Mapping[str, Column],
    where: Column | None = None,
    *,
    for_each: tuple[Column, str] | None = None,
    for_each_or_null: tuple[Column, str] | None = None,
) -> DataFrame:
    """Project named columns of the resources that satisfy ``where``.

    ``for_each`` gives one row per element of an array, bound to the given column name, and drops
    resources without elements; ``for_each_or_null`` keeps those with NULL.
    """
    rows = df if where is None else df.where(where)
    if for_each is not None:
        rows = rows.withColumn(for_each[1], F.explode(for_each[0]))
    if for_each_or_null is not None:
        rows = rows.withColumn(for_each_or_null[1], F.explode_outer(for_each_or_null[0]))
    return rows.select(*[c.alias(name) for name, c in select.items()])


# Shared paths -------------------------------------------------------------------------------


def _value(system: str, field: str = "code") -> Column:
    return P.coding_code("valueCodeableConcept", system, field)


def _subject() -> Column:
    return P.reference_key("subject")


def _focus() -> Column:
    return P.first_reference_key("focus")


def _snomed(*wanted: str) -> Column:
    return P.has_coding("code", K.SNOMED, wanted)


def _loinc(code: str) -> Column:
    return P.has_coding("code", K.LOINC, [code])


def _extension_code(url: str, system: str) -> Column:
    return P.coding_code(P.extension_value(url, "valueCodeableConcept"), system)


# Kinds of observations ----------------------------------------------------------------------
#
# Every observation view reads one kind. A lake written by ``sources.resources.write_lake`` is
# partitioned by kind, so a view over it opens only its own partition.


def observation_kinds() -> dict[str, Column]:
    """Which observations each view is about."""
    # The Karnofsky code counts under any system: "system and a, or b".
    karnofsky = F.coalesce(
        F.exists("code.coding", lambda c: c["code"] == K.KARNOFSKY_CODE), F.lit(False)
    )
    laboratory = F.coalesce(
        F.exists(
            "category",
            lambda k: F.exists(
                k["coding"],
                lambda c: (c["system"] == K.OBSERVATION_CATEGORY) & (c["code"] == "laboratory"),
            ),
        ),
        F.lit(False),
    )
    return {
        "death": _snomed(K.DEATH_CODE),
        "gleason": _snomed(K.GLEASON_CODE),
        "t": _snomed(*K.TNM_CODES["t"]),
        "n": _snomed(*K.TNM_CODES["n"]),
        "m": _snomed(*K.TNM_CODES["m"]),
        "uicc": _snomed(*K.TNM_CODES["uicc"]),
        "y": _loinc(K.Y_SYMBOL_LOINC),
        "metastasis": _snomed(K.METASTASIS_CODE),
        "progression": _snomed(K.PROGRESSION_CODE),
        "grading": _loinc(K.GRADING_LOINC),
        "classification": P.profile_is(K.OTHER_CLASSIFICATION),
        "performance": _snomed(K.ECOG_CODE) | karnofsky,
        "vital_status": _loinc(K.VITAL_STATUS_LOINC),
        "genetic_variant": _loinc(K.GENETIC_VARIANT_LOINC),
        "laboratory": laboratory,
        "uncoded": P.lacks_code("code"),
    }


KIND_COLUMN = "kind"


def observation_kind() -> Column:
    """The kind of an observation; ``several`` if it belongs to more than one, else ``other``."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in observation_kinds().items()]))
    return (
        F.when(F.size(hits) == 0, F.lit("other"))
        .when(F.size(hits) == 1, F.get(hits, F.lit(0)))
        .otherwise(F.lit("several"))
    )


def of_kind(observation: DataFrame, *kinds: str) -> DataFrame:
    """Observations of the given kinds, by partition where there is one and by test in any case."""
    tests = observation_kinds()
    rows = observation
    if KIND_COLUMN in observation.columns:
        rows = rows.where(F.col(KIND_COLUMN).isin(*kinds, "several"))
    return rows.where(reduce(lambda a, b: a | b, [tests[k] for k in kinds]))


# Patients and conditions --------------------------------------------------------------------


def patients(patient: DataFrame) -> DataFrame:
    return view(
        patient,
        {
            "patient_resource_id": P.resource_key("Patient"),
            "patid_pseudonym": P.identifier_value(),
            "birthdate": F.col("birthDate"),
            "gender": F.col("gender"),
            "deceased_datetime": F.col("deceasedDateTime"),
            "deceased_boolean": F.col("deceasedBoolean"),
        },
    )


def patient_mrns(patient: DataFrame, system: str) -> DataFrame:
    return view(
        patient,
        {
            "patient_resource_id": P.resource_key("Patient"),
            "patient_mrn": P.identifier_value(system),
        },
    )


def _condition_columns() -> dict[str, Column]:
    return {
        "condition_id": P.resource_key("Condition"),
        "meta_profile": P.first_profile(),
        "asserted_date": P.extension_value(K.ASSERTED_DATE, "valueDateTime"),
        "recorded_date": F.col("recordedDate"),
        "icd10_code": P.coding_code("code", K.ICD10),
        "condition_patient_resource_id": _subject(),
        "icdo3_morphology": P.first_code(P.extension_value(K.MORPHOLOGY, "valueCodeableConcept")),
        "icdo3_topography": P.list_coding_code("bodySite", K.ICDO3_TOPOGRAPHY),
    }


def conditions(condition: DataFrame, where: Column | None = None) -> DataFrame:
    return view(condition, _condition_columns(), where)


def primary_conditions(condition: DataFrame) -> DataFrame:
    """Conditions of the primary-tumour profile, tested before projection."""
    return conditions(condition, P.profile_is(K.PRIMARY_TUMOUR))


def prostate_conditions(condition: DataFrame, codes: Sequence[str] = (K.PROSTATE,)) -> DataFrame:
    return view(
        condition,
        {
            "condition_id": P.resource_key("Condition"),
            "patient_id": _subject(),
            "asserted_date": P.extension_value(K.ASSERTED_DATE, "valueDateTime"),
            "recorded_date": F.col("recordedDate"),
        },
        P.has_coding("code", K.ICD10, codes),
    )


def onset_conditions(condition: DataFrame) -> DataFrame:
    return view(
        condition,
        {
            "condition_id": P.resource_key("Condition"),
            "condition_patient_reference": _subject(),
            "icd_code": P.coding_code("code", K.ICD10),
            "diagnosis_onsetDateTime": F.col("onsetDateTime"),
            "diagnosis_recordedDate": F.col("recordedDate"),
        },
    )


def server_conditions(condition: DataFrame) -> DataFrame:
    """All conditions with encounter and verification status (from its own element)."""
    return view(
        condition,
        {
            "condition_id": F.col("id"),
            "all_condition_patient_reference": F.col("subject.reference"),
            "icd_code": P.coding_code("code", K.ICD10),
            "diagnosis_recordedDate": F.col("recordedDate"),
            "diagnosis_onsetDateTime": F.col("onsetDateTime"),
            "condition_encounter_reference": F.col("encounter.reference"),
            "condition_verificationStatus": P.coding_code("verificationStatus", K.VERIFICATION_STATUS),
        },
    )


# Observations -------------------------------------------------------------------------------


def deaths(observation: DataFrame, *, every_cause: bool = False) -> DataFrame:
    """Death observations; ``every_cause`` gives one row per coded cause."""
    cause = _value(K.ICD10)
    bound = None
    if every_cause:
        causes = F.filter("valueCodeableConcept.coding", lambda c: c["system"] == K.ICD10)
        bound, cause = (causes, "_cause"), F.col("_cause.code")
    return view(
        of_kind(observation, "death"),
        {
            "observation_resource_id": P.resource_key("Observation"),
            "death_cause_icd10": cause,
            "death_cause_tumor": P.list_coding_code("interpretation", K.DEATH_BY_TUMOUR),
            "date_death": F.col("effectiveDateTime"),
            "observation_death_patient_resource_id": _subject(),
        },
        for_each_or_null=bound,
    )


def gleason(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "gleason"),
        {
            "observation_gleason_resource_id": P.resource_key("Observation"),
            "observation_gleason_condition_resource_id": _focus(),
            "observation_gleason_patient_resource_id": _subject(),
            "gleason_sct": _value(K.SNOMED),
            "gleason_date": F.col("effectiveDateTime"),
        },
    )


def tnm_parent(observation: DataFrame) -> DataFrame:
    """Staging groups, one row per member observation."""
    return view(
        of_kind(observation, "uicc"),
        {
            "parent_tnm_observation_id": P.resource_key("Observation"),
            "parent_tnm_date": F.col("effectiveDateTime"),
            "has_member": P.reference_key("_member"),
        },
        for_each=(F.col("hasMember"), "_member"),
    )


def tnm_category(observation: DataFrame, dimension: str) -> DataFrame:
    """T, N or M categories with the clinical/pathological prefix."""
    prefix = P.first_code(P.extension_value(K.TNM_PREFIX, "valueCodeableConcept", "code.extension"))
    snomed = P.coding_code("code", K.SNOMED)
    d = dimension
    return view(
        of_kind(observation, d),
        {
            "observation_id": P.resource_key("Observation"),
            "condition_id": _focus(),
            f"{d}_tnm": _value(K.UICC_TNM),
            f"{d}_tnm_prefix": prefix,
            f"{d}_tnm_c_p_snomed_prefix": snomed,
            f"{d}_tnm_date": F.col("effectiveDateTime"),
            f"{d}_tnm_prefix_sct": C.lookup(K.TNM_CODES[d], snomed),
        },
    )


def tnm_t(observation: DataFrame) -> DataFrame:
    return tnm_category(observation, "t")


def tnm_n(observation: DataFrame) -> DataFrame:
    return tnm_category(observation, "n")


def tnm_m(observation: DataFrame) -> DataFrame:
    return tnm_category(observation, "m")


def tnm_uicc(observation: DataFrame) -> DataFrame:
    snomed = P.coding_code("code", K.SNOMED)
    return view(
        of_kind(observation, "uicc"),
        {
            "uicc_observation_id": P.resource_key("Observation"),
            "condition_id": _focus(),
            "uicc_tnm": _value(K.UICC_TNM),
            "uicc_tnm_c_p_snomed_prefix": snomed,
            "uicc_tnm_date": F.col("effectiveDateTime"),
            "uicc_tnm_prefix_sct": C.lookup(K.TNM_CODES["uicc"], snomed),
        },
    )


def tnm_y(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "y"),
        {
            "observation_id": P.resource_key("Observation"),
            "condition_id": _focus(),
            "y_tnm_421755005": _value(K.SNOMED),
            "y_tnm_date": F.col("effectiveDateTime"),
        },
    )


def tnm_nm_staging(observation: DataFrame) -> DataFrame:
    """Clinical and pathological N and M categories, one row per coding of the code."""
    wanted = [c for d in ("n", "m") for c, label in K.TNM_CODES[d].items() if label[0] in "cp"]
    return view(
        of_kind(observation, "n", "m"),
        {
            "observation_id": P.resource_key("Observation"),
            "patient_id": _subject(),
            "condition_id": _focus(),
            "effective_date_time": F.col("effectiveDateTime"),
            "code_coding_sct": P.coding_code("code", K.SNOMED),
            "tnm_value": _value(K.UICC_TNM),
            "code": F.col("_coding.code"),
            "display": F.col("_coding.display"),
        },
        _snomed(*wanted),
        for_each=(F.col("code.coding"), "_coding"),
    )


def metastases(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "metastasis"),
        {
            "observation_metastasis_resource_id": P.resource_key("Observation"),
            "condition_id": _focus(),
            "metastasis_loc": _value(K.METASTASIS_SITE),
            "metastasis_date": F.col("effectiveDateTime"),
        },
    )


def progressions(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "progression"),
        {
            "observation_id": P.resource_key("Observation"),
            "observation_patient_reference": _subject(),
            "effective_dateTime": F.col("effectiveDateTime"),
            "condition_id": _focus(),
            "overall_assessment_of_tumor_regression": _value(K.ASSESSMENT),
            "primary_tumor_status": P.component_code(K.SNOMED, K.PRIMARY_STATUS_CODE),
            "lymph_node_status": P.component_code(K.SNOMED, K.LYMPH_NODE_STATUS_CODE),
            "distant_metastasis_status": P.component_code(K.SNOMED, K.DISTANT_STATUS_CODE),
        },
    )


def gradings(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "grading"),
        {
            "observation_id": P.resource_key("Observation"),
            "condition_id": _focus(),
            "grading": _value(K.GRADING),
            "grading_date": F.col("effectiveDateTime"),
        },
    )


def other_classifications(observation: DataFrame) -> DataFrame:
    """Further classifications, one row per coding of the value."""
    return view(
        of_kind(observation, "classification"),
        {
            "weitere_klassifikation_name": F.col("code.text"),
            "meta_profile": P.first_profile(),
            "condition_id": _focus(),
            "weitere_klassifikation_value_text": F.col("valueCodeableConcept.text"),
            "weitere_klassifikation_date": F.col("effectiveDateTime"),
            "weitere_klassifikation_value_system": F.col("_coding.system"),
            "weitere_klassifikation_value_code": F.col("_coding.code"),
        },
        for_each=(F.col("valueCodeableConcept.coding"), "_coding"),
    )


def first_classifications(observation: DataFrame) -> DataFrame:
    """Further classifications with the first coding of the value only."""
    return view(
        of_kind(observation, "classification"),
        {
            "observation_id": P.resource_key("Observation"),
            "meta_profile": P.first_profile(),
            "focus_reference": _focus(),
            "weitere_klassifikation_code_text": F.col("code.text"),
            "weitere_klassifikation_code": P.first_code("valueCodeableConcept"),
            "weitere_klassifikation_date": F.col("effectiveDateTime"),
        },
    )


def patient_classifications(observation: DataFrame) -> DataFrame:
    """Further classifications with patient and condition, one row per coding of the value."""
    return view(
        of_kind(observation, "classification"),
        {
            "observation_id": P.resource_key("Observation"),
            "observation_patient_reference": _subject(),
            "observation_condition_reference": _focus(),
            "effective_dateTime": F.col("effectiveDateTime"),
            "code_text": F.col("code.text"),
            "value_text": F.col("valueCodeableConcept.text"),
            "value_system": F.col("_coding.system"),
            "value_code": F.col("_coding.code"),
        },
        for_each=(F.col("valueCodeableConcept.coding"), "_coding"),
    )


def performance_status(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "performance"),
        {
            "observation_id": P.resource_key("Observation"),
            "observation_patient_reference": _subject(),
            "effective_dateTime": F.col("effectiveDateTime"),
            "condition_id": _focus(),
            "ecog_performance_status": _value(K.ECOG),
            "karnofsky_performance_status": _value(K.KARNOFSKY),
        },
    )


def ecog_status(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "performance"),
        {
            "observation_id": P.resource_key("Observation"),
            "observation_patient_reference": _subject(),
            "effective_dateTime": F.col("effectiveDateTime"),
            "ecog_performance_status": _value(K.ECOG),
        },
        _snomed(K.ECOG_CODE),
    )


def vital_status(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "vital_status"),
        {
            "observation_id": P.resource_key("Observation"),
            "meta_profile": P.first_profile(),
            "observation_patient_reference": _subject(),
            "effective_dateTime": F.col("effectiveDateTime"),
            "vitalstatus_system": F.col("_coding.system"),
            "vitalstatus_code": F.col("_coding.code"),
        },
        for_each=(F.col("valueCodeableConcept.coding"), "_coding"),
    )


def genetic_variants(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "genetic_variant"),
        {
            "observation_id": P.resource_key("Observation"),
            "observation_patient_reference": _subject(),
            "observation_condition_reference": _focus(),
            "effective_dateTime": F.col("effectiveDateTime"),
            "genetic_variant_trait": P.list_coding_code("interpretation", K.VARIANT_TRAIT),
            "genetic_variant_name": P.first("note").getField("text"),
        },
    )


def labs(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "laboratory"),
        {
            "observation_id": F.col("id"),
            "observation_patient_reference": F.col("subject.reference"),
            "loinc_code": P.coding_code("code", K.LOINC),
            "loinc_display": P.coding_code("code", K.LOINC, "display"),
            "lab_dateTime": P.choice(
                "effectiveDateTime", "effectivePeriod.start", "effectiveInstant", "issued"
            ),
            "lab_quantity_value": F.col("valueQuantity.value"),
            "lab_quantity_unit": F.col("valueQuantity.code"),
            "lab_codeableconcept_code": _value(K.SNOMED),
        },
    )


def uncoded_observations(observation: DataFrame) -> DataFrame:
    return view(
        of_kind(observation, "uncoded"),
        {"name": F.col("code.text"), "stadium": P.first_code("valueCodeableConcept")},
    )



# Therapies ----------------------------------------------------------------------------------


def _therapy_columns(intention_url: str, relation_url: str) -> dict[str, Column]:
    return {
        "therapy_id": P.resource_key("Procedure"),
        "meta_profile": P.first_profile(),
        "reason_reference": P.first_reference_key("reasonReference"),
        "subject_reference": _subject(),
        "therapy_intention": _extension_code(intention_url, K.INTENTION),
        "stellung_op": _extension_code(relation_url, K.RELATION_TO_SURGERY),
        "therapy_end_reason": P.coding_code("outcome", K.THERAPY_END_REASON),
        "therapy_start_date": F.col("performedPeriod.start"),
        "therapy_end_date": F.col("performedPeriod.end"),
    }


def system_therapy_procedures(procedure: DataFrame) -> DataFrame:
    return view(
        procedure,
        {
            **_therapy_columns(K.SYSTEM_INTENTION, K.SYSTEM_RELATION),
            "therapy_type": P.coding_code("code", K.THERAPY_TYPE),
            "therapy_protocol_text": P.first("usedCode").getField("text"),
        },
        P.profile_is(K.SYSTEM_THERAPY),
    )


def _radiation(procedure: DataFrame, where: Column) -> DataFrame:
    return view(
        procedure,
        {
            **_therapy_columns(K.RADIO_INTENTION, K.RADIO_RELATION),
            "part_of_reference": P.first_reference_key("partOf"),
            "zielgebiet": P.list_coding_code("bodySite", K.TARGET_REGION),
        },
        where,
    )


def radiotherapies(procedure: DataFrame) -> DataFrame:
    """Radiotherapy courses; the profile is compared whole, so single irradiations stay out."""
    return _radiation(procedure, P.profile_exactly(K.RADIOTHERAPY))


def irradiations(procedure: DataFrame) -> DataFrame:
    return _radiation(procedure, P.profile_is(K.IRRADIATION))


def surgeries(procedure: DataFrame) -> DataFrame:
    return view(
        procedure,
        {
            "therapy_id": P.resource_key("Procedure"),
            "meta_profile": P.first_profile(),
            "reason_reference": P.first_reference_key("reasonReference"),
            "part_of_reference": P.first_reference_key("partOf"),
            "subject_reference": _subject(),
            "therapy_intention": _extension_code(K.SURGERY_INTENTION, K.INTENTION),
            "therapy_start_date": F.col("performedDateTime"),
            "surgery_outcome": P.coding_code("outcome", K.RESIDUAL_STATUS),
            "ops_code": P.coding_code("code", K.OPS),
        },
        P.has_coding("code", K.OPS) & P.profile_is(K.SURGERY),
    )


def ops_procedures(procedure: DataFrame) -> DataFrame:
    return view(
        procedure,
        {
            "procedure_id": P.resource_key("Procedure"),
            "procedure_patient_reference": _subject(),
            "procedure_condition_reference": P.first_reference_key("reasonReference"),
            "procedure_ops_code": P.coding_code("code", K.OPS),
            "procedure_ops_display": P.coding_code("code", K.OPS, "display"),
            "procedure_target_bodyregion": P.list_coding_code("bodySite", K.TARGET_REGION),
            "procedure_used_code_text": P.first("usedCode").getField("text"),
            "performed_period_start": F.col("performedPeriod.start"),
            "performed_period_end": F.col("performedPeriod.end"),
        },
        P.has_coding("code", K.OPS),
    )


def server_procedures(procedure: DataFrame) -> DataFrame:
    return view(
        procedure,
        {
            "procedure_id": F.col("id"),
            "procedure_patient_reference": F.col("subject.reference"),
            "procedure_ops_code": P.coding_code("code", K.OPS),
            "procedure_ops_version": P.coding_code("code", K.OPS, "version"),
            "timestamp": P.choice("performedDateTime", "performedPeriod.start"),
            "procedure_status": F.col("status"),
        },
    )


# Medication ---------------------------------------------------------------------------------


def medication_statements(statement: DataFrame) -> DataFrame:
    return view(
        statement,
        {
            "medication_statement_id": P.resource_key("MedicationStatement"),
            "part_of_reference": P.first_reference_key("partOf"),
            "subject_reference": _subject(),
            "reason_reference": P.first_reference_key("reasonReference"),
            "medication_statement_start_date": F.col("effectivePeriod.start"),
            "medication_statement_text": F.col("medicationCodeableConcept.text"),
            "medication_statement_atc_code": P.coding_code("medicationCodeableConcept", K.ATC_NATIONAL),
            "medication_reference": P.reference_key("medicationReference"),
        },
    )


def uncoded_medication_statements(statement: DataFrame) -> DataFrame:
    return view(
        statement,
        {"Substanzbezeichnung": F.col("medicationCodeableConcept.text")},
        P.lacks_code("medicationCodeableConcept", K.ATC_NATIONAL),
    )


def medications(medication: DataFrame) -> DataFrame:
    return view(
        medication,
        {
            "medication_id": P.resource_key("Medication"),
            "medication_medication_atc_code": P.coding_code("code", K.ATC_NATIONAL),
            "medication_medication_text": F.col("code.text"),
        },
    )


def medications_full(medication: DataFrame) -> DataFrame:
    ingredient_text = F.get(
        F.filter(
            F.transform(
                "ingredient",
                lambda i: F.coalesce(i["itemCodeableConcept"]["text"], i["itemReference"]["display"]),
            ),
            lambda t: t.isNotNull(),
        ),
        F.lit(0),
    )
    return view(
        medication,
        {
            "medication_id": F.col("id"),
            "medication_atc_code": P.coding_code_any("code", [K.ATC_WHO, K.ATC_NATIONAL]),
            "medication_code_text": F.col("code.text"),
            "medication_pzn_code": P.coding_code("code", K.PZN),
            "medication_pzn_display": P.coding_code("code", K.PZN, "display"),
            "medication_ops_code": P.coding_code("code", K.OPS),
            "medication_ops_version": P.coding_code("code", K.OPS, "version"),
            "medication_ingredient_text": ingredient_text,
            "ingredient": F.to_json("ingredient"),
        },
    )


def _event(kind: str, datetime: Column, end: Column, dosage: Column, intent: Column) -> dict[str, Column]:
    return {
        "type": F.lit(kind),
        "id": F.col("id"),
        "patient_reference": F.col("subject.reference"),
        "status": F.col("status"),
        "intent": intent,
        "medication_reference": F.col("medicationReference.reference"),
        "datetime": datetime,
        "period_end": end,
        "dosage": F.to_json(dosage),
        "medication_codeableconcept_code": P.coding_code_any(
            "medicationCodeableConcept", [K.ATC_WHO, K.ATC_NATIONAL]
        ),
    }


def request_events(request: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return view(
        request,
        _event("MedicationRequest", F.col("authoredOn"), none, F.col("dosageInstruction"), F.col("intent")),
    )


def _taken_events(df: DataFrame, kind: str) -> DataFrame:
    return view(
        df,
        _event(
            kind,
            P.choice("effectiveDateTime", "effectivePeriod.start"),
            F.col("effectivePeriod.end"),
            F.col("dosage"),
            F.lit(None).cast("string"),
        ),
    )


def statement_events(statement: DataFrame) -> DataFrame:
    return _taken_events(statement, "MedicationStatement")


def administration_events(administration: DataFrame) -> DataFrame:
    return _taken_events(administration, "MedicationAdministration")


def medication_events(
    request: DataFrame, statement: DataFrame, administration: DataFrame
) -> DataFrame:
    return (
        request_events(request)
        .unionByName(statement_events(statement))
        .unionByName(administration_events(administration))
    )


# Others -------------------------------------------------------------------------------------


def encounters(encounter: DataFrame) -> DataFrame:
    in_system = F.when(F.col("class.system") == K.ACT_CODE, F.col("class"))
    return view(
        encounter,
        {
            "encounter_id": F.col("id"),
            "encounter_patient_reference": F.col("subject.reference"),
            "status": F.col("status"),
            "enc_class_code": in_system["code"],
            "enc_class_display": in_system["display"],
            "enc_period_start": F.col("period.start"),
            "enc_period_end": F.col("period.end"),
        },
    )


def uncoded_adverse_events(event: DataFrame) -> DataFrame:
    return view(
        event, {"nebenwirkung_bezeichnung": F.col("event.text")}, P.lacks_code("event")
    )
