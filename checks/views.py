"""Views over nested resources against flat SQL (operators of group B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import shape as H
from checks.registry import query
from cohortloom import constants as K
from cohortloom.functions import fhir as P
from cohortloom.operators import views as V

Q, KIND = H.Q, H.OBS_KIND
OBS_KEY = f"concat('Observation/', {H.OBS_ID})"


def observation_sql(kind: str | int, columns: dict[str, str], extra: str = "") -> str:
    cols = ", ".join(f'{e} AS "{n}"' for n, e in columns.items())
    where = f"{KIND} = {kind}" if isinstance(kind, int) else kind
    return f"SELECT {cols} FROM lineitem {extra} WHERE {where}"


PATIENTS_SQL = f"""SELECT concat('Patient/', c_custkey) AS patient_resource_id, c_name AS patid_pseudonym,
    {H.BIRTHDATE_DUCK} AS birthdate, {H.GENDER} AS gender, {H.DECEASED_AT} AS deceased_datetime,
    cast({H.DECEASED} as varchar) AS deceased_boolean FROM customer"""
query("view_patients", PATIENTS_SQL)(lambda t: V.patients(H.patient(t)).withColumn("deceased_boolean", F.col("deceased_boolean").cast("string")))

query(
    "view_patient_mrns",
    "SELECT concat('Patient/', c_custkey) AS patient_resource_id, c_name AS patient_mrn FROM customer",
)(lambda t: V.patient_mrns(H.patient(t), "urn:mrn"))

CONDITION_SQL = f"""SELECT concat('Condition/', o_orderkey) AS condition_id,
    {H.PROFILE_OF_CONDITION} AS meta_profile, {H.ASSERTED} AS asserted_date,
    {H.RECORDED} AS recorded_date, {H.ICD} AS icd10_code,
    concat('Patient/', o_custkey) AS condition_patient_resource_id,
    {H.MORPHOLOGY} AS icdo3_morphology,
    {H.pick('o_orderkey', ['C61.9', 'C50.1', 'C18.0'])} AS icdo3_topography FROM orders"""

query("view_conditions", CONDITION_SQL)(lambda t: V.conditions(H.condition(t)))

query("view_primary_conditions", CONDITION_SQL + " WHERE o_orderkey % 4 <> 0")(
    lambda t: V.primary_conditions(H.condition(t))
)

query(
    "view_prostate_conditions",
    f"""SELECT concat('Condition/', o_orderkey) AS condition_id, concat('Patient/', o_custkey) AS patient_id,
        {H.ASSERTED} AS asserted_date, {H.RECORDED} AS recorded_date
        FROM orders WHERE o_orderkey % 97 = 61""",
)(lambda t: V.prostate_conditions(H.condition(t), H.PROSTATE_CODES))

query(
    "view_onset_conditions",
    f"""SELECT concat('Condition/', o_orderkey) AS condition_id,
        concat('Patient/', o_custkey) AS condition_patient_reference, {H.ICD} AS icd_code,
        {H.day('o_orderdate')} AS "diagnosis_onsetDateTime", {H.RECORDED} AS "diagnosis_recordedDate"
        FROM orders""",
)(lambda t: V.onset_conditions(H.condition(t)))

query(
    "view_server_conditions",
    f"""SELECT cast(o_orderkey as varchar) AS condition_id,
        concat('Patient/', o_custkey) AS all_condition_patient_reference, {H.ICD} AS icd_code,
        {H.RECORDED} AS "diagnosis_recordedDate", {H.day('o_orderdate')} AS "diagnosis_onsetDateTime",
        concat('Encounter/', o_orderkey % 100) AS condition_encounter_reference,
        {H.pick('o_orderkey', ['confirmed', 'provisional'])} AS "condition_verificationStatus" FROM orders""",
)(lambda t: V.server_conditions(H.condition(t)))

DEATHS_SQL = f"""
    SELECT {OBS_KEY} AS observation_resource_id, {H.CAUSE_1} AS death_cause_icd10,
        {H.pick(Q, ['J', 'N', 'U'])} AS death_cause_tumor, {H.OBS_DATE} AS date_death,
        {H.OBS_PATIENT} AS observation_death_patient_resource_id
    FROM lineitem WHERE {KIND} = 0"""

query("view_deaths", DEATHS_SQL)(lambda t: V.deaths(H.observation(t)))

DEATH_CAUSES_SQL = f"""{DEATHS_SQL} UNION ALL
    SELECT {OBS_KEY}, {H.CAUSE_2}, {H.pick(Q, ['J', 'N', 'U'])}, {H.OBS_DATE}, {H.OBS_PATIENT}
    FROM lineitem WHERE {KIND} = 0 AND {Q} % 4 = 0"""

query("view_death_causes", DEATH_CAUSES_SQL)(lambda t: V.deaths(H.observation(t), every_cause=True))

query(
    "view_gleason",
    observation_sql(
        1,
        {
            "observation_gleason_resource_id": OBS_KEY,
            "observation_gleason_condition_resource_id": H.OBS_CONDITION,
            "observation_gleason_patient_resource_id": H.OBS_PATIENT,
            "gleason_sct": H.pick(Q, H.GLEASON_CODES),
            "gleason_date": H.OBS_DATE,
        },
    ),
)(lambda t: V.gleason(H.observation(t)))

TNM_PARENT_SQL = " UNION ALL ".join(
    observation_sql(
        2,
        {
            "parent_tnm_observation_id": OBS_KEY,
            "parent_tnm_date": H.OBS_DATE,
            "has_member": f"concat('Observation/', l_orderkey, '-{m}')",
        },
    )
    for m in ("t", "n")
)
query("view_tnm_parent", TNM_PARENT_SQL)(lambda t: V.tnm_parent(H.observation(t)))


def _tnm_sql(d: str, kind: int) -> str:
    labels = list(K.TNM_CODES[d].values())
    return observation_sql(
        kind,
        {
            "observation_id": OBS_KEY,
            "condition_id": H.OBS_CONDITION,
            f"{d}_tnm": H.pick(Q, H.TNM_VALUES[d]),
            f"{d}_tnm_prefix": f"CASE WHEN {Q} % 2 = 0 THEN 'c' ELSE 'p' END",
            f"{d}_tnm_c_p_snomed_prefix": H.pick(Q, H.TNM_LISTS[d]),
            f"{d}_tnm_date": H.OBS_DATE,
            f"{d}_tnm_prefix_sct": H.pick(Q, labels),
        },
    )


TNM_T_SQL = _tnm_sql("t", 3)
query("view_tnm_t", TNM_T_SQL)(lambda t: V.tnm_t(H.observation(t)))
query("view_tnm_n", _tnm_sql("n", 4))(lambda t: V.tnm_n(H.observation(t)))
query("view_tnm_m", _tnm_sql("m", 5))(lambda t: V.tnm_m(H.observation(t)))

query(
    "view_tnm_uicc",
    observation_sql(
        2,
        {
            "uicc_observation_id": OBS_KEY,
            "condition_id": H.OBS_CONDITION,
            "uicc_tnm": H.pick(Q, H.TNM_VALUES["uicc"]),
            "uicc_tnm_c_p_snomed_prefix": H.pick(Q, H.TNM_LISTS["uicc"]),
            "uicc_tnm_date": H.OBS_DATE,
            "uicc_tnm_prefix_sct": H.pick(Q, list(K.TNM_CODES["uicc"].values())),
        },
    ),
)(lambda t: V.tnm_uicc(H.observation(t)))

query(
    "view_tnm_y",
    observation_sql(
        7,
        {
            "observation_id": OBS_KEY,
            "condition_id": H.OBS_CONDITION,
            "y_tnm_421755005": "'421755005'",
            "y_tnm_date": H.OBS_DATE,
        },
    ),
)(lambda t: V.tnm_y(H.observation(t)))


def _staging_sql(d: str, kind: int) -> str:
    code = H.pick(Q, H.TNM_LISTS[d])
    return observation_sql(
        f"{KIND} = {kind} AND {Q} % 3 <> 0",
        {
            "observation_id": OBS_KEY,
            "patient_id": H.OBS_PATIENT,
            "condition_id": H.OBS_CONDITION,
            "effective_date_time": H.OBS_DATE,
            "code_coding_sct": code,
            "tnm_value": H.pick(Q, H.TNM_VALUES[d]),
            "code": code,
            "display": f"'{d.upper()} category'",
        },
    )


STAGING_SQL = f"{_staging_sql('n', 4)} UNION ALL {_staging_sql('m', 5)}"
query("view_tnm_nm_staging", STAGING_SQL)(lambda t: V.tnm_nm_staging(H.observation(t)))

METASTASES_SQL = observation_sql(
    8,
    {
        "observation_metastasis_resource_id": OBS_KEY,
        "condition_id": H.OBS_CONDITION,
        "metastasis_loc": H.pick(Q, H.SITES),
        "metastasis_date": H.OBS_DATE,
    },
)
query("view_metastases", METASTASES_SQL)(lambda t: V.metastases(H.observation(t)))

query(
    "view_progressions",
    observation_sql(
        9,
        {
            "observation_id": OBS_KEY,
            "observation_patient_reference": H.OBS_PATIENT,
            "effective_dateTime": H.OBS_DATE,
            "condition_id": H.OBS_CONDITION,
            "overall_assessment_of_tumor_regression": H.pick(Q, ["V", "T", "K", "P", "D"]),
            "primary_tumor_status": H.pick(Q, ["K", "T"]),
            "lymph_node_status": H.pick(Q, ["R", "N", "U"]),
            "distant_metastasis_status": "'M'",
        },
    ),
)(lambda t: V.progressions(H.observation(t)))

GRADINGS_SQL = observation_sql(
    10,
    {
        "observation_id": OBS_KEY,
        "condition_id": H.OBS_CONDITION,
        "grading": H.pick(Q, ["1", "2", "3", "4"]),
        "grading_date": H.OBS_DATE,
    },
)
query("view_gradings", GRADINGS_SQL)(lambda t: V.gradings(H.observation(t)))


def _both_codings(columns: dict[str, str], system: str, code: str) -> str:
    arms = [("'urn:class'", H.pick(Q, H.CLASS_CODES)), ("'urn:alt'", H.pick(Q, ["a", "b"]))]
    return " UNION ALL ".join(
        observation_sql(11, {**columns, system: s, code: c}) for s, c in arms
    )


query(
    "view_other_classifications",
    _both_codings(
        {
            "weitere_klassifikation_name": H.pick(Q, H.CLASS_NAMES),
            "meta_profile": f"'{K.OTHER_CLASSIFICATION}|1.0'",
            "condition_id": H.OBS_CONDITION,
            "weitere_klassifikation_value_text": f"concat('value ', {Q})",
            "weitere_klassifikation_date": H.OBS_DATE,
        },
        "weitere_klassifikation_value_system",
        "weitere_klassifikation_value_code",
    ),
)(lambda t: V.other_classifications(H.observation(t)))

FIRST_CLASSIFICATIONS_SQL = observation_sql(
    11,
    {
        "observation_id": OBS_KEY,
        "meta_profile": f"'{K.OTHER_CLASSIFICATION}|1.0'",
        "focus_reference": H.OBS_CONDITION,
        "weitere_klassifikation_code_text": H.pick(Q, H.CLASS_NAMES),
        "weitere_klassifikation_code": H.pick(Q, H.CLASS_CODES),
        "weitere_klassifikation_date": H.OBS_DATE,
    },
)
query("view_first_classifications", FIRST_CLASSIFICATIONS_SQL)(lambda t: V.first_classifications(H.observation(t)))

query(
    "view_patient_classifications",
    _both_codings(
        {
            "observation_id": OBS_KEY,
            "observation_patient_reference": H.OBS_PATIENT,
            "observation_condition_reference": H.OBS_CONDITION,
            "effective_dateTime": H.OBS_DATE,
            "code_text": H.pick(Q, H.CLASS_NAMES),
            "value_text": f"concat('value ', {Q})",
        },
        "value_system",
        "value_code",
    ),
)(lambda t: V.patient_classifications(H.observation(t)))

query(
    "view_performance_status",
    observation_sql(
        12,
        {
            "observation_id": OBS_KEY,
            "observation_patient_reference": H.OBS_PATIENT,
            "effective_dateTime": H.OBS_DATE,
            "condition_id": H.OBS_CONDITION,
            "ecog_performance_status": f"CASE WHEN {Q} % 2 = 0 THEN {H.pick(Q, ['0', '1', '2', '3', '4'])} END",
            "karnofsky_performance_status": f"CASE WHEN {Q} % 2 = 1 THEN {H.pick(Q, ['90%', '80%'])} END",
        },
    ),
)(lambda t: V.performance_status(H.observation(t)))

ECOG_SQL = observation_sql(
    f"{KIND} = 12 AND {Q} % 2 = 0",
    {
        "observation_id": OBS_KEY,
        "observation_patient_reference": H.OBS_PATIENT,
        "effective_dateTime": H.OBS_DATE,
        "ecog_performance_status": H.pick(Q, ["0", "1", "2", "3", "4"]),
    },
)
query("view_ecog_status", ECOG_SQL)(lambda t: V.ecog_status(H.observation(t)))

VITAL_SQL = observation_sql(
    f"{KIND} = 13 AND {Q} % 7 <> 0",
    {
        "observation_id": OBS_KEY,
        "meta_profile": "'https://example.org/observation'",
        "observation_patient_reference": H.OBS_PATIENT,
        "effective_dateTime": H.OBS_DATE,
        "vitalstatus_system": "'urn:vital'",
        "vitalstatus_code": H.pick(Q, ["L", "T"]),
    },
)
query("view_vital_status", VITAL_SQL)(lambda t: V.vital_status(H.observation(t)))

query(
    "view_genetic_variants",
    observation_sql(
        14,
        {
            "observation_id": OBS_KEY,
            "observation_patient_reference": H.OBS_PATIENT,
            "observation_condition_reference": H.OBS_CONDITION,
            "effective_dateTime": H.OBS_DATE,
            "genetic_variant_trait": H.pick(Q, ["POS", "NEG"]),
            "genetic_variant_name": H.pick(Q, ["NPM1", "FLT3", "TP53"]),
        },
    ),
)(lambda t: V.genetic_variants(H.observation(t)))

LABS_SQL = observation_sql(
        15,
        {
            "observation_id": H.OBS_ID,
            "observation_patient_reference": f"CASE WHEN {Q} % 5 = 0 THEN concat('http://server/fhir/', {H.OBS_PATIENT}, '/_history/3') ELSE {H.OBS_PATIENT} END",
            "loinc_code": H.pick(Q, H.LAB_CODES),
            "loinc_display": f"concat('lab ', {Q} % 8)",
            "lab_dateTime": H.day("l_shipdate"),
            "lab_quantity_value": "l_quantity * 1.5",
            "lab_quantity_unit": H.pick(Q, H.LAB_UNITS),
            "lab_codeableconcept_code": f"CASE WHEN {Q} % 9 = 0 THEN '260385009' END",
        },
)
query("view_labs", LABS_SQL)(lambda t: V.labs(H.observation(t)))

query(
    "view_uncoded_observations",
    observation_sql(6, {"name": f"concat('class ', {Q} % 7)", "stadium": H.pick(Q, ["I", "II"])}),
)(lambda t: V.uncoded_observations(H.observation(t)))

_PARENT = {
    "reason_reference": "concat('Condition/', o_orderkey)",
    "subject_reference": "concat('Patient/', o_custkey)",
    "therapy_intention": H.pick("o_orderkey", H.INTENTIONS),
    "stellung_op": H.pick("o_orderkey", H.RELATIONS),
    "therapy_end_reason": H.pick("o_orderkey", H.END_REASONS),
    "therapy_start_date": f"CASE WHEN o_orderkey % 6 <> 0 THEN {H.day('o_orderdate')} END",
    "therapy_end_date": "cast(null as varchar)",
}


def select(columns: dict[str, str], table: str, where: str = "true") -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {table} WHERE {where}"


SYSTEM_SQL = select(
    {
        "therapy_id": f"concat('Procedure/', {H.SYSTEM_ID})",
        "meta_profile": f"'{K.SYSTEM_THERAPY}|1.0'",
        **_PARENT,
        "therapy_type": H.pick("o_orderkey", H.THERAPY_TYPES),
        "therapy_protocol_text": "concat('protocol ', o_orderkey % 9)",
    },
    "orders",
    "o_orderkey % 2 = 0",
)
query("view_system_therapy_procedures", SYSTEM_SQL)(lambda t: V.system_therapy_procedures(H.procedure(t)))

RADIO_SQL = select(
    {
        "therapy_id": f"concat('Procedure/', {H.RADIO_ID})",
        "meta_profile": f"'{K.RADIOTHERAPY}|1.0'",
        **_PARENT,
        "part_of_reference": "cast(null as varchar)",
        "zielgebiet": "cast(null as varchar)",
    },
    "orders",
    "o_orderkey % 2 = 1",
)
query("view_radiotherapies", RADIO_SQL)(lambda t: V.radiotherapies(H.procedure(t)))

_NULL = "cast(null as varchar)"
IRRADIATION_SQL = select(
    {
        "therapy_id": f"concat('Procedure/', {H.OBS_ID})",
        "meta_profile": f"'{K.IRRADIATION}|1.0'",
        "reason_reference": "concat('Condition/', l_orderkey)",
        "subject_reference": H.OBS_PATIENT,
        "therapy_intention": _NULL,
        "stellung_op": _NULL,
        "therapy_end_reason": _NULL,
        "therapy_start_date": H.day("l_shipdate"),
        "therapy_end_date": _NULL,
        "part_of_reference": "concat('Procedure/R-', l_orderkey)",
        "zielgebiet": H.pick(Q, H.REGIONS),
    },
    "lineitem",
    "l_suppkey % 2 = 1",
)
query("view_irradiations", IRRADIATION_SQL)(lambda t: V.irradiations(H.procedure(t)))

SURGERY_SQL = select(
    {
        "therapy_id": f"concat('Procedure/', {H.OBS_ID})",
        "meta_profile": f"'{K.SURGERY}|1.0'",
        "reason_reference": "concat('Condition/', l_orderkey)",
        "part_of_reference": _NULL,
        "subject_reference": H.OBS_PATIENT,
        "therapy_intention": H.pick(Q, H.INTENTIONS),
        "therapy_start_date": H.day("l_shipdate"),
        "surgery_outcome": H.pick(Q, ["R0", "R1", "RX"]),
        "ops_code": H.pick("l_partkey", H.OPS_CODES),
    },
    "lineitem",
    "l_suppkey % 2 = 0",
)
query("view_surgeries", SURGERY_SQL)(lambda t: V.surgeries(H.procedure(t)))

OPS_SQL = select(
    {
        "procedure_id": f"concat('Procedure/', {H.OBS_ID})",
        "procedure_patient_reference": H.OBS_PATIENT,
        "procedure_condition_reference": "concat('Condition/', l_orderkey)",
        "procedure_ops_code": H.pick("l_partkey", H.OPS_CODES),
        "procedure_ops_display": f"concat('ops ', {Q} % 3)",
        "procedure_target_bodyregion": _NULL,
        "procedure_used_code_text": _NULL,
        "performed_period_start": _NULL,
        "performed_period_end": _NULL,
    },
    "lineitem",
    "l_suppkey % 2 = 0",
)
query("view_ops_procedures", OPS_SQL)(lambda t: V.ops_procedures(H.procedure(t)))


def _server_procedure_sql() -> str:
    parts = [
        select(
            {
                "procedure_id": ident,
                "procedure_patient_reference": "concat('Patient/', o_custkey)",
                "procedure_ops_code": _NULL,
                "procedure_ops_version": _NULL,
                "timestamp": _PARENT["therapy_start_date"],
                "procedure_status": "'completed'",
            },
            "orders",
            f"o_orderkey % 2 = {even}",
        )
        for ident, even in ((H.SYSTEM_ID, 0), (H.RADIO_ID, 1))
    ]
    parts.append(
        select(
            {
                "procedure_id": H.OBS_ID,
                "procedure_patient_reference": H.OBS_PATIENT,
                "procedure_ops_code": f"CASE WHEN l_suppkey % 2 = 0 THEN {H.pick('l_partkey', H.OPS_CODES)} END",
                "procedure_ops_version": "CASE WHEN l_suppkey % 2 = 0 THEN '2024' END",
                "timestamp": H.day("l_shipdate"),
                "procedure_status": "'completed'",
            },
            "lineitem",
        )
    )
    return " UNION ALL ".join(parts)


SERVER_PROCEDURE_SQL = _server_procedure_sql()
query("view_server_procedures", SERVER_PROCEDURE_SQL)(lambda t: V.server_procedures(H.procedure(t)))

STATEMENT_SQL = select(
    {
        "medication_statement_id": f"concat('MedicationStatement/', {H.OBS_ID})",
        "part_of_reference": "concat('Procedure/S-', l_orderkey)",
        "subject_reference": H.OBS_PATIENT,
        "reason_reference": "concat('Condition/', l_orderkey)",
        "medication_statement_start_date": H.partial("l_shipdate", "l_orderkey"),
        "medication_statement_text": f"CASE WHEN {H.INLINE} THEN concat('drug ', l_partkey % 5) END",
        "medication_statement_atc_code": f"CASE WHEN {H.INLINE} THEN {H.pick('l_partkey', H.ATC_CODES)} END",
        "medication_reference": f"CASE WHEN NOT ({H.INLINE}) THEN concat('Medication/', l_partkey) END",
    },
    "lineitem",
)
query("view_medication_statements", STATEMENT_SQL)(
    lambda t: V.medication_statements(H.medication_statement(t))
)

query(
    "view_uncoded_medication_statements",
    f'SELECT cast(null as varchar) AS "Substanzbezeichnung" FROM lineitem WHERE NOT ({H.INLINE})',
)(lambda t: V.uncoded_medication_statements(H.medication_statement(t)))

MEDICATION_SQL = select(
    {
        "medication_id": "concat('Medication/', p_partkey)",
        "medication_medication_atc_code": f"CASE WHEN p_partkey % 2 = 1 THEN {H.PART_ATC} END",
        "medication_medication_text": "p_name",
    },
    "part",
)
query("view_medications", MEDICATION_SQL)(lambda t: V.medications(H.medication(t)))

query(
    "view_medications_full",
    select(
        {
            "medication_id": "cast(p_partkey as varchar)",
            "medication_atc_code": H.PART_ATC,
            "medication_code_text": "p_name",
            "medication_pzn_code": "cast(p_size as varchar)",
            "medication_pzn_display": "p_brand",
            "medication_ops_code": _NULL,
            "medication_ops_version": _NULL,
            "medication_ingredient_text": "p_type",
            "ingredient": """concat('[{"itemCodeableConcept":{"coding":[{}],"text":"', p_type, '"}}]')""",
        },
        "part",
    ),
)(lambda t: V.medications_full(H.medication(t)))

_TIME = "substr(cast(ts as string), 1, 19)"


def _event_sql(kind: str, values: dict[str, str]) -> str:
    base = {
        "type": f"'{kind}'",
        "id": "cast(event_id as varchar)",
        "patient_reference": "concat('Patient/', user_id)",
        "status": "'completed'",
        "intent": _NULL,
        "medication_reference": _NULL,
        "datetime": _TIME,
        "period_end": _NULL,
        "dosage": _NULL,
        "medication_codeableconcept_code": _NULL,
    }
    return select({**base, **values}, "events")


REQUEST_SQL = _event_sql(
    "MedicationRequest",
    {
        "status": "'active'",
        "intent": H.pick("event_id", ["order", "plan"]),
        "dosage": """concat('[{"text":"', event_type, '"}]')""",
        "medication_codeableconcept_code": H.pick("event_id", H.ATC_CODES),
    },
)
ADMINISTRATION_SQL = _event_sql(
    "MedicationAdministration",
    {
        "period_end": f"CASE WHEN event_id % 2 = 1 THEN {_TIME} END",
        "dosage": """concat('{"text":"', event_type, '"}')""",
        "medication_reference": "concat('Medication/', event_id % 50)",
    },
)
STATEMENT_EVENT_SQL = select(
    {
        "type": "'MedicationStatement'",
        "id": H.OBS_ID,
        "patient_reference": H.OBS_PATIENT,
        "status": "'active'",
        "intent": _NULL,
        "medication_reference": f"CASE WHEN NOT ({H.INLINE}) THEN concat('Medication/', l_partkey) END",
        "datetime": H.partial("l_shipdate", "l_orderkey"),
        "period_end": H.day("l_shipdate"),
        "dosage": f"""concat('[{{"text":"', {Q}, ' mg"}}]')""",
        "medication_codeableconcept_code": f"CASE WHEN {H.INLINE} THEN {H.pick('l_partkey', H.ATC_CODES)} END",
    },
    "lineitem",
)
query(
    "view_medication_events",
    " UNION ALL ".join([REQUEST_SQL, STATEMENT_EVENT_SQL, ADMINISTRATION_SQL]),
)(
    lambda t: V.medication_events(
        H.medication_request(t), H.medication_statement(t), H.medication_administration(t)
    )
)

query(
    "view_encounters",
    select(
        {
            "encounter_id": "cast(event_id as varchar)",
            "encounter_patient_reference": "concat('Patient/', user_id)",
            "status": "'finished'",
            "enc_class_code": f"CASE WHEN event_id % 4 <> 0 THEN {H.pick('event_id', ['IMP', 'AMB'])} END",
            "enc_class_display": f"CASE WHEN event_id % 4 <> 0 THEN {H.pick('event_id', ['inpatient', 'ambulatory'])} END",
            "enc_period_start": _TIME,
            "enc_period_end": f"CASE WHEN event_id % 3 = 0 THEN {_TIME} END",
        },
        "events",
    ),
)(lambda t: V.encounters(H.encounter(t)))

query(
    "view_uncoded_adverse_events",
    "SELECT event_type AS nebenwirkung_bezeichnung FROM events WHERE event_id % 3 <> 0",
)(lambda t: V.uncoded_adverse_events(H.adverse_event(t)))

# Column builders without a named view -----------------------------------------------------------

query(
    "fhir_profile_exact_and_prefix",
    f"""SELECT concat('Procedure/', {H.RADIO_ID}) AS id, true AS exact, true AS prefix FROM orders WHERE o_orderkey % 2 = 1
        UNION ALL SELECT concat('Procedure/', {H.OBS_ID}), false, true FROM lineitem WHERE l_suppkey % 2 = 1""",
)(
    lambda t: V.view(
        H.procedure(t),
        {
            "id": P.resource_key("Procedure"),
            "exact": P.profile_exactly(K.RADIOTHERAPY),
            "prefix": P.profile_is(K.RADIOTHERAPY),
        },
        P.profile_is(K.RADIOTHERAPY),
    )
)

query(
    "fhir_for_each_or_null",
    f"""SELECT {OBS_KEY} AS id, CASE WHEN {KIND} = 9 THEN code END AS component
        FROM lineitem, (VALUES ('{K.PRIMARY_STATUS_CODE}', 1), ('{K.LYMPH_NODE_STATUS_CODE}', 2), ('{K.DISTANT_STATUS_CODE}', 3)) c(code, n)
        WHERE {KIND} = 9 OR n = 1""",
)(
    lambda t: V.view(
        H.observation(t),
        {"id": P.resource_key("Observation"), "component": P.first_code("_c.code")},
        for_each_or_null=(F.col("component"), "_c"),
    )
)

query(
    "observation_kinds",
    f"""SELECT CASE {KIND} WHEN 0 THEN 'death' WHEN 1 THEN 'gleason' WHEN 2 THEN 'uicc' WHEN 3 THEN 't' WHEN 4 THEN 'n' WHEN 5 THEN 'm' WHEN 6 THEN 'uncoded' WHEN 7 THEN 'y'
        WHEN 8 THEN 'metastasis' WHEN 9 THEN 'progression' WHEN 10 THEN 'grading' WHEN 11 THEN 'classification' WHEN 12 THEN 'performance' WHEN 13 THEN 'vital_status'
        WHEN 14 THEN 'genetic_variant' ELSE 'laboratory' END AS kind, count(*) AS n FROM lineitem GROUP BY 1""",
)(
    lambda t: H.observation(t).groupBy(V.observation_kind().alias("kind")).agg(F.count(F.lit(1)).alias("n"))
)
