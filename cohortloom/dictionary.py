"""What the columns of the exported tables mean; see ``sources.sinks.data_dictionary``."""

_PERSON = {
    "patient_mrn": "Record number of the patient; a keyed hash in de-identified tables",
    "patient_id": "Reference to the patient, Patient/<id>",
}
_SEEN = {"effective_dateTime": "When the finding was made; shifted in de-identified tables"}
_OBSERVATION = {"observation_id": "Reference to the observation", **_PERSON, **_SEEN}

TABLES = {
    "patients": {
        "condition_id": "Reference to the diagnosis",
        "condition_patient_reference": "Reference to the patient of the diagnosis",
        "icd_code": "Diagnosis as ICD-10-GM code",
        "diagnosis_recordedDate": "When the diagnosis was entered",
        "diagnosis_onsetDateTime": "When the disease began",
        "deceased_boolean": "Death flag of the hospital system",
        "deceased_dateTime": "Time of death after all sources were weighed",
        "deceased": "Whether any source reports death",
        "birth_date": "Date of birth; only its year in de-identified tables",
        "gender": "Administrative gender",
        "death_caused_by_tumor": "Registry: death by tumour, J yes, N no, U unknown",
        "cause_of_death": "Registry: cause of death as ICD-10 code",
        "last_follow_up_datetime": "Latest time the registry saw the patient alive",
        "patient_mrn": _PERSON["patient_mrn"],
    },
    "labs": {
        "observation_id": "Id of the laboratory observation",
        "observation_patient_reference": "Reference to the patient",
        "loinc_code": "Measured quantity as LOINC code",
        "loinc_display": "Name of the measured quantity",
        "lab_dateTime": "Time of the sample, else of the report",
        "lab_quantity_value": "Numeric result",
        "lab_quantity_unit": "Unit of the numeric result",
        "lab_codeableconcept_code": "Coded result where there is no number",
    },
    "encounters": {
        "encounter_id": "Id of the stay or visit",
        "encounter_patient_reference": "Reference to the patient",
        "status": "State of the encounter",
        "enc_class_code": "Kind of encounter as code",
        "enc_class_display": "Kind of encounter in words",
        "enc_period_start": "Begin",
        "enc_period_end": "End",
    },
    "medications": {
        "medication_id": "Id of the medication",
        "medication_atc_code": "Substance as ATC code, national or WHO",
        "medication_atc_display": "Name of the ATC code",
        "medication_pzn_code": "Product number",
        "medication_pzn_display": "Product name",
        "medication_ops_code": "Procedure code that stands for the medication",
        "medication_display": "Best name available",
        "ingredient": "Ingredients as JSON",
    },
    "medication_events": {
        "type": "Request, statement or administration",
        "id": "Id of the event",
        "patient_reference": "Reference to the patient",
        "status": "State of the event",
        "intent": "Order or plan, requests only",
        "medication_reference": "Id of the medication",
        "datetime": "Begin",
        "period_end": "End",
        "dosage": "Dosage as JSON",
    },
    "deaths": {
        "observation_id": "Reference to the death report; one row per cause",
        "patient_id": _PERSON["patient_id"],
        "death_dateTime": "Reported date of death",
        "cause_of_death": "Cause as ICD-10 code",
        "death_caused_by_tumor": "Death by tumour, J yes, N no, U unknown",
    },
    "vital_status": {
        **_OBSERVATION,
        "vitalstatus_system": "Code system of the status",
        "vitalstatus_code": "L alive, T dead",
    },
    "ecog": {**_OBSERVATION, "ecog_performance_status": "Performance status, 0 to 4"},
    "progressions": {
        **_OBSERVATION,
        "overall_assessment_of_tumor_regression": "Course of the disease as a whole",
        "primary_tumor_status": "State of the primary tumour",
        "lymph_node_status": "State of the lymph nodes",
        "distant_metastasis_status": "State of distant metastases",
    },
    "classifications": {
        **_OBSERVATION,
        "code_text": "Name of the classification",
        "value_text": "Its value in words",
        "value_system": "Code system of the value",
        "value_code": "Its value as code",
    },
    "tumour_procedures": {
        "procedure_id": "Reference to the procedure",
        "procedure_ops_code": "Procedure code",
        "procedure_ops_display": "Name of the procedure code",
        "procedure_target_bodyregion": "Body region treated",
        "procedure_used_code_text": "Material used, in words",
        "performed_period_start": "Begin",
        "performed_period_end": "End",
    },
    "system_therapies": {
        "medication_statement_id": "Reference to the drug statement",
        "medication_start_date": "First day of the drug",
        "medication_text": "Name of the drug",
        "medication_atc_code": "Substance as ATC code",
    },
}
