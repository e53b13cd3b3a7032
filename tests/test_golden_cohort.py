"""The prostate treatment question on hand-written bundles with known answers."""

import json

import pytest

from cohortloom import constants as K
from cohortloom.plans.treatment_question import treatment_question
from cohortloom.sources.resources import read_bundles

TYPES = ["Condition", "Observation", "MedicationStatement", "Medication", "Patient"]


def coding(system, code, display=None):
    return {"coding": [{"system": system, "code": code, "display": display}]}


def condition(i, asserted, recorded):
    return {
        "resourceType": "Condition",
        "id": f"c{i}",
        "meta": {"profile": [f"{K.PRIMARY_TUMOUR}|2025.0.1"]},
        "extension": [{"url": K.ASSERTED_DATE, "valueDateTime": asserted}],
        "code": {"coding": [{"system": "urn:other", "code": "x"}, {"system": K.ICD10, "code": "C61"}]},
        "subject": {"reference": f"Patient/p{i}"},
        "recordedDate": recorded,
    }


def staging(i, obs, code, value, date, display="cM category (observable entity)"):
    return {
        "resourceType": "Observation",
        "id": obs,
        "code": coding(K.SNOMED, code, display),
        "subject": {"reference": f"Patient/p{i}"},
        "focus": [{"reference": f"Condition/c{i}"}],
        "effectiveDateTime": date,
        "valueCodeableConcept": coding(K.UICC_TNM, value),
    }


def statement(i, ident, start, **medication):
    return {
        "resourceType": "MedicationStatement",
        "id": ident,
        "subject": {"reference": f"Patient/p{i}"},
        "reasonReference": [{"reference": f"Condition/c{i}"}],
        "effectivePeriod": {"start": start},
        **medication,
    }


RESOURCES = [
    {"resourceType": "Patient", "id": "p1"},
    condition(1, "2020-03-01", "2024-09-19"),
    condition(2, "2021-01-10", "2024-02-16"),
    condition(3, "2021-07-08", "2024-05-01"),
    staging(1, "o1", "399387003", "M0", "2020-03-01"),
    staging(1, "o1late", "399387003", "M1", "2022-03-01"),
    staging(2, "o2", "399534004", "N0", "2021-01-12"),
    staging(2, "o2undated", "399534004", "N1", None),
    staging(3, "o3", "371497001", "M1", "2021-07-01"),
    staging(3, "o3far", "371497001", "M0", "2023-07-01"),
    statement(
        1, "m1", "2020-05", medicationCodeableConcept={**coding(K.ATC_NATIONAL, "L02BB04"), "text": "Enzalutamid"}
    ),
    statement(2, "m2", "2021-02-01", medicationReference={"reference": "Medication/d2"}),
    statement(2, "m3", "2021-03-01", medicationCodeableConcept={"text": "Rituximab"}),
    {
        "resourceType": "Medication",
        "id": "d2",
        "code": {**coding(K.ATC_NATIONAL, "L02AE01"), "text": "Buserelin"},
    },
    statement(
        3, "m4", "2022-05", medicationCodeableConcept={**coding(K.ATC_NATIONAL, "L02BB04"), "text": "Enzalutamid"}
    ),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bundles")
    for n, part in enumerate((RESOURCES[:6], RESOURCES[6:])):
        bundle = {"resourceType": "Bundle", "entry": [{"fullUrl": f"urn:{i}", "resource": r} for i, r in enumerate(part)]}
        (folder / f"b{n}.json").write_text(json.dumps(bundle, indent=1))
    return treatment_question(read_bundles(spark, str(folder), TYPES))


def test_ranges(tables, rows):
    assert rows(tables["ranges"]) == [(3, "2020-03-01", "2021-07-08", "2024-02-16", "2024-09-19")]


def test_medication_counts(tables, rows):
    assert rows(tables["medication_counts"]) == [
        ("Buserelin", "L02AE01", 1),
        ("Enzalutamid", "L02BB04", 1),
        ("Rituximab", None, 1),
    ]


def test_funnel(tables):
    steps = {r["step"]: r["n"] for r in tables["funnel"].collect()}
    assert steps == {"all": 3, "early_stage": 2, "treated": 1, "before": 1, "after": 0}


def test_before_after(tables, rows):
    assert rows(tables["before_after"]) == [("L02BB04", 1, 0)]


def test_cohort_row(tables):
    (row,) = tables["cohort"].collect()
    assert list(row.asDict()) == [
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
    ]
    assert row["condition_id"] == "Condition/c1"
    assert row["effective_date_time_first"] == "2020-03-01"
    assert row["medication_start_date"] == "2020-05"
    assert row["display"] == "cM category (observable entity)"
