"""Declared types of the health-record resources the views read (dates stay text)."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

_CODING = "struct<system:string,version:string,code:string,display:string>"
_CONCEPT = f"struct<coding:array<{_CODING}>,text:string>"
_REF = "struct<reference:string,display:string>"
_PERIOD = "struct<start:string,end:string>"
_IDENT = f"struct<type:{_CONCEPT},system:string,value:string>"
_EXT = f"struct<url:string,valueDateTime:string,valueCodeableConcept:{_CONCEPT}>"
_META = "struct<profile:array<string>,lastUpdated:string>"
_QUANTITY = "struct<value:double,unit:string,code:string>"
_NAME = "struct<family:string,given:array<string>>"

TYPE_ALIASES = {
    "Coding": _CODING,
    "CodeableConcept": _CONCEPT,
    "Reference": _REF,
    "Period": _PERIOD,
    "Identifier": _IDENT,
    "Extension": _EXT,
    "Meta": _META,
    "Quantity": _QUANTITY,
}

_FIELDS = {
    "Patient": f"id string, meta {_META}, identifier array<{_IDENT}>, name array<{_NAME}>, "
    "birthDate string, gender string, deceasedDateTime string, deceasedBoolean boolean",
    "Condition": f"id string, meta {_META}, extension array<{_EXT}>, code {_CONCEPT}, "
    f"bodySite array<{_CONCEPT}>, subject {_REF}, recordedDate string, onsetDateTime string, "
    f"encounter {_REF}, verificationStatus {_CONCEPT}",
    "Observation": f"id string, meta {_META}, category array<{_CONCEPT}>, "
    f"code struct<coding:array<{_CODING}>,text:string,extension:array<{_EXT}>>, "
    f"subject {_REF}, focus array<{_REF}>, hasMember array<{_REF}>, effectiveDateTime string, "
    f"effectivePeriod {_PERIOD}, effectiveInstant string, issued string, "
    f"valueCodeableConcept {_CONCEPT}, valueQuantity {_QUANTITY}, "
    f"interpretation array<{_CONCEPT}>, note array<struct<text:string>>, "
    f"component array<struct<code:{_CONCEPT},valueCodeableConcept:{_CONCEPT}>>",
    "Procedure": f"id string, meta {_META}, status string, extension array<{_EXT}>, code {_CONCEPT}, "
    f"subject {_REF}, partOf array<{_REF}>, reasonReference array<{_REF}>, "
    f"performedDateTime string, performedPeriod {_PERIOD}, outcome {_CONCEPT}, "
    f"bodySite array<{_CONCEPT}>, usedCode array<{_CONCEPT}>",
    "MedicationStatement": f"id string, meta {_META}, status string, subject {_REF}, "
    f"partOf array<{_REF}>, reasonReference array<{_REF}>, effectiveDateTime string, "
    f"effectivePeriod {_PERIOD}, medicationCodeableConcept {_CONCEPT}, "
    f"medicationReference {_REF}, dosage array<struct<text:string>>",
    "Medication": f"id string, code {_CONCEPT}, "
    f"ingredient array<struct<itemCodeableConcept:{_CONCEPT},itemReference:{_REF}>>",
    "AdverseEvent": f"id string, event {_CONCEPT}",
    "Encounter": f"id string, status string, class {_CODING}, subject {_REF}, period {_PERIOD}",
    "MedicationRequest": f"id string, status string, intent string, subject {_REF}, "
    f"authoredOn string, dosageInstruction array<struct<text:string>>, "
    f"medicationReference {_REF}, medicationCodeableConcept {_CONCEPT}",
    "MedicationAdministration": f"id string, status string, subject {_REF}, "
    f"effectiveDateTime string, effectivePeriod {_PERIOD}, "
    f"dosage struct<text:string>, medicationReference {_REF}, "
    f"medicationCodeableConcept {_CONCEPT}",
}

RESOURCE_TYPES = tuple(_FIELDS)


def ddl(resource_type: str) -> str:
    """Column list of a resource type as DDL text."""
    return _FIELDS[resource_type]


def schema_of(resource_type: str) -> StructType:
    return _parse_datatype_string(_FIELDS[resource_type])
