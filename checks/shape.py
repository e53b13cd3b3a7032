"""Resources shaped from the given tables.

The fragments in capitals are SQL that Spark and the checking engine both understand, so a view and
its plain SQL are built from the same definitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from checks.registry import Tables
from cohortloom import constants as K
from cohortloom.functions.codes import GLEASON_SCORES
from cohortloom.schemas import TYPE_ALIASES, schema_of


def pick(expr: str, values) -> str:
    """CASE over 0, 1, 2, ..."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({expr}) % {len(values)} {arms} END"


def partial(date: str, by: str) -> str:
    """Date text of day, month or year precision."""
    text = f"substr(cast({date} as string), 1, 10)"
    return f"CASE ({by}) % 3 WHEN 0 THEN {text} WHEN 1 THEN substr({text}, 1, 7) ELSE substr({text}, 1, 4) END"


def day(date: str) -> str:
    return f"substr(cast({date} as string), 1, 10)"


# Line items
Q = "cast(l_quantity as int)"
OBS_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
OBS_KIND = "l_partkey % 16"
OBS_PATIENT = "concat('Patient/', cast(cast(floor(l_orderkey / 10) as bigint) as string))"
OBS_CONDITION = f"CASE WHEN {Q} % 11 <> 0 THEN concat('Condition/', cast(l_orderkey as string)) END"
OBS_DATE = f"CASE WHEN {Q} % 13 <> 0 THEN {partial('l_shipdate', 'l_orderkey')} END"
SITES = ["OSS", "PUL", "HEP", "LYM", "BRA", "OTH"]
GLEASON_CODES = list(GLEASON_SCORES)
TNM_LISTS = {d: list(codes) for d, codes in K.TNM_CODES.items()}
TNM_VALUES = {
    "t": ["T1", "T2", "T3", "T4"],
    "n": ["N0", "N1", "NX"],
    "m": ["M0", "M1", "M0"],
    "uicc": ["I", "II", "III", "IV"],
}
CAUSE_1 = "concat('C', lpad(cast(l_suppkey % 97 as string), 2, '0'))"
CAUSE_2 = "concat('I', lpad(cast(l_suppkey % 89 as string), 2, '0'))"
LAB_CODES = ["26464-8", "777-3", "718-7", "709-6", "51629-4", "33990-3", "26033-1", "11113-8"]
LAB_UNITS = ["10*9/L", "g/dL"]
CLASS_NAMES = ["ELN 2022", "WHO-Klassifikation", "Binet"]
CLASS_CODES = ["IV", "4", "II"]

# Orders
ICD = "concat('C', lpad(cast(o_orderkey % 97 as string), 2, '0'), '.', cast(o_orderkey % 10 as string))"
PROSTATE_CODES = [f"C61.{i}" for i in range(10)]
ASSERTED = f"CASE WHEN o_orderkey % 17 <> 0 THEN {partial('o_orderdate', 'o_orderkey')} END"
RECORDED = f"concat({day('o_orderdate')}, 'T10:00:00+01:00')"
PROFILE_OF_CONDITION = (
    f"CASE WHEN o_orderkey % 4 <> 0 THEN '{K.PRIMARY_TUMOUR}|2025.0.1' ELSE 'https://example.org/earlier' END"
)
MORPHOLOGY = "CASE WHEN o_orderkey % 2 = 0 THEN '8140/3' END"
INTENTIONS = ["K", "P", "O"]
RELATIONS = ["A", "N", "O", "S"]
END_REASONS = ["E", "V", "P", "U"]
THERAPY_TYPES = ["CH", "HO", "IM", "ZS"]
REGIONS = ["1.1.", "2.3.", "3.4.-", "5.11."]

# Customers
BIRTHDATE = "substr(cast(date_add(cast('1930-01-01' as date), cast(c_custkey * 37 % 20000 as int)) as string), 1, 10)"
BIRTHDATE_DUCK = "cast(cast('1930-01-01' as date) + cast(c_custkey * 37 % 20000 as int) as varchar)"
GENDER = "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END"
DECEASED_AT = "CASE WHEN c_custkey % 7 = 0 THEN '2003-05' END"
DECEASED = "CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN false END"

# Parts
ATC_CODES = ["L02BB04", "L02AE01", "L01XC02", "L01BC06", "V03AF03"]
PART_ATC = pick("p_partkey", ATC_CODES)


def coding(system: str, code: str, display: str = "null", version: str = "null") -> str:
    return f"named_struct('system', {system}, 'version', {version}, 'code', {code}, 'display', {display})"


def q(text: str) -> str:
    return f"'{text}'"


def concept(codings: list[str], text: str = "null") -> str:
    return f"named_struct('coding', array({', '.join(codings)}), 'text', {text})"


def concept_of(system: str, code: str) -> str:
    return concept([coding(q(system), code)])


def extension(url: str, *, date: str = "null", value: str = "null") -> str:
    return f"named_struct('url', '{url}', 'valueDateTime', {date}, 'valueCodeableConcept', {value})"


def reference(text: str) -> str:
    return f"named_struct('reference', {text}, 'display', null)"


def by_kind(kind: str, arms: dict[int, str]) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN {k} THEN {v}" for k, v in arms.items()) + " END"


def shaped(df: DataFrame, resource_type: str, columns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Project to the declared schema; unset fields are NULL. Columns of ``keep`` stay beside it."""
    out = list(keep)
    for f in schema_of(resource_type).fields:
        out.append(f"cast({columns.get(f.name, 'null')} as {f.dataType.simpleString()}) as `{f.name}`")
    return df.selectExpr(*out)


def _cast(expr: str, kind: str) -> str:
    return f"cast({expr} as {TYPE_ALIASES[kind]})"


def patient(t: Tables, keep: Sequence[str] = ()) -> DataFrame:
    mr = concept_of("http://terminology.hl7.org/CodeSystem/v2-0203", "'MR'")
    return shaped(
        t.customer,
        "Patient",
        {
            "id": "c_custkey",
            "identifier": f"array(named_struct('type', {mr}, 'system', 'urn:mrn', 'value', c_name))",
            "name": "array(named_struct('family', c_name, 'given', array('X')))",
            "birthDate": BIRTHDATE,
            "gender": GENDER,
            "deceasedDateTime": DECEASED_AT,
            "deceasedBoolean": DECEASED,
        },
        keep,
    )


def condition(t: Tables, keep: Sequence[str] = ()) -> DataFrame:
    asserted = extension(K.ASSERTED_DATE, date=ASSERTED, value=_cast("null", "CodeableConcept"))
    morphology = extension(K.MORPHOLOGY, value=concept_of("urn:icd-o-3", MORPHOLOGY), date="cast(null as string)")
    return shaped(
        t.orders,
        "Condition",
        {
            "id": "o_orderkey",
            "meta": f"named_struct('profile', array({PROFILE_OF_CONDITION}), 'lastUpdated', null)",
            "extension": f"array({_cast(asserted, 'Extension')}, {_cast(morphology, 'Extension')})",
            "code": concept([coding(q("urn:other"), "'X'"), coding(q(K.ICD10), ICD)]),
            "bodySite": f"array({concept_of(K.ICDO3_TOPOGRAPHY, pick('o_orderkey', ['C61.9', 'C50.1', 'C18.0']))})",
            "subject": reference("concat('Patient/', o_custkey)"),
            "recordedDate": RECORDED,
            "onsetDateTime": day("o_orderdate"),
            "encounter": reference("concat('Encounter/', o_orderkey % 100)"),
            "verificationStatus": concept_of(K.VERIFICATION_STATUS, pick("o_orderkey", ["confirmed", "provisional"])),
        },
        keep,
    )


def observation(t: Tables) -> DataFrame:
    def codes_of(d: str) -> str:
        return pick(Q, TNM_LISTS[d])

    snomed, loinc = q(K.SNOMED), q(K.LOINC)
    one = "array({})".format
    code_codings = by_kind(
        OBS_KIND,
        {
            0: one(coding(snomed, q(K.DEATH_CODE))),
            1: one(coding(snomed, q(K.GLEASON_CODE))),
            2: one(coding(snomed, codes_of("uicc"))),
            3: one(coding(snomed, codes_of("t"))),
            4: one(coding(snomed, codes_of("n"), "'N category'")),
            5: one(coding(snomed, codes_of("m"), "'M category'")),
            7: one(coding(loinc, q(K.Y_SYMBOL_LOINC))),
            8: one(coding(snomed, q(K.METASTASIS_CODE))),
            9: one(coding(snomed, q(K.PROGRESSION_CODE))),
            10: one(coding(loinc, q(K.GRADING_LOINC))),
            11: one(coding(snomed, "'999'")),
            12: one(
                coding(
                    f"CASE WHEN {Q} % 2 = 0 THEN '{K.SNOMED}' ELSE 'urn:local' END",
                    f"CASE WHEN {Q} % 2 = 0 THEN '{K.ECOG_CODE}' ELSE '{K.KARNOFSKY_CODE}' END",
                )
            ),
            13: one(coding(loinc, q(K.VITAL_STATUS_LOINC))),
            14: one(coding(loinc, q(K.GENETIC_VARIANT_LOINC))),
            15: one(coding(loinc, pick(Q, LAB_CODES), f"concat('lab ', {Q} % 8)")),
        },
    )
    code_text = by_kind(
        OBS_KIND, {6: f"concat('class ', {Q} % 7)", 11: pick(Q, CLASS_NAMES)}
    )
    prefix = extension(
        K.TNM_PREFIX,
        date="cast(null as string)",
        value=concept_of("urn:prefix", f"CASE WHEN {Q} % 2 = 0 THEN 'c' ELSE 'p' END"),
    )

    def value(system: str, values: list[str]) -> str:
        return one(coding(q(system), pick(Q, values)))

    causes = (
        f"CASE WHEN {Q} % 4 = 0 THEN array({coding(q(K.ICD10), CAUSE_1)}, {coding(q(K.ICD10), CAUSE_2)}) "
        f"ELSE array({coding(q(K.ICD10), CAUSE_1)}) END"
    )
    values = by_kind(
        OBS_KIND,
        {
            0: causes,
            1: value(K.SNOMED, GLEASON_CODES),
            2: value(K.UICC_TNM, TNM_VALUES["uicc"]),
            3: value(K.UICC_TNM, TNM_VALUES["t"]),
            4: value(K.UICC_TNM, TNM_VALUES["n"]),
            5: value(K.UICC_TNM, TNM_VALUES["m"]),
            6: one(coding("'urn:stage'", pick(Q, ["I", "II"]))),
            7: value(K.SNOMED, ["421755005"]),
            8: value(K.METASTASIS_SITE, SITES),
            9: value(K.ASSESSMENT, ["V", "T", "K", "P", "D"]),
            10: value(K.GRADING, ["1", "2", "3", "4"]),
            11: f"array({coding(q('urn:class'), pick(Q, CLASS_CODES))}, {coding(q('urn:alt'), pick(Q, ['a', 'b']))})",
            12: f"CASE WHEN {Q} % 2 = 0 THEN {value(K.ECOG, ['0', '1', '2', '3', '4'])} "
            f"ELSE {value(K.KARNOFSKY, ['90%', '80%'])} END",
            13: f"CASE WHEN {Q} % 7 <> 0 THEN {value('urn:vital', ['L', 'T'])} END",
            15: f"CASE WHEN {Q} % 9 = 0 THEN {value(K.SNOMED, ['260385009'])} END",
        },
    )

    def component(code: str, values: list[str]) -> str:
        return (
            f"named_struct('code', {_cast(concept_of(K.SNOMED, q(code)), 'CodeableConcept')}, "
            f"'valueCodeableConcept', {_cast(concept_of('urn:status', pick(Q, values)), 'CodeableConcept')})"
        )

    components = "array({}, {}, {})".format(
        component(K.PRIMARY_STATUS_CODE, ["K", "T"]),
        component(K.LYMPH_NODE_STATUS_CODE, ["R", "N", "U"]),
        component(K.DISTANT_STATUS_CODE, ["M"]),
    )
    lab = f"{OBS_KIND} = 15"
    text_date = day("l_shipdate")
    return shaped(
        t.lineitem,
        "Observation",
        {
            "id": OBS_ID,
            "meta": f"named_struct('profile', array(CASE WHEN {OBS_KIND} = 11 THEN '{K.OTHER_CLASSIFICATION}|1.0' "
            "ELSE 'https://example.org/observation' END), 'lastUpdated', null)",
            "category": f"CASE WHEN {lab} THEN array({concept_of(K.OBSERVATION_CATEGORY, q('laboratory'))}) END",
            "code": f"named_struct('coding', {code_codings}, 'text', {code_text}, "
            f"'extension', CASE WHEN {OBS_KIND} IN (3, 4, 5) THEN array({prefix}) END)",
            "subject": reference(
                f"CASE WHEN {Q} % 5 = 0 THEN concat('http://server/fhir/', {OBS_PATIENT}, '/_history/3') "
                f"ELSE {OBS_PATIENT} END"
            ),
            "focus": f"CASE WHEN {Q} % 11 <> 0 THEN array({reference(OBS_CONDITION)}) END",
            "hasMember": f"CASE WHEN {OBS_KIND} = 2 THEN array("
            f"{reference('concat(' + q('Observation/') + ', l_orderkey, ' + q('-t') + ')')}, "
            f"{reference('concat(' + q('Observation/') + ', l_orderkey, ' + q('-n') + ')')}) END",
            "effectiveDateTime": f"CASE WHEN NOT ({lab}) THEN {OBS_DATE} WHEN {Q} % 4 = 0 THEN {text_date} END",
            "effectivePeriod": f"CASE WHEN {lab} AND {Q} % 4 = 1 THEN named_struct('start', {text_date}, 'end', null) END",
            "effectiveInstant": f"CASE WHEN {lab} AND {Q} % 4 = 2 THEN {text_date} END",
            "issued": f"CASE WHEN {lab} AND {Q} % 4 = 3 THEN {text_date} END",
            "valueCodeableConcept": f"named_struct('coding', {values}, 'text', "
            f"CASE WHEN {OBS_KIND} = 11 THEN concat('value ', {Q}) END)",
            "valueQuantity": f"CASE WHEN {lab} THEN named_struct('value', l_quantity * 1.5D, 'unit', null, "
            f"'code', {pick(Q, LAB_UNITS)}) END",
            "interpretation": by_kind(
                OBS_KIND,
                {
                    0: f"array({concept_of(K.DEATH_BY_TUMOUR, pick(Q, ['J', 'N', 'U']))})",
                    14: f"array({concept_of(K.VARIANT_TRAIT, pick(Q, ['POS', 'NEG']))})",
                },
            ),
            "note": f"CASE WHEN {OBS_KIND} = 14 THEN array(named_struct('text', {pick(Q, ['NPM1', 'FLT3', 'TP53'])})) END",
            "component": f"CASE WHEN {OBS_KIND} = 9 THEN {components} END",
        },
    )


SYSTEM_ID = "concat('S-', cast(o_orderkey as string))"
RADIO_ID = "concat('R-', cast(o_orderkey as string))"


def procedure(t: Tables) -> DataFrame:
    """System therapy and radiotherapy per order; surgeries and irradiations per line item."""
    start = day("o_orderdate")
    period = f"CASE WHEN o_orderkey % 6 <> 0 THEN named_struct('start', {start}, 'end', null) END"

    def parents(kind: str, profile: str, intention: str, relation: str, even: int) -> DataFrame:
        ext = "array({}, {})".format(
            extension(intention, date="cast(null as string)", value=concept_of(K.INTENTION, pick("o_orderkey", INTENTIONS))),
            extension(
                relation, date="cast(null as string)", value=concept_of(K.RELATION_TO_SURGERY, pick("o_orderkey", RELATIONS))
            ),
        )
        return shaped(
            t.orders.where(f"o_orderkey % 2 = {even}"),
            "Procedure",
            {
                "id": kind,
                "meta": f"named_struct('profile', array('{profile}|1.0'), 'lastUpdated', null)",
                "status": "'completed'",
                "extension": ext,
                "code": concept_of(K.THERAPY_TYPE, pick("o_orderkey", THERAPY_TYPES)),
                "subject": reference("concat('Patient/', o_custkey)"),
                "reasonReference": f"array({reference('concat(' + q('Condition/') + ', o_orderkey)')})",
                "performedPeriod": period,
                "outcome": concept_of(K.THERAPY_END_REASON, pick("o_orderkey", END_REASONS)),
                "usedCode": f"array({concept([coding('null', 'null')], 'concat(' + q('protocol ') + ', o_orderkey % 9)')})",
            },
        )

    item = {
        "id": OBS_ID,
        "status": "'completed'",
        "subject": reference(OBS_PATIENT),
        "reasonReference": f"array({reference('concat(' + q('Condition/') + ', l_orderkey)')})",
    }
    surgery_ext = extension(
        K.SURGERY_INTENTION, date="cast(null as string)", value=concept_of(K.INTENTION, pick(Q, INTENTIONS))
    )
    surgeries = shaped(
        t.lineitem.where("l_suppkey % 2 = 0"),
        "Procedure",
        {
            **item,
            "meta": f"named_struct('profile', array('{K.SURGERY}|1.0'), 'lastUpdated', null)",
            "extension": f"array({surgery_ext})",
            "code": concept([coding(q(K.OPS), pick("l_partkey", OPS_CODES), version="'2024'", display=f"concat('ops ', {Q} % 3)")]),
            "performedDateTime": day("l_shipdate"),
            "outcome": concept_of(K.RESIDUAL_STATUS, pick(Q, ["R0", "R1", "RX"])),
        },
    )
    irradiations = shaped(
        t.lineitem.where("l_suppkey % 2 = 1"),
        "Procedure",
        {
            **item,
            "meta": f"named_struct('profile', array('{K.IRRADIATION}|1.0'), 'lastUpdated', null)",
            "partOf": f"array({reference('concat(' + q('Procedure/R-') + ', l_orderkey)')})",
            "performedPeriod": f"named_struct('start', {day('l_shipdate')}, 'end', null)",
            "bodySite": f"array({concept_of(K.TARGET_REGION, pick(Q, REGIONS))})",
        },
    )
    return (
        parents(SYSTEM_ID, K.SYSTEM_THERAPY, K.SYSTEM_INTENTION, K.SYSTEM_RELATION, 0)
        .unionByName(parents(RADIO_ID, K.RADIOTHERAPY, K.RADIO_INTENTION, K.RADIO_RELATION, 1))
        .unionByName(surgeries)
        .unionByName(irradiations)
    )


OPS_CODES = ["5-604.0", "5-399.5", "8-544.1", "6-001.a"]
INLINE = "l_partkey % 3 <> 0"


def medication_statement(t: Tables) -> DataFrame:
    inline = concept([coding(q(K.ATC_NATIONAL), pick("l_partkey", ATC_CODES))], "concat('drug ', l_partkey % 5)")
    return shaped(
        t.lineitem,
        "MedicationStatement",
        {
            "id": OBS_ID,
            "status": "'active'",
            "subject": reference(OBS_PATIENT),
            "partOf": f"array({reference('concat(' + q('Procedure/S-') + ', l_orderkey)')})",
            "reasonReference": f"array({reference('concat(' + q('Condition/') + ', l_orderkey)')})",
            "effectivePeriod": f"named_struct('start', {partial('l_shipdate', 'l_orderkey')}, 'end', {day('l_shipdate')})",
            "medicationCodeableConcept": f"CASE WHEN {INLINE} THEN {inline} END",
            "medicationReference": f"CASE WHEN NOT ({INLINE}) THEN {reference('concat(' + q('Medication/') + ', l_partkey)')} END",
            "dosage": f"array(named_struct('text', concat({Q}, ' mg')))",
        },
    )


def medication(t: Tables) -> DataFrame:
    return shaped(
        t.part,
        "Medication",
        {
            "id": "p_partkey",
            "code": concept(
                [
                    coding(f"CASE WHEN p_partkey % 2 = 0 THEN '{K.ATC_WHO}' ELSE '{K.ATC_NATIONAL}' END", PART_ATC),
                    coding(q(K.PZN), "cast(p_size as string)", "p_brand"),
                ],
                "p_name",
            ),
            "ingredient": f"array(named_struct('itemCodeableConcept', {_cast(concept([coding('null', 'null')], 'p_type'), 'CodeableConcept')}, "
            f"'itemReference', {_cast('null', 'Reference')}))",
        },
    )


def adverse_event(t: Tables) -> DataFrame:
    return shaped(
        t.events,
        "AdverseEvent",
        {
            "id": "event_id",
            "event": f"CASE WHEN event_id % 3 = 0 THEN {concept([coding(q(K.SNOMED), q('1'))], 'event_type')} "
            f"ELSE named_struct('coding', null, 'text', event_type) END",
        },
    )


EVENT_TIME = "substr(cast(ts as string), 1, 19)"


def encounter(t: Tables) -> DataFrame:
    return shaped(
        t.events,
        "Encounter",
        {
            "id": "event_id",
            "status": "'finished'",
            "class": coding(f"CASE WHEN event_id % 4 <> 0 THEN '{K.ACT_CODE}' ELSE 'urn:x' END", pick("event_id", ["IMP", "AMB"]), pick("event_id", ["inpatient", "ambulatory"])),
            "subject": reference("concat('Patient/', user_id)"),
            "period": f"named_struct('start', {EVENT_TIME}, 'end', CASE WHEN event_id % 3 = 0 THEN {EVENT_TIME} END)",
        },
    )


def medication_request(t: Tables) -> DataFrame:
    return shaped(
        t.events,
        "MedicationRequest",
        {
            "id": "event_id",
            "status": "'active'",
            "intent": pick("event_id", ["order", "plan"]),
            "subject": reference("concat('Patient/', user_id)"),
            "authoredOn": EVENT_TIME,
            "dosageInstruction": "array(named_struct('text', event_type))",
            "medicationCodeableConcept": concept([coding(q(K.ATC_WHO), pick("event_id", ATC_CODES))]),
        },
    )


def medication_administration(t: Tables) -> DataFrame:
    return shaped(
        t.events,
        "MedicationAdministration",
        {
            "id": "event_id",
            "status": "'completed'",
            "subject": reference("concat('Patient/', user_id)"),
            "effectiveDateTime": f"CASE WHEN event_id % 2 = 0 THEN {EVENT_TIME} END",
            "effectivePeriod": f"CASE WHEN event_id % 2 = 1 THEN named_struct('start', {EVENT_TIME}, 'end', {EVENT_TIME}) END",
            "dosage": "named_struct('text', event_type)",
            "medicationReference": reference("concat('Medication/', event_id % 50)"),
        },
    )


BUILDERS = {
    "Patient": patient,
    "Condition": condition,
    "Observation": observation,
    "Procedure": procedure,
    "MedicationStatement": medication_statement,
    "Medication": medication,
    "AdverseEvent": adverse_event,
    "Encounter": encounter,
    "MedicationRequest": medication_request,
    "MedicationAdministration": medication_administration,
}


def source(t: Tables) -> dict[str, DataFrame]:
    """All resource types over the given tables."""
    return {name: build(t) for name, build in BUILDERS.items()}
