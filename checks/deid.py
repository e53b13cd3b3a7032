"""De-identification (group G) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import shape as H
from checks import views as VQ
from checks.dates import DAY, ISO_TEXT, months, people, stamps
from checks.registry import query
from cohortloom.functions import deid as X
from cohortloom.operators import deident as G
from cohortloom.operators import views as V

KEY = bytes(range(32))
LONG_KEY = bytes(i % 251 for i in range(256))
SECRET = G.run_secret(KEY, 11)


def hmac_sql(expr: str, key: bytes = KEY) -> str:
    inner, outer = X._pads(key)
    return (
        f"sha256(unhex('{outer.hex()}') || unhex(sha256(unhex('{inner.hex()}') || encode({expr}))))"
    )


query("hmac_sha256", f"SELECT c_custkey, {hmac_sql('c_name')} AS h FROM customer")(
    lambda t: t.customer.select("c_custkey", X.hmac_sha256("c_name", KEY).alias("h"))
)
query(
    "hmac_sha256_long_key", f"SELECT c_custkey, {hmac_sql('c_name', LONG_KEY)} AS h FROM customer"
)(lambda t: t.customer.select("c_custkey", X.hmac_sha256("c_name", LONG_KEY).alias("h")))

query("plain_sha256", "SELECT c_custkey, sha256(c_name) AS h FROM customer")(
    lambda t: t.customer.select("c_custkey", X.plain_sha256("c_name").alias("h"))
)

query(
    "deidentify",
    f"""WITH p AS (SELECT o_orderkey, o_custkey, cast(o_orderdate as date) AS d,
            cast({H.BIRTHDATE_DUCK} as date) AS b, {H.GENDER} AS gender, {H.ICD} AS icd10_code
            FROM orders JOIN customer ON c_custkey = o_custkey)
        SELECT {hmac_sql("concat('Condition/', o_orderkey)")} AS condition_id_hash,
            {hmac_sql("concat('Patient/', o_custkey)")} AS patient_resource_id_hash, gender, icd10_code,
            round({months('b', 'd')}, 2) AS months_between_asserted_birthdate,
            cast(year(d) as int) AS asserted_year FROM p""",
)(
    lambda t: G.deidentify(
        people(t).select(
            F.concat(F.lit("Condition/"), "o_orderkey").alias("condition_id"),
            F.concat(F.lit("Patient/"), "o_custkey").alias("patient_resource_id"),
            F.lit("x").alias("meta_profile"),
            F.col("o_custkey").cast("string").alias("subject_reference"),
            "gender",
            "icd10_code",
            "asserted_date",
            "birthdate",
        ),
        KEY,
    )
)

query(
    "deidentify_server",
    f"""SELECT {hmac_sql("concat('Condition/', o_orderkey)")} AS condition_id_hash,
        {hmac_sql("concat('Patient/', o_custkey)")} AS condition_patient_reference_hash, {H.ICD} AS icd_code,
        {DAY} AS "diagnosis_onsetDateTime", {H.RECORDED} AS "diagnosis_recordedDate" FROM orders""",
)(lambda t: G.deidentify_server(V.onset_conditions(H.condition(t)), KEY))

query(
    "deidentify_patients",
    f"""SELECT {hmac_sql("cast(o_orderkey as varchar)")} AS condition_id,
        {hmac_sql("concat('Patient/', o_custkey)")} AS condition_patient_reference,
        {hmac_sql("c_name")} AS patient_mrn, {H.GENDER} AS gender,
        strftime(CASE o_orderkey % 6 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 570 MINUTE
            WHEN 2 THEN o_orderdate + INTERVAL 630 MINUTE END + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS "diagnosis_recordedDate",
        cast(year(cast({H.BIRTHDATE_DUCK} as date)) as int) AS birth_year
        FROM orders JOIN customer ON c_custkey = o_custkey""",
)(
    lambda t: stamps(
        G.deidentify_table(
            t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
                "cast(o_orderkey as string) AS condition_id",
                "concat('Patient/', o_custkey) AS condition_patient_reference",
                "c_name AS patient_mrn",
                f"{H.GENDER} AS gender",
                f"{ISO_TEXT} AS `diagnosis_recordedDate`",
                f"{H.BIRTHDATE} AS birth_date",
            ),
            G.TABLE_SPECS["patients"],
            SECRET,
        ),
        "diagnosis_recordedDate",
    )
)

query(
    "deidentify_encounters",
    f"""SELECT {hmac_sql("cast(event_id as varchar)")} AS encounter_id,
        {hmac_sql("concat('Patient/', user_id)")} AS encounter_patient_reference, 'finished' AS status,
        CASE WHEN event_id % 4 <> 0 THEN {H.pick('event_id', ['IMP', 'AMB'])} END AS enc_class_code,
        CASE WHEN event_id % 4 <> 0 THEN {H.pick('event_id', ['inpatient', 'ambulatory'])} END AS enc_class_display,
        strftime(ts + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS enc_period_start,
        CASE WHEN event_id % 3 = 0 THEN strftime(ts + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') END AS enc_period_end
        FROM events""",
)(
    lambda t: stamps(
        G.deidentify_table(V.encounters(H.encounter(t)), G.TABLE_SPECS["encounters"], SECRET),
        "enc_period_start",
        "enc_period_end",
    )
)

query(
    "deidentify_prescriptions",
    f"""SELECT {hmac_sql("cast(event_id as varchar)")} AS "REZEPT_ID",
        {hmac_sql("cast(user_id as varchar)")} AS patient_mrn,
        strftime(date_trunc('day', ts) + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS "REZEPT_DATUM",
        cast(null as varchar) AS "AUFNAHME_DATUM" FROM events""",
)(
    lambda t: stamps(
        G.deidentify_table(
            t.events.selectExpr(
                "cast(event_id as string) AS REZEPT_ID",
                "cast(user_id as string) AS patient_mrn",
                "date_format(ts, 'dd.MM.yyyy') AS REZEPT_DATUM",
                "event_id AS FALL_ID",
                "event_id AS TEILFALL_ID",
            ),
            G.TABLE_SPECS["prescriptions"],
            SECRET,
        ),
        "REZEPT_DATUM",
        "AUFNAHME_DATUM",
    )
)

query(
    "deidentify_drug_export",
    f"""SELECT {hmac_sql("cast(event_id as varchar)")} AS "Herstellungs-ID",
        {hmac_sql("cast(user_id as varchar)")} AS patient_mrn, event_type AS "Wirkstoff",
        cast(event_id % 40 as varchar) AS "Dosis", 'FALSCH' AS "Retoure", cast(null as varchar) AS "Applikationsart",
        cast(null as varchar) AS "Therapieprotokoll",
        concat('Wirkstoff: ', event_type, ' (Dosis: ', event_id % 40, ') Protokoll: nan Applikationsart: nan Retoure?: FALSCH') AS label,
        strftime(date_trunc('day', ts) + INTERVAL 7 HOUR + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS "Applikationszeitpunkt"
        FROM events WHERE user_id % 9 <> 0""",
)(
    lambda t: stamps(
        G.deidentify_drug_export(
            t.events.selectExpr(
                "CASE WHEN user_id % 9 = 0 THEN '*** VALUE NOT FOUND ***' ELSE cast(user_id as string) END AS `KIS-Patienten-ID`",
                "cast(event_id as string) AS `Herstellungs-ID`",
                "date_format(ts, 'dd.MM.yyyy') AS Datum",
                "event_type AS Wirkstoff",
                "cast(event_id % 40 as string) AS Dosis",
            ),
            "KIS-Patienten-ID",
            SECRET,
        ),
        "Applikationszeitpunkt",
    )
)

query(
    "mrn_lookup_table",
    f"SELECT DISTINCT cast(user_id as varchar) AS patient_mrn, {hmac_sql('cast(user_id as varchar)')} AS patient_mrn_hash FROM events",
)(
    lambda t: G.mrn_lookup_table(
        t.events.select(F.col("user_id").cast("string").alias("patient_mrn")), "patient_mrn", KEY
    )
)

MRN = """CASE c_custkey % 5 WHEN 0 THEN concat(cast(c_custkey as string), '.0') WHEN 1 THEN concat('00', cast(c_custkey as string))
    WHEN 2 THEN concat(' ', cast(c_custkey as string), ' ') WHEN 3 THEN '' END"""
query(
    "clean_mrn",
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN cast(c_custkey as varchar) WHEN 1 THEN concat('00', c_custkey)
        WHEN 2 THEN cast(c_custkey as varchar) END AS mrn FROM customer""",
)(lambda t: t.customer.selectExpr("c_custkey", f"{MRN} AS m").select("c_custkey", X.clean_mrn("m").alias("mrn")))

query(
    "strip_leading_zeros",
    """SELECT c_custkey, ltrim(concat('00', c_custkey), '0') AS stripped,
        CASE WHEN c_custkey % 2 = 0 THEN ltrim(concat('00', c_custkey), '0') ELSE concat('00A', c_custkey) END AS registry_id
        FROM customer""",
)(
    lambda t: t.customer.selectExpr(
        "c_custkey",
        "concat('00', c_custkey) AS z",
        "CASE WHEN c_custkey % 2 = 0 THEN concat('00', c_custkey) ELSE concat('00A', c_custkey) END AS y",
    ).select(
        "c_custkey", X.strip_leading_zeros("z").alias("stripped"), X.numeric_id("y").alias("registry_id")
    )
)

query(
    "clean_literals",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN event_type END AS kind FROM events""",
)(
    lambda t: G.clean_literals(
        t.events.selectExpr(
            "event_id", "CASE event_id % 3 WHEN 0 THEN 'NaN' WHEN 1 THEN 'nan' ELSE event_type END AS kind"
        )
    )
)

query(
    "pseudonymise_patients",
    f"""SELECT {hmac_sql('cast(c_custkey as varchar)')} AS id, {hmac_sql('c_name')} AS mrn,
        cast(null as varchar) AS family, {H.GENDER} AS gender FROM customer""",
)(
    lambda t: G.pseudonymise_resources(H.patient(t), KEY).select(
        "id",
        F.col("identifier")[0]["value"].alias("mrn"),
        F.get("name", F.lit(0))["family"].alias("family"),
        "gender",
    )
)

query(
    "pseudonymise_statements",
    f"""SELECT {hmac_sql(H.OBS_ID)} AS id,
        concat('Patient/', {hmac_sql("cast(cast(floor(l_orderkey / 10) as bigint) as varchar)")}) AS subject,
        concat('Procedure/', {hmac_sql("concat('S-', l_orderkey)")}) AS part_of,
        CASE WHEN NOT ({H.INLINE}) THEN concat('Medication/', {hmac_sql("cast(l_partkey as varchar)")}) END AS medication
        FROM lineitem""",
)(
    lambda t: G.pseudonymise_resources(H.medication_statement(t), KEY).select(
        "id",
        F.col("subject.reference").alias("subject"),
        F.col("partOf")[0]["reference"].alias("part_of"),
        F.col("medicationReference.reference").alias("medication"),
    )
)


_LAB_REF = f"CASE WHEN {H.Q} % 5 = 0 THEN concat('http://server/fhir/', {H.OBS_PATIENT}, '/_history/3') ELSE {H.OBS_PATIENT} END"
query(
    "deidentify_labs",
    f"""SELECT {hmac_sql(H.OBS_ID)} AS observation_id, {hmac_sql(_LAB_REF)} AS observation_patient_reference, {H.pick(H.Q, H.LAB_CODES)} AS loinc_code,
        l_quantity * 1.5 AS lab_quantity_value, strftime(l_shipdate + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS "lab_dateTime" FROM lineitem WHERE {H.OBS_KIND} = 15""",
)(
    lambda t: stamps(
        G.deidentify_table(V.labs(H.observation(t)), G.TABLE_SPECS["labs"], SECRET).select(
            "observation_id", "observation_patient_reference", "loinc_code", "lab_quantity_value", "lab_dateTime"
        ),
        "lab_dateTime",
    )
)

query(
    "deidentify_medication_events",
    f"""SELECT type, {hmac_sql('id')} AS id, {hmac_sql('patient_reference')} AS patient_reference,
        CASE WHEN medication_reference IS NOT NULL THEN {hmac_sql('medication_reference')} END AS medication_reference,
        strftime(cast(datetime as timestamp) + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS datetime FROM ({VQ.REQUEST_SQL} UNION ALL {VQ.ADMINISTRATION_SQL})""",
)(
    lambda t: stamps(
        G.deidentify_table(
            V.request_events(H.medication_request(t)).unionByName(V.administration_events(H.medication_administration(t))),
            G.TABLE_SPECS["medication_events"],
            SECRET,
        ).select("type", "id", "patient_reference", "medication_reference", "datetime"),
        "datetime",
    )
)

query(
    "deidentify_letter_findings",
    f"""SELECT {hmac_sql('cast(user_id as varchar)')} AS patient_mrn, {hmac_sql("concat('letter-', event_id)")} AS source_file, event_type AS gene,
        strftime(date_trunc('day', ts) + INTERVAL 11 DAY, '%Y-%m-%d %H:%M:%S') AS document_date, '2019-12-12 00:00:00' AS date FROM events""",
)(
    lambda t: stamps(
        G.deidentify_table(
            t.events.selectExpr(
                "cast(user_id as string) AS patient_mrn",
                "concat('letter-', event_id) AS source_file",
                "event_type AS gene",
                "date_format(ts, 'yyyy-MM-dd') AS document_date",
                "'2019-12' AS date",
            ),
            G.TABLE_SPECS["letter_findings"],
            SECRET,
        ),
        "document_date",
        "date",
    )
)
