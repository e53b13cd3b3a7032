"""Whole studies over shaped resources (group P) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cohorts as CQ
from checks import linkage as LQ
from checks import shape as H
from checks import texts as TQ
from checks import views as VQ
from checks.dates import months, strings
from checks.registry import query
from cohortloom.operators import views as V
from cohortloom.plans import leukaemia as LK
from cohortloom.plans import studies as ST
from cohortloom.plans.base import lazily
from cohortloom.plans.letter_study import letter_study
from cohortloom.plans.treatment_question import treatment_question

Q = H.Q


def start_of(text: str) -> str:
    """Partial date text as the first moment it names."""
    return f"cast(substr(({text}) || '-01-01', 1, 10) as date)"


def middle_of(text: str) -> str:
    """Partial date text as the study date: the 15th, or 1 July."""
    return f"cast(CASE length({text}) WHEN 10 THEN {text} WHEN 7 THEN concat({text}, '-15') WHEN 4 THEN concat({text}, '-07-01') END as date)"


# Treatment question -----------------------------------------------------------------------------

PROSTATE_SQL = f"""SELECT condition_id, condition_patient_resource_id AS condition_patient_id, asserted_date, recorded_date
    FROM ({VQ.CONDITION_SQL}) WHERE icd10_code LIKE 'C61%'"""
NEAREST_SQL = f"""SELECT * FROM (SELECT s.*, c.* EXCLUDE (condition_id), row_number() OVER (PARTITION BY condition_id
        ORDER BY abs(datediff('day', {start_of('asserted_date')}, {start_of('effective_date_time')})), {start_of('effective_date_time')}, observation_id) AS rn
    FROM ({PROSTATE_SQL}) c JOIN ({VQ.STAGING_SQL}) s USING (condition_id) WHERE asserted_date IS NOT NULL AND effective_date_time IS NOT NULL) WHERE rn = 1"""
EARLY_SQL = f"SELECT * FROM ({NEAREST_SQL}) WHERE tnm_value IN ('N0', 'M0')"
DRUGS_SQL = f"""SELECT medication_statement_id, subject_reference AS medication_statement_patient_id, reason_reference AS condition_id,
    medication_statement_start_date AS medication_start_date, medication_statement_text AS medication_text, medication_statement_atc_code AS medication_atc_code FROM ({LQ.RESOLVED_SQL})"""
TREATED_SQL = f"SELECT * FROM ({EARLY_SQL}) JOIN ({DRUGS_SQL}) USING (condition_id)"
DRUG, REFERENCE = "L02BB04", "1998-04-01"


def question(t):
    return treatment_question(H.source(t), DRUG, REFERENCE, H.PROSTATE_CODES)


query(
    "treatment_cohort",
    f"""SELECT condition_id, observation_id, patient_id, effective_date_time AS effective_date_time_first, code_coding_sct, tnm_value, code, display, condition_patient_id,
        asserted_date, recorded_date, medication_statement_id, medication_statement_patient_id, medication_start_date, medication_text, medication_atc_code
        FROM ({TREATED_SQL}) WHERE medication_atc_code = '{DRUG}'""",
)(lambda t: question(t)["cohort"])

query(
    "treatment_medication_counts",
    f"SELECT medication_text, medication_atc_code, count(DISTINCT patient_id) AS num_patients FROM ({TREATED_SQL}) GROUP BY 1, 2",
)(lambda t: question(t)["medication_counts"])

_X = f"SELECT * FROM ({TREATED_SQL}) WHERE medication_atc_code = '{DRUG}'"
query(
    "treatment_funnel",
    f"""SELECT 0 AS step_no, 'all' AS step, count(DISTINCT condition_patient_id) AS n FROM ({PROSTATE_SQL})
        UNION ALL SELECT 1, 'early_stage', count(DISTINCT condition_patient_id) FROM ({EARLY_SQL})
        UNION ALL SELECT 2, 'treated', count(DISTINCT condition_patient_id) FROM ({_X})
        UNION ALL SELECT 3, 'before', count(DISTINCT condition_patient_id) FROM ({_X}) WHERE medication_start_date < '{REFERENCE}'
        UNION ALL SELECT 4, 'after', count(DISTINCT condition_patient_id) FROM ({_X}) WHERE medication_start_date >= '{REFERENCE}'""",
)(lambda t: question(t)["funnel"])

# Study A ----------------------------------------------------------------------------------------

BASE_SQL = f"""SELECT *, CASE WHEN count(patid_pseudonym) OVER (PARTITION BY patid_pseudonym) > 1 THEN 1 ELSE 0 END AS double_patid,
    deceased_boolean IS NOT DISTINCT FROM 'true' OR deceased_datetime IS NOT NULL OR d_dead IS NOT NULL AS is_deceased FROM ({VQ.CONDITION_SQL})
    LEFT JOIN ({VQ.PATIENTS_SQL}) ON condition_patient_resource_id = patient_resource_id
    LEFT JOIN (SELECT {CQ.DEAD} AS d_dead, death_cause_icd10 AS causes FROM ({CQ.CONSOLIDATED_SQL})) ON d_dead = patient_resource_id"""
GLEASON_SQL = VQ.observation_sql(
    1,
    {
        "g_id": VQ.OBS_KEY,
        "g_condition": H.OBS_CONDITION,
        "gleason_date": H.OBS_DATE,
        "gleason_score": f"CASE ({Q}) % 9 WHEN 0 THEN 6 WHEN 1 THEN 7 WHEN 2 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 8 WHEN 5 THEN 8 WHEN 6 THEN 9 WHEN 7 THEN 9 WHEN 8 THEN 10 END",
    },
)
SITE_DAYS_SQL = f"SELECT condition_id AS m_condition, metastasis_date, string_agg(DISTINCT metastasis_loc, '|' ORDER BY metastasis_loc) AS metastasis_loc FROM ({VQ.METASTASES_SQL}) GROUP BY 1, 2"


def nearest_sql(events: str, key: str, date: str, tie: str) -> str:
    return f"""SELECT * FROM (SELECT e.*, row_number() OVER (PARTITION BY {key} ORDER BY abs(datediff('day', {start_of('asserted_date')}, {start_of(date)})), {start_of(date)}, {tie}) AS rn
        FROM ({VQ.CONDITION_SQL}) c JOIN ({events}) e ON condition_id = {key} WHERE asserted_date IS NOT NULL AND {date} IS NOT NULL) WHERE rn = 1"""


query(
    "study_a",
    f"""SELECT condition_id, icd10_code, patient_resource_id, double_patid, is_deceased, causes AS death_cause_icd10, gleason_date AS gleason_date_first, gleason_score,
        metastasis_loc, metastasis_date AS metastasis_date_first FROM ({BASE_SQL})
        LEFT JOIN ({nearest_sql(GLEASON_SQL, 'g_condition', 'gleason_date', 'g_id')}) g ON g_condition = condition_id
        LEFT JOIN ({nearest_sql(SITE_DAYS_SQL, 'm_condition', 'metastasis_date', 'metastasis_loc')}) m ON m_condition = condition_id""",
)(
    lambda t: ST.study_a(H.source(t)).select(
        "condition_id",
        "icd10_code",
        "patient_resource_id",
        "double_patid",
        "is_deceased",
        "death_cause_icd10",
        "gleason_date_first",
        "gleason_score",
        "metastasis_loc",
        "metastasis_date_first",
    )
)

query(
    "study_leukaemia_filter",
    f"""SELECT condition_id, icd10_code, is_deceased FROM ({BASE_SQL}) WHERE icd10_code IN ('C83.3', 'C83.1') OR regexp_matches(icd10_code, '^(C90|C91|C92|C93|C94|C95|D46|C82|C85)')""",
)(lambda t: ST.leukaemia_filter(H.source(t)).select("condition_id", "icd10_code", "is_deceased"))

query(
    "reacto_counts",
    f"""WITH x AS (SELECT icd10_code, gender, weitere_klassifikation_code_text AS txt, weitere_klassifikation_code AS code, {middle_of('asserted_date')} AS d
            FROM ({BASE_SQL}) LEFT JOIN ({VQ.FIRST_CLASSIFICATIONS_SQL}) ON focus_reference = condition_id WHERE meta_profile_1 LIKE '%primaertumor%'),
        w AS (SELECT * FROM x WHERE (substr(icd10_code, 1, 3) IN ('C15', 'C18', 'C34', 'C71') OR (icd10_code LIKE 'C25%' AND icd10_code NOT LIKE 'C25.4%')) AND year(d) BETWEEN 1996 AND 1999)
        SELECT substr(icd10_code, 1, 3) AS icd10_parent, count(*) AS total_count, count(*) FILTER (gender = 'male') AS male_count, count(*) FILTER (gender = 'female') AS female_count FROM w GROUP BY 1
        UNION ALL SELECT 'C71_IV', count(*), count(*) FILTER (gender = 'male'), count(*) FILTER (gender = 'female') FROM w
            WHERE icd10_code LIKE 'C71%' AND lower(txt) LIKE '%who%' AND code IN ('IV', '4') HAVING count(*) > 0""".replace("meta_profile_1", "meta_profile").replace(
        f"({VQ.FIRST_CLASSIFICATIONS_SQL})", f"(SELECT * EXCLUDE (meta_profile) FROM ({VQ.FIRST_CLASSIFICATIONS_SQL}))"
    ),
)(lambda t: ST.reacto_counts(H.source(t), (1996, 1999))["reacto_counts"])

# All conditions ---------------------------------------------------------------------------------

FIRST_DEATHS_SQL = f"""SELECT * FROM ({VQ.DEATH_CAUSES_SQL}) WHERE date_death IS NOT NULL
    QUALIFY rank() OVER (PARTITION BY {CQ.DEAD} ORDER BY date_death, observation_resource_id) = 1"""
PRIMARY_SQL = f"""SELECT * FROM (SELECT *, CASE WHEN count(patid_pseudonym) OVER (PARTITION BY patid_pseudonym) > 1 THEN 1 ELSE 0 END AS double_patid
    FROM (SELECT * FROM ({VQ.CONDITION_SQL}) WHERE meta_profile LIKE '%primaertumor%') LEFT JOIN ({VQ.PATIENTS_SQL}) ON condition_patient_resource_id = patient_resource_id)
    LEFT JOIN ({FIRST_DEATHS_SQL}) ON {CQ.DEAD} = patient_resource_id"""
CLEAN_SQL = f"""SELECT *, round(datediff('day', cast(birthdate as date), ad) / cast(365.25 as double), 2) AS age_at_diagnosis, split_part(icd10_code, '.', 1) AS parent
    FROM (SELECT *, {middle_of('asserted_date')} AS ad FROM ({PRIMARY_SQL})) WHERE ad > date '1970-12-31' AND round(datediff('day', cast(birthdate as date), ad) / cast(365.25 as double), 2) > 0
    AND icd10_code NOT LIKE 'C44%'"""


def everything(t):
    return ST.all_conditions(H.source(t), keep=lazily)


query(
    "all_conditions",
    f"""SELECT condition_id, cast(ad as varchar) AS asserted_date, age_at_diagnosis, CASE {CQ.ENTITY_CASES} ELSE parent END AS entity_or_parent, double_patid,
        death_cause_icd10 FROM ({CLEAN_SQL})""",
)(
    lambda t: strings(
        everything(t)["all_obds_clean"].select(
            "condition_id", "asserted_date", "age_at_diagnosis", "entity_or_parent", "double_patid", "death_cause_icd10"
        ),
        "asserted_date",
    )
)

_COND = f"SELECT DISTINCT condition_id, ad FROM ({CLEAN_SQL})"
query(
    "all_conditions_gradings",
    f"""SELECT c.condition_id, grading, cast({middle_of('grading_date')} as varchar) AS grading_date FROM ({_COND}) c
        LEFT JOIN ({VQ.GRADINGS_SQL}) g ON g.condition_id = c.condition_id""",
)(lambda t: strings(everything(t)["gradings"].select("condition_id", "grading", "grading_date"), "grading_date"))

query(
    "all_conditions_vital_status",
    f"""SELECT condition_id, vitalstatus_code, cast({middle_of('"effective_dateTime"')} as varchar) AS seen FROM (SELECT DISTINCT condition_id, patient_resource_id FROM ({CLEAN_SQL}))
        JOIN ({VQ.VITAL_SQL}) ON observation_patient_reference = patient_resource_id""",
)(
    lambda t: everything(t)["vital_status"].select(
        "condition_id", "vitalstatus_code", F.col("effective_dateTime").cast("string").alias("seen")
    )
)

query(
    "all_conditions_system_therapies",
    f"""SELECT c.condition_id, therapy_id, therapy_type, coalesce(drugs, '') AS medication_statement_text FROM ({_COND}) c LEFT JOIN
        (SELECT reason_reference, therapy_id, therapy_type, drugs FROM ({VQ.SYSTEM_SQL}) LEFT JOIN (SELECT part_of_reference, string_agg(DISTINCT medication_statement_text, '| ' ORDER BY medication_statement_text) AS drugs
            FROM ({LQ.RESOLVED_SQL}) GROUP BY 1) ON part_of_reference = therapy_id) s ON s.reason_reference = c.condition_id""",
)(
    lambda t: everything(t)["system_therapies"]
    .select("condition_id", "therapy_id", "therapy_type", "medication_statement_text")
    .fillna("", ["medication_statement_text"])
)

query(
    "all_conditions_radiotherapies",
    f"""SELECT c.condition_id, therapy_id, coalesce(regions, '') AS zielgebiet FROM ({_COND}) c LEFT JOIN
        (SELECT reason_reference, therapy_id, regions FROM ({VQ.RADIO_SQL}) LEFT JOIN (SELECT part_of_reference AS p, string_agg(DISTINCT zielgebiet, '| ' ORDER BY zielgebiet) AS regions
            FROM ({VQ.IRRADIATION_SQL}) GROUP BY 1) ON p = therapy_id) s ON s.reason_reference = c.condition_id""",
)(
    lambda t: everything(t)["radiotherapies_joined"].select("condition_id", "therapy_id", "zielgebiet").fillna("", ["zielgebiet"])
)

query(
    "all_conditions_tnm_t",
    f"""SELECT c.condition_id, observation_id, t_tnm, t_tnm_prefix_sct, has_member FROM ({_COND}) c LEFT JOIN ({VQ.TNM_T_SQL}) s ON s.condition_id = c.condition_id
        LEFT JOIN ({VQ.TNM_PARENT_SQL}) p ON p.has_member = observation_id""",
)(lambda t: everything(t)["tnm_t"].select("condition_id", "observation_id", "t_tnm", "t_tnm_prefix_sct", "has_member"))

# Two tumours ------------------------------------------------------------------------------------

_NUM = f"""SELECT *, row_number() OVER (PARTITION BY patient_resource_id ORDER BY ad, condition_id) AS n, count(*) OVER (PARTITION BY patient_resource_id) AS total,
    CASE {CQ.ENTITY_CASES} ELSE parent END AS entity FROM (SELECT DISTINCT patient_resource_id, condition_id, ad, parent, double_patid FROM ({CLEAN_SQL})) WHERE double_patid = 1"""
query(
    "study_d_pairs",
    f"""SELECT e1 AS entity_or_parent_1, e2 AS entity_or_parent_2, count(*) AS count_pair FROM (SELECT max(entity) FILTER (n = 1) AS e1, max(entity) FILTER (n = 2) AS e2
        FROM ({_NUM}) WHERE total >= 2 AND n <= 2 GROUP BY patient_resource_id) GROUP BY 1, 2""",
)(
    lambda t: ST.study_d(H.source(t), keep=lazily)["pair_statistics"].select(
        "entity_or_parent_1", "entity_or_parent_2", "count_pair"
    )
)

query(
    "study_d_timing_signs",
    f"""SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS valid, 0 AS negative, count(*) FILTER (a = b) AS zero, count(*) FILTER (b > a) AS positive
        FROM (SELECT max(ad) FILTER (n = 1) AS a, max(ad) FILTER (n = 2) AS b FROM ({_NUM}) WHERE total >= 2 AND n <= 2 GROUP BY patient_resource_id)""",
)(lambda t: ST.study_d(H.source(t), keep=lazily)["timing_signs"])

# Prostate ---------------------------------------------------------------------------------------

C61_SQL = f"""SELECT condition_id, ad, age_at_diagnosis, gleason_score, CASE WHEN age_at_diagnosis < 65 AND gleason_score >= 8 THEN 1 ELSE 0 END AS cohort_flag, metastasis_loc
    FROM (SELECT * FROM ({CLEAN_SQL.replace("AND icd10_code NOT LIKE 'C44%'", "AND icd10_code LIKE 'C61%'")}))
    LEFT JOIN (SELECT * FROM ({GLEASON_SQL}) QUALIFY row_number() OVER (PARTITION BY g_condition ORDER BY gleason_date ASC NULLS LAST, g_id) = 1) ON g_condition = condition_id
    LEFT JOIN (SELECT * FROM ({SITE_DAYS_SQL}) QUALIFY row_number() OVER (PARTITION BY m_condition ORDER BY metastasis_date ASC NULLS LAST, metastasis_loc) = 1) ON m_condition = condition_id"""
query("study_pca_base", f"SELECT condition_id, age_at_diagnosis, gleason_score, cohort_flag, metastasis_loc FROM ({C61_SQL})")(
    lambda t: ST.prostate_base(H.source(t)).select(
        "condition_id", "age_at_diagnosis", "gleason_score", "cohort_flag", "metastasis_loc"
    )
)

_THERAPIES = f"""SELECT reason_reference, 'OP' AS kind, string_agg(therapy_id, '| ' ORDER BY therapy_id) AS therapy_id, therapy_start_date AS start FROM ({VQ.SURGERY_SQL}) GROUP BY reason_reference, subject_reference, therapy_start_date
    UNION ALL SELECT reason_reference, 'ST', therapy_id, therapy_start_date FROM ({VQ.RADIO_SQL}) UNION ALL SELECT reason_reference, therapy_type, therapy_id, therapy_start_date FROM ({VQ.SYSTEM_SQL})"""
_DATED = f"""SELECT condition_id, cohort_flag, kind, therapy_id, round({months('cast(start as date)', 'ad')}, 2) AS diff FROM (SELECT DISTINCT condition_id, ad, cohort_flag FROM ({C61_SQL})) JOIN ({_THERAPIES}) ON reason_reference = condition_id"""
_SEQ = f"SELECT *, row_number() OVER (PARTITION BY condition_id ORDER BY diff NULLS FIRST, therapy_id, kind) AS n FROM ({_DATED})"
query(
    "study_pca_sequences",
    "SELECT condition_id, "
    + ", ".join(f"max(kind) FILTER (n = {i}) AS therapy_type_{i}" for i in range(1, 11))
    + f" FROM (SELECT DISTINCT condition_id FROM ({C61_SQL})) LEFT JOIN ({_SEQ}) USING (condition_id) GROUP BY 1",
)(
    lambda t: ST.study_pca(H.source(t), keep=lazily)["therapy_sequence"].select(
        "condition_id", *[f"therapy_type_{i}" for i in range(1, 11)]
    )
)
query(
    "study_pca_first_line_combinations",
    f"""SELECT combo_label, count(*) AS "count" FROM (SELECT condition_id, string_agg(DISTINCT kind, '+' ORDER BY kind) AS combo_label
        FROM ({_DATED}) WHERE cohort_flag = 0 AND diff BETWEEN 0 AND 4 GROUP BY 1) GROUP BY 1""",
)(lambda t: ST.study_pca(H.source(t), keep=lazily)["therapy_combinations_rest"])

# Leukaemia --------------------------------------------------------------------------------------

LIST_SQL = "SELECT DISTINCT concat('C', lpad(cast(s_suppkey % 97 as varchar), 2, '0'), '.', s_suppkey % 10) AS icd_code FROM supplier WHERE s_suppkey % 97 BETWEEN 90 AND 95"


def code_list(t):
    return t.supplier.where("s_suppkey % 97 BETWEEN 90 AND 95").selectExpr(
        "concat('C', lpad(cast(s_suppkey % 97 as string), 2, '0'), '.', s_suppkey % 10) AS icd_code"
    )


LISTED_SQL = f"SELECT condition_id, condition_patient_resource_id AS ref FROM ({VQ.CONDITION_SQL}) WHERE icd10_code IN ({LIST_SQL})"


def registry_tables(t):
    return LK.registry_part(H.source(t), code_list(t), None, "urn:mrn")


query(
    "leukaemia_tumour_conditions",
    f"SELECT condition_id, ref AS condition_patient_reference, c_name AS patient_mrn FROM ({LISTED_SQL}) LEFT JOIN customer ON ref = concat('Patient/', c_custkey)",
)(
    lambda t: registry_tables(t)["tumour_conditions"].select("condition_id", "condition_patient_reference", "patient_mrn")
)
query(
    "leukaemia_ecog",
    f"SELECT observation_id, ecog_performance_status, c_name AS patient_mrn FROM ({VQ.ECOG_SQL}) LEFT JOIN customer ON observation_patient_reference = concat('Patient/', c_custkey) WHERE observation_patient_reference IN (SELECT ref FROM ({LISTED_SQL}))",
)(lambda t: registry_tables(t)["ecog"].select("observation_id", "ecog_performance_status", "patient_mrn"))
query(
    "leukaemia_procedures",
    f"SELECT procedure_id, procedure_ops_code, c_name AS patient_mrn FROM ({VQ.OPS_SQL}) LEFT JOIN customer ON procedure_patient_reference = concat('Patient/', c_custkey) WHERE procedure_condition_reference IN (SELECT condition_id FROM ({LISTED_SQL}))",
)(lambda t: registry_tables(t)["tumour_procedures"].select("procedure_id", "procedure_ops_code", "patient_mrn"))


def ops_book(t):
    return t.nation.selectExpr(f"{H.pick('n_nationkey', H.OPS_CODES)} AS code", f"concat('title ', {H.pick('n_nationkey', H.OPS_CODES)}) AS title").where("code <> '6-001.a'")


def hospital_tables(t):
    return LK.hospital_part(H.source(t), registry_tables(t), code_list(t), "urn:mrn", ops_book(t))


query(
    "leukaemia_encounters",
    f"""SELECT cast(event_id as varchar) AS encounter_id, c_name AS patient_mrn FROM events JOIN customer ON c_custkey = user_id WHERE concat('Patient/', user_id) IN (SELECT ref FROM ({LISTED_SQL}))""",
)(lambda t: hospital_tables(t)["encounters"].select("encounter_id", "patient_mrn"))

query(
    "leukaemia_patients",
    f"""WITH vs AS (SELECT observation_patient_reference AS r, max({start_of('"effective_dateTime"')}) FILTER (vitalstatus_code = 'T') AS dead, max({start_of('"effective_dateTime"')}) FILTER (vitalstatus_code = 'L') AS alive
            FROM ({VQ.VITAL_SQL}) GROUP BY 1), reg AS (SELECT {CQ.DEAD} AS r, max({start_of('date_death')}) AS d FROM ({VQ.DEATH_CAUSES_SQL}) GROUP BY 1)
        SELECT condition_id, c_name AS patient_mrn, cast(coalesce(dead, d, CASE WHEN c_custkey % 7 = 0 THEN date '2003-05-01' END) as varchar) AS died, cast(alive as varchar) AS last_seen,
            coalesce(dead, d) IS NOT NULL OR c_custkey % 7 = 0 OR c_custkey % 5 = 0 AS deceased
        FROM ({LISTED_SQL}) l JOIN customer ON ref = concat('Patient/', c_custkey) LEFT JOIN vs ON vs.r = ref LEFT JOIN reg ON reg.r = ref""",
)(
    lambda t: hospital_tables(t)["patients"].select(
        "condition_id",
        "patient_mrn",
        F.col("deceased_dateTime").cast("date").cast("string").alias("died"),
        F.col("last_follow_up_datetime").cast("date").cast("string").alias("last_seen"),
        "deceased",
    )
)

query(
    "leukaemia_unmapped_ops_codes",
    f"""SELECT DISTINCT procedure_ops_version, procedure_ops_code FROM ({VQ.SERVER_PROCEDURE_SQL}) WHERE procedure_ops_code = '6-001.a'
        AND procedure_patient_reference IN (SELECT ref FROM ({LISTED_SQL}))""",
)(lambda t: hospital_tables(t)["unmapped_ops_codes"])

query(
    "medication_catalogue",
    f"""SELECT cast(p_partkey as varchar) AS medication_id, {H.PART_ATC} AS medication_atc_code, CASE WHEN p_partkey % 5 < 3 THEN concat('atc ', {H.PART_ATC}) ELSE p_name END AS medication_display
        FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE NOT ({H.INLINE})) OR p_partkey IN (SELECT event_id % 50 FROM events)""",
)(
    lambda t: LK.medication_catalogue(
        H.medication_request(t),
        H.medication_statement(t),
        H.medication_administration(t),
        H.medication(t),
        V.patient_mrns(H.patient(t), "urn:mrn"),
        t.part.where("p_partkey % 5 < 3").selectExpr(f"{H.PART_ATC} AS atc_code", f"concat('atc ', {H.PART_ATC}) AS title"),
        ops_book(t),
    )["medications"].select("medication_id", "medication_atc_code", "medication_display")
)

query(
    "medication_catalogue_events",
    f"""SELECT type, count(*) AS n, count(patient_mrn) AS n_mrn FROM (SELECT 'MedicationRequest' AS type, concat('Patient/', user_id) AS ref FROM events
            UNION ALL SELECT 'MedicationAdministration', concat('Patient/', user_id) FROM events UNION ALL SELECT 'MedicationStatement', {H.OBS_PATIENT} FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem))
        LEFT JOIN (SELECT concat('Patient/', c_custkey) AS r, c_name AS patient_mrn FROM customer) ON r = ref GROUP BY 1""",
)(
    lambda t: LK.medication_catalogue(
        H.medication_request(t),
        H.medication_statement(t),
        H.medication_administration(t),
        H.medication(t),
        V.patient_mrns(H.patient(t), "urn:mrn"),
        t.part.selectExpr(f"{H.PART_ATC} AS atc_code", "p_name AS title"),
        ops_book(t),
    )["medication_events"]
    .groupBy("type")
    .agg(F.count(F.lit(1)).alias("n"), F.count("patient_mrn").alias("n_mrn"))
)


def summary(t):
    people = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
        "concat('Patient/', o_custkey) AS condition_patient_reference",
        f"{H.RECORDED} AS diagnosis_recordedDate",
        f"{H.BIRTHDATE} AS birth_date",
        f"{H.GENDER} AS gender",
        "concat('C92.', o_orderkey % 5) AS icd_code",
    )
    obs = H.observation(t)
    classes = V.patient_classifications(obs).withColumnRenamed("observation_patient_reference", "patient_mrn")
    return LK.summary(people, V.labs(obs), V.ecog_status(obs), classes)


query(
    "summary_eln",
    """WITH e AS (SELECT pat, code FROM (SELECT pat, code, id, row_number() OVER (PARTITION BY pat ORDER BY seen DESC NULLS LAST, id, code) AS rn FROM ("""
    + " UNION ALL ".join(
        f"SELECT {H.OBS_PATIENT} AS pat, {VQ.OBS_KEY} AS id, {start_of(H.OBS_DATE)} AS seen, {code} AS code FROM lineitem WHERE {H.OBS_KIND} = 11 AND {Q} % 3 = 0"
        for code in (H.pick(Q, H.CLASS_CODES), H.pick(Q, ["a", "b"]))
    )
    + """)) WHERE rn = 1) SELECT code AS eln_classification, count(*) AS "count", round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM e GROUP BY 1""",
)(lambda t: summary(t)["eln_distribution"].withColumn("percentage", F.round("percentage", 6)))

query(
    "summary_icd_bins",
    """SELECT icd_bin, count(*) AS "count", round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM (SELECT CASE o_orderkey % 5 WHEN 3 THEN 'C92.3' WHEN 4 THEN 'C92.4' ELSE 'C92.0' END AS icd_bin FROM orders) GROUP BY 1""",
)(lambda t: summary(t)["icd_bin_distribution"].withColumn("percentage", F.round("percentage", 6)))

_PANEL = "CASE ({q}) % 8 WHEN 0 THEN 'leukocytes' WHEN 1 THEN 'platelets' WHEN 2 THEN 'hemoglobin' WHEN 3 THEN 'blasts' WHEN 4 THEN 'macroblasts' WHEN 5 THEN 'normoblasts' WHEN 6 THEN 'pronormoblasts' ELSE 'myeloblasts' END".format(q=Q)
query(
    "summary_lab_panels",
    f"""WITH l AS (SELECT {H.OBS_PATIENT} AS ref, {H.OBS_ID} AS id, {_PANEL} AS panel, {H.pick(Q, H.LAB_UNITS)} AS unit, l_quantity * 1.5 AS v, cast(l_shipdate as date) AS d FROM lineitem WHERE {H.OBS_KIND} = 15 AND {Q} % 5 <> 0),
        n AS (SELECT panel, unit, v, row_number() OVER (PARTITION BY o_orderkey, panel ORDER BY abs(datediff('hour', cast(o_orderdate as timestamp) + INTERVAL 9 HOUR, cast(d as timestamp))), d, id) AS rn
            FROM orders JOIN l ON ref = concat('Patient/', o_custkey))
        SELECT panel AS lab_value, unit, count(*) AS "count", round(avg(v), 6) AS mean FROM n WHERE rn = 1 GROUP BY 1, 2""",
)(lambda t: summary(t)["lab_distribution"].withColumn("mean", F.round("mean", 6)))

# Drug layouts -----------------------------------------------------------------------------------

_BLANKS = ", ".join(
    f"'' AS \"{c}\""
    for c in LK.DRUG_LAYOUT
    if c not in (*LK.CATO_SOURCES, "KIS-Patienten-ID", "Datum", "Zeit", "Herstellungsdatum", "Herstellungszeit")
)
query(
    "cato_layout",
    f"""SELECT strftime(ts, '%d.%m.%Y') AS "Datum", strftime(ts, '%H:%M') AS "Zeit", cast(event_id as varchar) AS "Herstellungs-ID", '' AS "Herstellungsdatum", '' AS "Herstellungszeit",
        CASE WHEN user_id = 0 THEN '' ELSE cast(user_id as varchar) END AS "KIS-Patienten-ID", 'S1' AS "Station", event_type AS "Wirkstoff", '' AS "Dosierung", cast(round(value, 2) as varchar) AS "Dosis", '' AS "Reduktion", {_BLANKS} FROM events""",
)(
    lambda t: LK.cato_layout(
        t.events.selectExpr(
            "date_format(ts, 'dd.MM.yyyy HH:mm') AS `Geplanter Verabreichungszeitpunkt`",
            "cast(event_id as string) AS `Herst.Nr.`",
            "concat('000', user_id) AS `Pat.Nr.`",
            "'S1' AS Station",
            "event_type AS Arzneiform",
            "cast(round(value, 2) as string) AS `Ist-Dosis `",
        )
    )
)

_SHORT = ", ".join(f"'' AS \"{c}\"" for c in LK.SHORT_LAYOUT if c not in ("Wirkstoff", "Dosis", "Herstellungs-ID"))
query(
    "zenzy_layout",
    f"""SELECT regexp_replace(text, '\\r?\\n', '|', 'g') AS "Wirkstoff", '' AS "Dosis", cast(doc_id as varchar) AS "Herstellungs-ID", {_SHORT} FROM documents""",
)(
    lambda t: LK.zenzy_layout(
        t.documents.select(
            F.col("text").alias("Wirkstoff"),
            F.lit(None).cast("string").alias("Dosis"),
            F.col("doc_id").cast("string").alias("Herstellungs-ID"),
            *[F.lit("").alias(c) for c in LK.SHORT_LAYOUT if c not in ("Wirkstoff", "Dosis", "Herstellungs-ID")],
        )
    )
)

# Each document's own text as a letter, with findings that depend on the document around it.
_GENES = ["FLT3", "IDH1", "IDH2", "KIT", "NRAS"]


def _gene(shift: int) -> str:
    return "CASE (doc_id + " + str(shift) + ") % 5 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(_GENES)) + " END"


_REPORT = f"""concat('12/19: NPM1 negativ. 03/20: NPM1 positiv. ', {_gene(0)}, ' positiv, ', {_gene(1)}, ' nicht nachweisbar und ', {_gene(2)}, ' Wildtyp.\\n',
    replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'),
    '\\nZytogenetik am 13.12.19: komplex aberranter Karyotyp. ELN-Risiko: ungünstig. Karyotyp {"x" * 400}. TP53 {"y" * 400} negativ.')"""


def reports(t):
    return t.documents.selectExpr(
        f"concat('<section id=\"M5_Therapie\"><content>', {_REPORT}, '</content></section>') AS xmldocument",
        "doc_id AS patid",
        "'A' AS patientaccountid",
        "'2021-05-01' AS lastsaveddatetime",
        "'final' AS letterstatus",
        "source AS templatename",
    )


query(
    "letter_study_genes",
    "SELECT cast(doc_id as varchar) AS patient_mrn, 'NPM1' AS gene, false AS mutated, '2019-12' AS date FROM documents"
    + "".join(f" UNION ALL SELECT cast(doc_id as varchar), {_gene(i)}, {i == 0}, '2021-05-01' FROM documents" for i in range(3)),
)(lambda t: letter_study(reports(t))["genes"].select("patient_mrn", "gene", "mutated", "date"))
query(
    "letter_study_karyotypes",
    "SELECT cast(doc_id as varchar) AS patient_mrn, 'complex_aberrant' AS classification, '2019-12-13' AS date FROM documents",
)(lambda t: letter_study(reports(t))["karyotypes"].select("patient_mrn", "classification", "date"))
query(
    "letter_study_risks",
    "SELECT cast(doc_id as varchar) AS patient_mrn, 'adverse' AS risk_category, '2021-05-01' AS date FROM documents",
)(lambda t: letter_study(reports(t))["eln_risk"].select("patient_mrn", "risk_category", "date"))
query(
    "letter_study_rejected",
    """SELECT concat_ws('_', cast(doc_id as varchar), 'A', '2021-05-01') AS letter_key, kind, problems FROM documents,
        (SELECT 'genes' AS kind, 'gene_evidence' AS problems UNION ALL SELECT 'karyotypes', 'karyotype_text,karyotype_evidence')""",
)(lambda t: letter_study(reports(t))["rejected"].drop("finding"))

query("letter_study_letters", f"SELECT patient_id, therapie_text FROM ({TQ.LETTERS_SQL})")(
    lambda t: letter_study(TQ.documents(t))["letters"].select("patient_id", "therapie_text")
)
