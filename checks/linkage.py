"""Predicates, joins and windows (groups C, D, E) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import shape as H
from checks import views as VQ
from checks.dates import LINES, PEOPLE_SQL, lines, people, strings
from checks.registry import query
from cohortloom.functions import dates as D
from cohortloom.operators import linkage as L
from cohortloom.operators import nearest as N
from cohortloom.operators import ordering as O
from cohortloom.operators import predicates as PR
from cohortloom.operators import stats as S
from cohortloom.operators import views as V

Q = H.Q
LINE_ID = H.OBS_ID

# Predicates -------------------------------------------------------------------------------------

query("filter_primary_diagnosis", VQ.CONDITION_SQL + " WHERE o_orderkey % 4 <> 0")(
    lambda t: PR.filter_primary_diagnosis(V.conditions(H.condition(t)))
)

query(
    "filter_icd_codes",
    f"""SELECT o_orderkey, {H.ICD} AS icd10_code FROM orders
        WHERE {H.ICD} IN ('C83.3', 'C83.1') OR regexp_matches({H.ICD}, '^(C90|C91|C92|C93|C94|C95|D46|C82|C85)')""",
)(lambda t: PR.filter_icd_codes(t.orders.selectExpr("o_orderkey", f"{H.ICD} AS icd10_code")))

query(
    "filter_entity_window",
    f"""SELECT o_orderkey, {H.ICD} AS icd10_code, cast(cast(o_orderdate as date) as varchar) AS asserted_date FROM orders
        WHERE (substr({H.ICD}, 1, 3) IN ('C15', 'C18', 'C34', 'C71') OR ({H.ICD} LIKE 'C25%' AND {H.ICD} NOT LIKE 'C25.4%'))
        AND year(o_orderdate) BETWEEN 1996 AND 1999""",
)(
    lambda t: strings(
        PR.filter_entity_window(
            people(t).select("o_orderkey", "icd10_code", "asserted_date"), years=(1996, 1999)
        ),
        "asserted_date",
    )
)

query(
    "clean_conditions",
    f"""SELECT o_orderkey FROM (SELECT *, {H.ICD} AS icd10_code,
            CASE WHEN o_orderkey % 10 = 0 THEN date '1970-07-01' ELSE cast(o_orderdate as date) END AS d
            FROM orders JOIN customer ON c_custkey = o_custkey)
        WHERE d > date '1970-12-31' AND datediff('day', cast({H.BIRTHDATE_DUCK} as date), d) > 1
        AND icd10_code NOT LIKE 'C44%' AND icd10_code NOT LIKE 'D04%'""",
)(
    lambda t: PR.clean_conditions(
        people(t)
        .withColumn(
            "asserted_date",
            F.expr("CASE WHEN o_orderkey % 10 = 0 THEN date'1970-07-01' ELSE asserted_date END"),
        )
        .withColumn("age_at_diagnosis", D.age_at("asserted_date", "birthdate"))
    ).select("o_orderkey")
)

query(
    "drop_exact_placeholders",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 10 NOT IN (0, 1)",
)(
    lambda t: PR.drop_exact_placeholders(
        t.orders.selectExpr(
            "o_orderkey",
            """CASE o_orderkey % 10 WHEN 0 THEN date'1970-07-01' WHEN 1 THEN date'1970-01-01'
                WHEN 2 THEN NULL ELSE cast(o_orderdate as date) END AS d""",
        ),
        "d",
    ).select("o_orderkey")
)

SCORED = f"""SELECT o_orderkey, round(datediff('day', birthdate, asserted_date) / cast(365.25 as double), 2) AS age_at_diagnosis,
    CASE WHEN o_orderkey % 6 < 5 THEN 6 + o_orderkey % 6 END AS gleason_score FROM ({PEOPLE_SQL})"""


def scored(t):
    return people(t).withColumns(
        {
            "age_at_diagnosis": D.age_at("asserted_date", "birthdate"),
            "gleason_score": F.expr("CASE WHEN o_orderkey % 6 < 5 THEN cast(6 + o_orderkey % 6 as int) END"),
        }
    )


query(
    "flag_cohort",
    f"SELECT o_orderkey, CASE WHEN age_at_diagnosis < 65 AND gleason_score >= 8 THEN 1 ELSE 0 END AS cohort_flag FROM ({SCORED})",
)(lambda t: PR.flag_cohort(scored(t)).select("o_orderkey", "cohort_flag"))

query("code_value_in", f"SELECT * FROM ({VQ.STAGING_SQL}) WHERE tnm_value IN ('N0', 'M0')")(
    lambda t: PR.code_value_in(V.tnm_nm_staging(H.observation(t)), "tnm_value", ["N0", "M0"])
)

query(
    "before_after",
    f"""SELECT medication_statement_atc_code, count(DISTINCT CASE WHEN medication_statement_start_date < '1998-04-01' THEN subject_reference END) AS num_patients_before,
        count(DISTINCT CASE WHEN medication_statement_start_date >= '1998-04-01' THEN subject_reference END) AS num_patients_after
        FROM ({VQ.STATEMENT_SQL}) GROUP BY 1""",
)(
    lambda t: PR.before_after(
        V.medication_statements(H.medication_statement(t)),
        ["medication_statement_atc_code"],
        "subject_reference",
        "medication_statement_start_date",
        "1998-04-01",
    )
)

query("has_second_tumour", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 2")(
    lambda t: PR.has_second_tumour(
        t.orders.selectExpr(
            "o_orderkey", "CASE o_orderkey % 3 WHEN 0 THEN ' ' WHEN 2 THEN 'Condition/1' END AS condition_id_2"
        )
    ).select("o_orderkey")
)

query("drop_sentinel", "SELECT event_id FROM events WHERE event_id % 4 > 1")(
    lambda t: PR.drop_sentinel(
        t.events.selectExpr(
            "event_id", "CASE event_id % 4 WHEN 0 THEN '*** VALUE NOT FOUND ***' WHEN 1 THEN NULL ELSE 'p' END AS p"
        ),
        "p",
    ).select("event_id")
)

query(
    "fill_missing_columns",
    "SELECT event_id, event_type, 'FALSCH' AS \"Retoure\", cast(null as varchar) AS \"Protokoll\" FROM events",
)(
    lambda t: PR.fill_missing_columns(
        t.events.select("event_id", "event_type"),
        {"event_type": "never used", "Retoure": "FALSCH", "Protokoll": None},
    )
)

query(
    "classification_is",
    f"""SELECT {VQ.OBS_KEY} AS id FROM lineitem WHERE {H.OBS_KIND} = 11 AND {Q} % 3 = 1""",
)(
    lambda t: V.first_classifications(H.observation(t))
    .where(
        PR.classification_is("weitere_klassifikation_code_text", "weitere_klassifikation_code")
    )
    .select(F.col("observation_id").alias("id"))
)

query(
    "limit_entities",
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT DISTINCT user_id FROM events ORDER BY 1 LIMIT 10)",
)(lambda t: PR.limit_entities(t.events.select("event_id", "user_id"), "user_id", 10))

query(
    "year_slices",
    """SELECT CASE WHEN o_orderdate < timestamp '2000-01-01' THEN '1990-2000' WHEN o_orderdate < timestamp '2010-01-01' THEN '2000-2010' END AS year_slice,
        count(*) AS n FROM orders GROUP BY 1""",
)(
    lambda t: t.orders.groupBy(PR.year_slice("o_orderdate").alias("year_slice")).agg(
        F.count(F.lit(1)).alias("n")
    )
)

# Joins ------------------------------------------------------------------------------------------

# All patients; one in four has a reference that matches nothing.
PATIENTS_SQL = f"""SELECT concat('Patient/', CASE WHEN c_custkey % 4 = 1 THEN -c_custkey ELSE c_custkey END) AS patient_resource_id, c_name AS patid_pseudonym, {H.GENDER} AS gender
    FROM customer"""


def some_patients(t):
    number = "cast(substring(patient_resource_id, 9) as bigint)"
    return V.patients(H.patient(t)).selectExpr(
        f"concat('Patient/', CASE WHEN {number} % 4 = 1 THEN -{number} ELSE {number} END) AS patient_resource_id", "patid_pseudonym", "gender"
    )


def some_conditions(t):
    return V.conditions(H.condition(t)).select(
        "condition_id", "condition_patient_resource_id", "icd10_code"
    )


CONDITIONS_SQL = f"SELECT condition_id, condition_patient_resource_id, icd10_code FROM ({VQ.CONDITION_SQL})"

query(
    "conditions_with_patients",
    f"SELECT * FROM ({CONDITIONS_SQL}) LEFT JOIN ({PATIENTS_SQL}) ON condition_patient_resource_id = patient_resource_id",
)(lambda t: L.conditions_with_patients(some_conditions(t), some_patients(t)))

query(
    "attach_deaths",
    f"SELECT * FROM ({PATIENTS_SQL}) LEFT JOIN ({VQ.DEATHS_SQL}) ON patient_resource_id = observation_death_patient_resource_id",
)(lambda t: L.attach_deaths(some_patients(t), V.deaths(H.observation(t))))

GRADING_SQL = VQ.observation_sql(
    10, {"condition_id": H.OBS_CONDITION, "grading": H.pick(Q, ["1", "2", "3", "4"])}
)


def gradings(t):
    return V.gradings(H.observation(t)).select("condition_id", "grading")


COHORT_SQL = f"SELECT condition_id, icd10_code FROM ({CONDITIONS_SQL}) WHERE icd10_code LIKE 'C6%'"


def cohort(t):
    return some_conditions(t).where(F.col("icd10_code").startswith("C6")).select("condition_id", "icd10_code")


query(
    "attach_to_all_conditions",
    f"SELECT c.condition_id, icd10_code, grading FROM ({GRADING_SQL}) g RIGHT JOIN ({COHORT_SQL}) c ON c.condition_id = g.condition_id",
)(lambda t: L.attach_to_all_conditions(gradings(t), cohort(t), ["condition_id"]))

query(
    "attach_left",
    f"SELECT g.condition_id, grading, icd10_code FROM ({GRADING_SQL}) g LEFT JOIN ({COHORT_SQL}) c ON c.condition_id = g.condition_id",
)(lambda t: L.attach_left(gradings(t), cohort(t), ["condition_id"]))

query(
    "restrict_inner",
    f"SELECT g.condition_id, grading, icd10_code FROM ({GRADING_SQL}) g JOIN ({COHORT_SQL}) c ON c.condition_id = g.condition_id",
)(lambda t: L.restrict_inner(gradings(t), cohort(t), ["condition_id"]))

query(
    "tnm_with_parent",
    f"""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, observation_id, parent_tnm_date, has_member
        FROM (SELECT *, concat('Observation/', l_orderkey, '-', CASE WHEN l_linenumber % 2 = 0 THEN 't' ELSE 'n' END) AS observation_id FROM lineitem) l
        LEFT JOIN ({VQ.TNM_PARENT_SQL}) ON observation_id = has_member""",
)(
    lambda t: L.tnm_with_parent(
        t.lineitem.selectExpr(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "concat('Observation/', l_orderkey, '-', CASE WHEN l_linenumber % 2 = 0 THEN 't' ELSE 'n' END) AS observation_id",
        ),
        V.tnm_parent(H.observation(t)).select("parent_tnm_date", "has_member"),
    )
)

query(
    "cohort_semi",
    f"SELECT {LINE_ID} AS id FROM lineitem WHERE concat('Condition/', l_orderkey) IN (SELECT condition_id FROM ({COHORT_SQL}))",
)(
    lambda t: L.cohort_semi(
        t.lineitem.selectExpr(f"{LINE_ID} AS id", "concat('Condition/', l_orderkey) AS ref"),
        cohort(t),
        "ref",
        "condition_id",
    ).select("id")
)

query(
    "exclude_codes",
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)",
)(
    lambda t: L.exclude_codes(
        t.lineitem.select("l_orderkey", "l_partkey"), t.part.where("p_size > 10"), "l_partkey", "p_partkey"
    ).select("l_orderkey", "l_partkey")
)

query(
    "code_list_join",
    f"SELECT condition_id, icd10_code FROM ({CONDITIONS_SQL}) WHERE icd10_code IN (SELECT concat('C', lpad(cast(s_suppkey % 97 as varchar), 2, '0'), '.', s_suppkey % 10) FROM supplier)",
)(
    lambda t: L.code_list_join(
        some_conditions(t).select("condition_id", "icd10_code"),
        t.supplier.selectExpr("concat('C', lpad(cast(s_suppkey % 97 as string), 2, '0'), '.', s_suppkey % 10) AS code"),
        "icd10_code",
        "code",
    )
)

RESOLVED_SQL = f"""SELECT medication_statement_id, reason_reference, subject_reference, part_of_reference, medication_statement_start_date,
    coalesce(medication_statement_text, medication_medication_text) AS medication_statement_text,
    coalesce(medication_statement_atc_code, medication_medication_atc_code) AS medication_statement_atc_code, medication_reference
    FROM ({VQ.STATEMENT_SQL}) LEFT JOIN ({VQ.MEDICATION_SQL}) ON medication_reference = medication_id"""


def resolved(t):
    return L.resolve_medication(
        V.medication_statements(H.medication_statement(t)), V.medications(H.medication(t))
    )


query("resolve_medication", RESOLVED_SQL)(resolved)

query(
    "parent_child_join",
    f"""SELECT therapy_id, therapy_type, s.reason_reference, medication_statement_text, m.part_of_reference, m.reason_reference AS child_reason_reference
        FROM ({VQ.SYSTEM_SQL}) s LEFT JOIN ({RESOLVED_SQL}) m ON therapy_id = m.part_of_reference""",
)(
    lambda t: L.parent_child_join(
        V.system_therapy_procedures(H.procedure(t)).select("therapy_id", "therapy_type", "reason_reference"),
        resolved(t).select("part_of_reference", "reason_reference", "medication_statement_text"),
        "therapy_id",
        "part_of_reference",
    )
)

# Nearest and interval ---------------------------------------------------------------------------

NEAREST_SQL = f"""SELECT o_orderkey, id, strftime(ship_date, '%Y-%m-%d') AS ship_date_first FROM
    (SELECT o_orderkey, id, ship_date, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(datediff('day', od, ship_date)), ship_date, id) AS rn
        FROM (SELECT o_orderkey, cast(o_orderdate as date) AS od FROM orders)
        LEFT JOIN (SELECT l_orderkey, {LINE_ID} AS id, cast(l_shipdate as date) AS ship_date FROM lineitem) ON l_orderkey = o_orderkey)
    WHERE rn = 1"""


def dated_orders(t):
    return t.orders.selectExpr("o_orderkey", "cast(o_orderdate as date) AS od")


def dated_lines(t):
    return t.lineitem.selectExpr(
        "l_orderkey AS o_orderkey", f"{LINE_ID} AS id", "cast(l_shipdate as date) AS ship_date"
    )


query("nearest_event", NEAREST_SQL)(
    lambda t: strings(
        N.nearest_event(dated_orders(t), dated_lines(t), "o_orderkey", "od", "ship_date", "id").select(
            "o_orderkey", "id", "ship_date_first"
        ),
        "ship_date_first",
    )
)

# Times as records write them: days and months in two forms, years, instants, and times of day alone,
# which never match. The SQL knows the first and last day of each.
def written_lines(t):
    ship = F.col("l_shipdate").cast("date")
    which = F.col("l_linenumber") + F.col("l_orderkey") % 7
    forms = ["yyyy-MM-dd", "dd.MM.yyyy", "yyyy-MM", "MM.yyyy", "yyyy", "HH:mm", "dd.MM.yyyy HH:mm"]
    text = F.coalesce(*[F.when(which % 7 == i, F.date_format(ship, f)) for i, f in enumerate(forms)])
    return t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.expr(LINE_ID).alias("id"), text.alias("seen"))


WRITTEN_SQL = f"""SELECT l_orderkey, {LINE_ID} AS id, ship AS day, (l_linenumber + l_orderkey % 7) % 7 AS form,
        CASE WHEN form IN (0, 1, 6) THEN ship WHEN form IN (2, 3) THEN date_trunc('month', ship)::date WHEN form = 4 THEN date_trunc('year', ship)::date END AS a,
        CASE WHEN form IN (0, 1, 6) THEN ship WHEN form IN (2, 3) THEN last_day(ship) WHEN form = 4 THEN make_date(year(ship)::int, 12, 31) END AS z,
        CASE form WHEN 0 THEN strftime(ship, '%Y-%m-%d') WHEN 1 THEN strftime(ship, '%d.%m.%Y') WHEN 2 THEN strftime(ship, '%Y-%m') WHEN 3 THEN strftime(ship, '%m.%Y')
            WHEN 4 THEN strftime(ship, '%Y') WHEN 6 THEN strftime(ship, '%d.%m.%Y 00:00') END AS seen
    FROM (SELECT *, cast(l_shipdate AS date) AS ship FROM lineitem)"""


def nearest_written_sql(distance: str) -> str:
    return f"""SELECT o_orderkey, id, seen AS seen_first FROM (SELECT o_orderkey, id, seen, row_number() OVER (PARTITION BY o_orderkey ORDER BY {distance}, abs(datediff('day', od, a)), a, id) AS rn
        FROM (SELECT o_orderkey, cast(o_orderdate AS date) AS od FROM orders) LEFT JOIN (SELECT * FROM ({WRITTEN_SQL}) WHERE form <> 5) ON l_orderkey = o_orderkey) WHERE rn = 1"""


query("nearest_event_written_times", nearest_written_sql("0"))(
    lambda t: N.nearest_event(dated_orders(t), written_lines(t), "o_orderkey", "od", "seen", "id").select("o_orderkey", "id", "seen_first")
)

query("nearest_per_key_written_times", nearest_written_sql("0"))(
    lambda t: N.nearest_per_key(dated_orders(t), written_lines(t), "o_orderkey", "od", "seen", "id").select("o_orderkey", "id", "seen_first")
)

# Gaps between whole days: what both cover is 0 apart, an instant at midnight ends with the day before.
GAP = """CASE WHEN a IS NULL THEN NULL WHEN form = 6 AND a > od THEN (a - od - 1) * 86400000000 + 1
    WHEN form = 6 AND a <= od THEN (od - a) * 86400000000 WHEN a > od THEN (a - od - 1) * 86400000000 + 1 WHEN z < od THEN (od - z - 1) * 86400000000 + 1 ELSE 0 END"""
query("nearest_per_key_by_gap", nearest_written_sql(GAP))(
    lambda t: N.nearest_per_key(dated_orders(t), written_lines(t), "o_orderkey", "od", "seen", "id", by="gap").select("o_orderkey", "id", "seen_first")
)

# Several base rows per key: each sees its own nearest event. All events of a supplier share a key.
query(
    "nearest_event_many_bases",
    """SELECT event_id, (SELECT min(struct_pack(d := abs(epoch_us(e.ts) - epoch_us(s.ts)), t := s.ts, i := s.event_id)) FROM events s
            WHERE s.user_id = e.user_id AND s.event_type = 'signup').i AS nearest_id
        FROM events e WHERE event_type = 'purchase'""",
)(
    lambda t: N.nearest_event(
        t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"),
        t.events.where("event_type = 'signup'").select(
            "user_id", F.col("event_id").alias("nearest_id"), F.col("ts").alias("seen")
        ),
        "user_id",
        "ts",
        "seen",
        "nearest_id",
        slice_days=3,
    ).select("event_id", "nearest_id")
)

query(
    "nearest_staging_patients",
    f"""WITH c AS (SELECT o_orderkey, cast(o_orderdate as date) AS od FROM orders),
        s AS (SELECT l_orderkey, l_returnflag, {LINE_ID} AS id, cast(l_shipdate as date) AS sd, {H.OBS_PATIENT} AS patient_id FROM lineitem),
        n AS (SELECT s.*, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(datediff('day', od, sd)), sd, id) AS rn FROM c JOIN s ON l_orderkey = o_orderkey)
        SELECT l_returnflag AS stage, count(DISTINCT patient_id) AS num_patients FROM n WHERE rn = 1 GROUP BY 1""",
)(
    lambda t: S.distinct_patients_by(
        N.nearest_per_key(
            dated_orders(t),
            t.lineitem.selectExpr(
                "l_orderkey AS o_orderkey",
                "l_returnflag AS stage",
                f"{LINE_ID} AS id",
                "cast(l_shipdate as date) AS ship_date",
                f"{H.OBS_PATIENT} AS patient_id",
            ),
            "o_orderkey",
            "od",
            "ship_date",
            "id",
            how="inner",
        ),
        ["stage"],
        "patient_id",
    )
)

query(
    "labs_in_treatment_window",
    """WITH w AS (SELECT user_id, min(ts) - INTERVAL 2 DAY AS a, max(ts) + INTERVAL 2 DAY AS b FROM events
            WHERE event_type = 'purchase' GROUP BY 1)
        SELECT e.event_id, e.user_id FROM events e JOIN w ON e.user_id = w.user_id WHERE ts BETWEEN a AND b AND event_type <> 'purchase'""",
)(
    lambda t: N.in_treatment_window(
        t.events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts"),
        t.events.where("event_type = 'purchase'").select("user_id", "ts"),
        "user_id",
        "ts",
        "ts",
        days=2,
    ).select("event_id", "user_id")
)

# Record numbers ---------------------------------------------------------------------------------

MRN_SQL = "SELECT concat('Patient/', user_id) AS ref, concat('M', event_id % 3) AS mrn FROM events WHERE user_id % 5 <> 0 OR event_id % 3 = 0"


def mrns(t):
    return t.events.where("user_id % 5 <> 0 OR event_id % 3 = 0").selectExpr(
        "concat('Patient/', user_id) AS ref", "concat('M', event_id % 3) AS mrn"
    )


query(
    "lookup_first_mrn",
    f"""SELECT event_id, concat('Patient/', user_id) AS patient_reference, mrn FROM events
        LEFT JOIN (SELECT ref, min(mrn) AS mrn FROM ({MRN_SQL}) GROUP BY 1) ON ref = concat('Patient/', user_id)""",
)(
    lambda t: L.lookup_first_mrn(
        t.events.selectExpr("event_id", "concat('Patient/', user_id) AS patient_reference"),
        mrns(t),
        "patient_reference",
        "ref",
        "mrn",
    )
)

query(
    "mrn_conflicts",
    f"SELECT ref, min(mrn) AS mrn, count(DISTINCT mrn) AS n_mrns FROM ({MRN_SQL}) GROUP BY 1 HAVING count(DISTINCT mrn) > 1",
)(lambda t: L.mrn_conflicts(mrns(t), "ref", "mrn"))

query(
    "link_by_mrn",
    """SELECT event_id, concat('Patient/', user_id) AS patient_id_prefixed, cast(user_id as varchar) AS mrn, c_mktsegment
        FROM events LEFT JOIN customer ON c_custkey * 2 = user_id""",
)(
    lambda t: L.link_by_mrn(
        t.events.selectExpr("event_id", "cast(user_id as string) AS mrn"),
        t.customer.selectExpr("concat('Patient/', c_custkey * 2) AS pseudonym", "c_mktsegment"),
        "mrn",
        "pseudonym",
    )
)

query(
    "link_by_reference",
    """SELECT o_orderkey, o_custkey, event_id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)
        LEFT JOIN (SELECT user_id, event_id FROM events WHERE event_type = 'error') ON user_id = o_custkey WHERE n = 1""",
)(
    lambda t: L.link_by_reference(
        O.top_per_key(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], [F.col("o_orderkey")], 2, rank_as="n"),
        t.events.where("event_type = 'error'").select("user_id", "event_id"),
        "o_custkey",
        "user_id",
        "n",
    ).drop("n")
)

query(
    "display_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_name AS label FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size < 40",
)(
    lambda t: L.display_lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
        t.part.where("p_size < 40"),
        "l_partkey",
        "p_partkey",
        "p_name",
        "label",
    )
)

query(
    "unmapped_codes",
    "SELECT DISTINCT l_returnflag, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)",
)(
    lambda t: L.unmapped_codes(
        t.lineitem, t.part.where("p_size < 40"), ["l_returnflag", "l_partkey"], "l_partkey", "p_partkey"
    )
)

query(
    "matched_subset",
    """SELECT event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_name IN
        (SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT'))""",
)(
    lambda t: L.matched_subset(
        t.events.select("event_id", "user_id"),
        t.customer.select("c_custkey", "c_name"),
        t.orders.where("o_orderpriority = '1-URGENT'")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name"),
        "user_id",
        "c_custkey",
        "c_name",
        "c_name",
    ).select("event_id")
)

query(
    "match_report",
    """SELECT (SELECT count(*) FROM customer) AS n_patients, (SELECT count(DISTINCT user_id) FROM events) AS n_drug_patients,
        (SELECT count(*) FROM customer WHERE c_custkey IN (SELECT user_id FROM events)) AS n_matched""",
)(lambda t: L.match_report(t.customer, t.events, "c_custkey", "user_id"))

query("dup_members", "SELECT o_orderkey, o_custkey FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n > 1")(
    lambda t: O.dup_members(t.orders.select("o_orderkey", "o_custkey"), "o_custkey")
)

query("column_bind", "SELECT event_id, event_type, user_id * 2 AS doubled FROM events")(
    lambda t: L.column_bind(
        t.events.select("event_id", "event_type"),
        t.events.selectExpr("event_id", "user_id * 2 AS doubled"),
        "event_id",
        ["doubled"],
    )
)

query(
    "pair_self_join",
    """WITH n AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
        SELECT a.o_custkey, a.o_orderkey AS o_orderkey_1, b.o_orderkey AS o_orderkey_2, a.o_orderpriority AS o_orderpriority_1, b.o_orderpriority AS o_orderpriority_2
        FROM n a JOIN n b ON a.o_custkey = b.o_custkey AND a.n = 1 AND b.n = 2""",
)(
    lambda t: L.pair_self_join(
        O.top_per_key(
            t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"),
            ["o_custkey"],
            [F.col("o_orderdate"), F.col("o_orderkey")],
            2,
            rank_as="n",
        ),
        "o_custkey",
        "n",
        ["o_orderkey", "o_orderpriority"],
    )
)

query(
    "drop_duplicates_by",
    "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2",
)(
    lambda t: L.drop_duplicates_by(
        t.events.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"]
    )
)

# Ordering ---------------------------------------------------------------------------------------

query(
    "first_per_key",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END ASC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)(
    lambda t: O.first_per_key(
        t.orders.selectExpr("o_custkey", "o_orderkey", "CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS d"),
        ["o_custkey"],
        "d",
        ["o_orderkey"],
    ).drop("d")
)

query(
    "keep_first_sorted",
    """SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
        ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)(
    lambda t: O.keep_first_sorted(
        t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate"),
        ["o_custkey", "o_orderpriority"],
        "o_orderdate",
        ["o_orderkey"],
    ).drop("o_orderdate")
)

query(
    "first_with_ties",
    f"""SELECT * FROM ({VQ.DEATH_CAUSES_SQL}) WHERE date_death IS NOT NULL
        QUALIFY rank() OVER (PARTITION BY observation_death_patient_resource_id ORDER BY date_death, observation_resource_id) = 1""",
)(
    lambda t: O.first_event_with_ties(
        V.deaths(H.observation(t), every_cause=True),
        "observation_death_patient_resource_id",
        "date_death",
        "observation_resource_id",
    )
)

query(
    "latest_per_key",
    """SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, round(arg_max(value, ts), 4) AS value FROM events GROUP BY 1, 2""",
)(
    lambda t: O.latest_per_key(
        t.events.selectExpr("user_id", "event_type", "event_id", "round(value, 4) AS value", "ts"),
        ["user_id", "event_type"],
        "ts",
        ["event_id"],
    ).drop("ts")
)

query(
    "multi_flag",
    """SELECT o_orderkey, CASE WHEN count(k) OVER (PARTITION BY k) > 1 THEN 1 ELSE 0 END AS double_patid
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey * 10 + o_orderkey % 10 END AS k FROM orders)""",
)(
    lambda t: O.multi_flag(
        t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 7 > 0 THEN o_custkey * 10 + o_orderkey % 10 END AS k"), "k"
    ).drop("k")
)

_GAP = "(12 * (year(d) - year(p)) + month(d) - month(p) + CASE WHEN day(d) = day(p) OR (last_day(d) = d AND last_day(p) = p) THEN 0 ELSE (day(d) - day(p)) / cast(31 as double) END)"
query(
    "number_malignancies",
    f"""SELECT o_orderkey, malignancy_number, cast(p as varchar) AS date_prev, round({_GAP} / 12, 2) AS years_between, round({_GAP}, 1) AS months_between FROM
        (SELECT o_orderkey, d, row_number() OVER w AS malignancy_number, lag(d) OVER w AS p
            FROM (SELECT o_orderkey, o_custkey, cast(o_orderdate as date) AS d FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY d, o_orderkey))""",
)(
    lambda t: strings(
        O.number_malignancies(
            t.orders.selectExpr("o_orderkey", "o_custkey", "cast(o_orderdate as date) AS d"), "o_custkey", "d", "o_orderkey"
        ).drop("o_custkey", "d"),
        "date_prev",
    )
)

query(
    "share_within_group",
    """SELECT o_orderpriority, o_orderstatus, n, round(n / sum(n) OVER (PARTITION BY o_orderpriority) * 100.0, 6) AS percentage
        FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)""",
)(
    lambda t: O.share_within_group(
        t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")), ["o_orderpriority"]
    ).withColumn("percentage", F.round("percentage", 6))
)

query(
    "running_count",
    f"""SELECT days AS v, n, cast(sum(n) OVER (ORDER BY days) as bigint) AS cumulative FROM
        (SELECT cast(datediff('day', asserted_date, ship_date) as bigint) AS days, count(*) AS n FROM ({LINES}) GROUP BY 1)""",
)(
    lambda t: O.running_count(
        lines(t).select(D.days_between("ship_date", "asserted_date").cast("bigint").alias("v")), "v"
    )
)

query(
    "running_count_by_group",
    """SELECT o_orderpriority, o_orderdate::date::varchar AS d, n, cast(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) as bigint) AS cumulative
        FROM (SELECT o_orderpriority, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2)""",
)(
    lambda t: strings(
        O.running_count(t.orders.selectExpr("o_orderpriority", "cast(o_orderdate as date) AS d"), "d", ["o_orderpriority"]), "d"
    )
)
