"""Deaths, tumours and therapies (operators H1 to H20) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import linkage as LQ
from checks import shape as H
from checks import views as VQ
from checks.dates import PEOPLE_SQL, months, people, stamps, strings
from checks.registry import query
from cohortloom.functions import codes as C
from cohortloom.functions import dates as D
from cohortloom.operators import deaths as DE
from cohortloom.operators import ordering as O
from cohortloom.operators import therapies as T
from cohortloom.operators import tumours as TU
from cohortloom.operators import views as V

Q = H.Q

# Deaths -----------------------------------------------------------------------------------------

DEAD = "observation_death_patient_resource_id"
CONSOLIDATED_SQL = f"""WITH causes AS (
        SELECT {DEAD}, death_cause_icd10, date_death, min(observation_resource_id) AS obs,
            arg_min(death_cause_tumor, observation_resource_id) AS tumour
        FROM ({VQ.DEATH_CAUSES_SQL}) GROUP BY ALL),
    fixed AS (SELECT *, CASE WHEN death_cause_icd10 LIKE 'C%' AND tumour IN ('U', 'N') THEN 'J' ELSE tumour END AS flag FROM causes)
    SELECT {DEAD}, min(date_death) AS date_death, min(obs) AS observation_resource_id,
        arg_min(flag, (obs, flag)) AS death_cause_tumor, string_agg(DISTINCT death_cause_icd10, '|' ORDER BY death_cause_icd10) AS death_cause_icd10
    FROM fixed GROUP BY 1"""


def consolidated(t):
    return DE.consolidate_deaths(V.deaths(H.observation(t), every_cause=True))


query("consolidate_deaths", CONSOLIDATED_SQL)(consolidated)

query(
    "tumour_flag_fixes",
    f"SELECT count(*) AS n_fixed FROM ({VQ.DEATHS_SQL}) WHERE death_cause_icd10 LIKE 'C%' AND death_cause_tumor IN ('U', 'N')",
)(lambda t: DE.tumour_flag_fixes(V.deaths(H.observation(t))))

query(
    "is_deceased",
    f"""SELECT concat('Patient/', c_custkey) AS patient_resource_id,
        c_custkey % 5 = 0 OR c_custkey % 7 = 0 OR d.{DEAD} IS NOT NULL AS is_deceased
        FROM customer LEFT JOIN ({CONSOLIDATED_SQL}) d ON d.{DEAD} = concat('Patient/', c_custkey)""",
)(
    lambda t: DE.is_deceased(
        V.patients(H.patient(t)).join(
            consolidated(t).withColumnRenamed(DEAD, "patient_resource_id"), "patient_resource_id", "left"
        )
    ).select("patient_resource_id", "is_deceased")
)

query(
    "death_precedence",
    """WITH reg AS (SELECT user_id, max(date_trunc('day', ts)) AS d, arg_max(event_type, (date_trunc('day', ts), event_type)) AS cause
            FROM events WHERE event_type IN ('error', 'view') GROUP BY 1),
        vs AS (SELECT user_id, max(CASE WHEN event_id % 20 = 0 THEN date_trunc('day', ts) END) AS dead,
            max(CASE WHEN event_id % 20 <> 0 THEN date_trunc('day', ts) END) AS alive FROM events WHERE event_type = 'click' GROUP BY 1)
        SELECT c_custkey, strftime(coalesce(dead, d, CASE WHEN c_custkey % 7 = 0 THEN timestamp '2003-05-01' END), '%Y-%m-%d %H:%M:%S') AS "deceased_dateTime",
            coalesce(dead, d, CASE WHEN c_custkey % 7 = 0 THEN timestamp '2003-05-01' END) IS NOT NULL OR c_custkey % 5 = 0 AS deceased,
            CASE WHEN d IS NOT NULL THEN 'J' END AS death_caused_by_tumor, cause AS cause_of_death,
            strftime(alive, '%Y-%m-%d %H:%M:%S') AS last_follow_up_datetime
        FROM customer LEFT JOIN reg ON reg.user_id = c_custkey LEFT JOIN vs ON vs.user_id = c_custkey""",
)(
    lambda t: stamps(
        DE.death_precedence(
            t.customer.selectExpr(
                "c_custkey",
                "cast(c_custkey as string) AS patient_mrn",
                f"{H.DECEASED} AS deceased_boolean",
                f"{H.DECEASED_AT} AS deceased_dateTime",
            ),
            t.events.where("event_type IN ('error', 'view')").selectExpr(
                "cast(user_id as string) AS patient_mrn",
                "date_format(ts, 'yyyy-MM-dd') AS death_dateTime",
                "'J' AS death_caused_by_tumor",
                "event_type AS cause_of_death",
            ),
            t.events.where("event_type = 'click'").selectExpr(
                "cast(user_id as string) AS patient_mrn",
                "date_format(ts, 'yyyy-MM-dd') AS effective_dateTime",
                "CASE WHEN event_id % 20 = 0 THEN 'T' ELSE 'L' END AS vitalstatus_code",
            ),
        ).drop("patient_mrn", "deceased_boolean"),
        "deceased_dateTime",
        "last_follow_up_datetime",
    )
)

# Tumours ----------------------------------------------------------------------------------------

ENTITY_CASES = " ".join(
    f"WHEN parent BETWEEN '{lo}' AND '{hi}' THEN '{lo if lo == hi else lo + '-' + hi}'" for lo, hi in C.ENTITY_GROUPS
)
LABEL_CASES = " ".join(
    f"WHEN cast(substr(icd10_code, 2, 2) as int) BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in C.ENTITY_LABELS
)
TUMOURS_SQL = f"""SELECT p.*, round(datediff('day', birthdate, asserted_date) / cast(365.25 as double), 2) AS age_at_diagnosis,
    split_part(icd10_code, '.', 1) AS parent, {H.GENDER.replace('c_custkey', 'o_custkey')} AS gender
    FROM (SELECT *, {H.ICD} AS icd10_code FROM ({PEOPLE_SQL})) p"""
ENTITIES_SQL = f"SELECT *, CASE {ENTITY_CASES} ELSE parent END AS entity_or_parent FROM ({TUMOURS_SQL})"


def tumours(t):
    """Conditions with entity, age and the flag for patients with several."""
    df = people(t).withColumns(
        {
            "age_at_diagnosis": D.age_at("asserted_date", "birthdate"),
            "icd10_parent_code": C.icd_parent("icd10_code"),
            "entity_or_parent": C.entity_group("icd10_code"),
        }
    )
    return O.multi_flag(df, "o_custkey")


query("entity_group", f"SELECT o_orderkey, entity_or_parent FROM ({ENTITIES_SQL})")(
    lambda t: t.orders.selectExpr("o_orderkey", f"{H.ICD} AS icd").select(
        "o_orderkey", C.entity_group("icd").alias("entity_or_parent")
    )
)

LABEL_CODES = """CASE o_orderkey % 8 WHEN 0 THEN 'D05.1' WHEN 1 THEN 'D09.0' WHEN 2 THEN 'd39.1' WHEN 3 THEN 'D41.4' WHEN 4 THEN 'D06.9'
    WHEN 5 THEN 'D09.1' WHEN 6 THEN 'X' ELSE ' ' END"""
query(
    "entity_label",
    f"""SELECT o_orderkey, CASE {LABEL_CASES} ELSE substr(icd10_code, 1, 3) END AS label,
        CASE o_orderkey % 8 WHEN 0 THEN 'Brust' WHEN 1 THEN 'Harnblase' WHEN 2 THEN 'Eierstöcke' WHEN 3 THEN 'Harnblase'
            WHEN 4 THEN 'Gebärmutterhals' WHEN 5 THEN 'D09' END AS other_label FROM (SELECT *, {H.ICD} AS icd10_code FROM orders)""",
)(
    lambda t: t.orders.selectExpr("o_orderkey", f"{H.ICD} AS icd", f"{LABEL_CODES} AS other").select(
        "o_orderkey", C.entity_label("icd").alias("label"), C.entity_label("other").alias("other_label")
    )
)

query("icd_parents", f"SELECT o_orderkey, split_part({H.ICD}, '.', 1) AS parent, substr({H.ICD}, 1, 3) AS category FROM orders")(
    lambda t: t.orders.selectExpr("o_orderkey", f"{H.ICD} AS icd").select(
        "o_orderkey", C.icd_parent("icd").alias("parent"), C.icd_category("icd").alias("category")
    )
)

query(
    "gleason_score",
    f"""SELECT {H.OBS_ID} AS id, CASE ({Q}) % 9 WHEN 0 THEN 6 WHEN 1 THEN 7 WHEN 2 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 8 WHEN 5 THEN 8
        WHEN 6 THEN 9 WHEN 7 THEN 9 WHEN 8 THEN 10 END AS gleason_score FROM lineitem WHERE {H.OBS_KIND} = 1""",
)(
    lambda t: V.gleason(H.observation(t)).select(
        F.substring("observation_gleason_resource_id", 13, 100).alias("id"),
        C.gleason_score("gleason_sct").alias("gleason_score"),
    )
)

NUMBERED_SQL = f"""SELECT *, row_number() OVER w AS malignancy_number, lag(asserted_date) OVER w AS date_prev,
    count(*) OVER (PARTITION BY o_custkey) AS malignancy_count FROM ({ENTITIES_SQL}) WINDOW w AS (PARTITION BY o_custkey ORDER BY asserted_date, o_orderkey)"""
TWO_SQL = f"""SELECT *, round({months('asserted_date', 'date_prev')} / 12, 2) AS years_between, round({months('asserted_date', 'date_prev')}, 1) AS months_between
    FROM ({NUMBERED_SQL}) WHERE malignancy_count >= 2 AND malignancy_number <= 2"""


def two(t):
    return TU.two_malignancies(tumours(t), "o_custkey", "asserted_date", "o_orderkey")


query(
    "two_malignancies",
    f"SELECT o_custkey, o_orderkey, cast(malignancy_number as int) AS malignancy_number, malignancy_count, cast(date_prev as varchar) AS date_prev, years_between, months_between FROM ({TWO_SQL})",
)(
    lambda t: strings(
        two(t).select(
            "o_custkey", "o_orderkey", "malignancy_number", "malignancy_count", "date_prev", "years_between", "months_between"
        ),
        "date_prev",
    )
)

query("one_malignancy", "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_patients FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n = 1")(
    lambda t: TU.one_row_per_patient(TU.one_malignancy(tumours(t)), "o_custkey")
)

_WIDE = ["o_orderkey", "icd10_code", "entity_or_parent", "age_at_diagnosis"]
query(
    "pivot_tumours",
    f"""SELECT o_custkey, any_value(gender) AS gender, CASE WHEN max(malignancy_count) > 1 THEN 1 ELSE 0 END AS double_patid, """
    + ", ".join(f"max({c}) FILTER (malignancy_number = {n}) AS {c}_{n}" for c in _WIDE for n in (1, 2))
    + f" FROM ({NUMBERED_SQL}) GROUP BY 1",
)(lambda t: TU.pivot_tumours(two(t), TU.one_malignancy(tumours(t)), _WIDE, "o_custkey"))

PAIRS_SQL = f"""SELECT o_custkey, any_value(gender) AS gender, max(entity_or_parent) FILTER (malignancy_number = 1) AS entity_or_parent_1,
    max(entity_or_parent) FILTER (malignancy_number = 2) AS entity_or_parent_2, max(age_at_diagnosis) FILTER (malignancy_number = 1) AS age_1,
    max(age_at_diagnosis) FILTER (malignancy_number = 2) AS age_2, max(months_between) FILTER (malignancy_number = 2) AS months_between_2
    FROM ({TWO_SQL}) GROUP BY 1"""


def pairs(t):
    return TU.tumour_pairs(two(t), patient="o_custkey")


query("tumour_pairs", PAIRS_SQL)(pairs)


def _quartiles(c: str, stem: str, n: str) -> str:
    q = ", ".join(
        f"quantile_disc({c}, {p}) AS {stem}_{name}_{n}" for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    )
    return f"min({c}) AS {stem}_min_{n}, max({c}) AS {stem}_max_{n}, {q}"


STATS_SQL = f"""SELECT entity_or_parent_1, entity_or_parent_2, count(*) AS count_pair,
    count(*) FILTER (gender = 'male') AS count_male_pair, count(*) FILTER (gender = 'female') AS count_female_pair,
    {_quartiles('age_1', 'age', '1')}, {_quartiles('age_2', 'age', '2')}, {_quartiles('months_between_2', 'months_between', '2')}
    FROM ({PAIRS_SQL}) GROUP BY 1, 2"""
query("pair_statistics", STATS_SQL)(lambda t: TU.pair_statistics(pairs(t)))

# Outliers need groups of some size: pairs of gender and a coarse second group.
_COARSE = "substr(entity_or_parent_2, 1, 1)"
query(
    "pair_outliers",
    f"""WITH p AS (SELECT gender AS e_1, {_COARSE} AS e_2, age_1, age_2, months_between_2 FROM ({PAIRS_SQL})),
        long AS (SELECT e_1, e_2, measure, value FROM p UNPIVOT (value FOR measure IN (age_1, age_2, months_between_2))),
        f AS (SELECT e_1, e_2, measure, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM long GROUP BY ALL)
        SELECT e_1, e_2, measure, value FROM long JOIN f USING (e_1, e_2, measure) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)(
    lambda t: TU.pair_outliers(
        pairs(t).selectExpr("o_custkey", "gender AS e_1", "substring(entity_or_parent_2, 1, 1) AS e_2", "age_1", "age_2", "months_between_2"),
        "e",
    )
)

query(
    "gender_counts",
    f"""WITH x AS (SELECT {H.ICD} AS icd, {H.GENDER} AS gender, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey)
        SELECT substr(icd, 1, 3) AS icd10_parent, count(*) AS total_count, count(*) FILTER (gender = 'male') AS male_count, count(*) FILTER (gender = 'female') AS female_count FROM x GROUP BY 1
        UNION ALL SELECT 'C71_IV', count(*), count(*) FILTER (gender = 'male'), count(*) FILTER (gender = 'female') FROM x WHERE icd LIKE 'C71%' AND o_orderkey % 2 = 0""",
)(
    lambda t: TU.gender_counts(
        people(t).withColumns(
            {
                "weitere_klassifikation_code_text": F.lit("WHO Grad"),
                "weitere_klassifikation_code": F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'IV' ELSE 'II' END"),
            }
        )
    )
)

# Therapies --------------------------------------------------------------------------------------

query(
    "concat_children",
    f"""SELECT part_of_reference, coalesce(string_agg(DISTINCT medication_statement_text, '| ' ORDER BY medication_statement_text), '') AS medication_statement_text,
        coalesce(string_agg(DISTINCT medication_statement_atc_code, '| ' ORDER BY medication_statement_atc_code), '') AS medication_statement_atc_code
        FROM ({LQ.RESOLVED_SQL}) GROUP BY 1""",
)(
    lambda t: T.concat_children(
        LQ.resolved(t), ["part_of_reference"], ["medication_statement_text", "medication_statement_atc_code"]
    )
)

_SURGERY_CELLS = ", ".join(
    f"string_agg({c}, '| ' ORDER BY therapy_id) AS {c}" for c in ("ops_code", "surgery_outcome", "therapy_intention", "therapy_id")
)
query(
    "group_surgeries",
    f"""SELECT reason_reference, subject_reference, therapy_start_date, {_SURGERY_CELLS} FROM ({VQ.SURGERY_SQL})
        WHERE reason_reference IS NOT NULL AND subject_reference IS NOT NULL AND therapy_start_date IS NOT NULL GROUP BY 1, 2, 3
        UNION ALL SELECT reason_reference, subject_reference, therapy_start_date, coalesce(ops_code, ''), coalesce(surgery_outcome, ''), coalesce(therapy_intention, ''), coalesce(therapy_id, '')
        FROM ({VQ.SURGERY_SQL}) WHERE reason_reference IS NULL OR subject_reference IS NULL OR therapy_start_date IS NULL""",
)(lambda t: T.group_surgeries(V.surgeries(H.procedure(t))))

# The lines of an order are few; those of a return flag are a third of all, and go into pages.
query(
    "ordered_concat",
    """SELECT l_orderkey, string_agg(cast(l_partkey as varchar), '| ' ORDER BY l_linenumber, cast(l_partkey as varchar)) AS l_partkey FROM lineitem GROUP BY 1""",
)(
    lambda t: T.ordered_concat(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], "l_linenumber", ["l_partkey"])
)
query(
    "paged_concat",
    """SELECT l_returnflag, CAST(floor(place / 2000) + 1 AS BIGINT) AS page, string_agg(v, '| ' ORDER BY place) AS l_partkey FROM
        (SELECT l_returnflag, v, coalesce(sum(length(v) + 2) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
         FROM (SELECT l_returnflag, l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS v FROM lineitem)) GROUP BY 1, 2""",
)(lambda t: T.paged_concat(t.lineitem, ["l_returnflag"], ["l_orderkey", "l_linenumber"], "l_partkey", page=2000))

METASTASIS_SQL = VQ.METASTASES_SQL
query(
    "metastasis_by_day",
    f"SELECT condition_id, metastasis_date, string_agg(DISTINCT metastasis_loc, '|' ORDER BY metastasis_loc) AS metastasis_loc FROM ({METASTASIS_SQL}) GROUP BY 1, 2",
)(lambda t: T.metastasis_by_day(V.metastases(H.observation(t))))

# Therapies of orders: one line item is one therapy.
LINE_THERAPIES_SQL = f"""SELECT {H.OBS_ID} AS therapy_id, l_orderkey, {H.pick('l_suppkey', ['OP', 'ST', 'CH', 'HO'])} AS therapy_type,
    {H.pick(Q, H.INTENTIONS)} AS therapy_intention, cast(l_shipdate as date) AS start,
    CASE WHEN l_suppkey % 4 >= 2 THEN {H.pick('l_partkey', H.ATC_CODES)} END AS atc, cast(o_orderdate as date) AS asserted_date
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey"""
SEQUENCED_SQL = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY months_diff NULLS FIRST, therapy_id, therapy_type) AS n
    FROM (SELECT *, round({months('start', 'asserted_date')}, 2) AS months_diff FROM ({LINE_THERAPIES_SQL}))"""


def line_therapies(t):
    rows = t.lineitem.selectExpr(
        f"{H.OBS_ID} AS therapy_id",
        "cast(l_orderkey as string) AS reason_reference",
        f"{H.pick('l_suppkey', ['OP', 'ST', 'CH', 'HO'])} AS therapy_type",
        f"{H.pick(Q, H.INTENTIONS)} AS therapy_intention",
        "cast(l_shipdate as date) AS therapy_start_date",
        f"CASE WHEN l_suppkey % 4 >= 2 THEN {H.pick('l_partkey', H.ATC_CODES)} END AS medication_statement_atc_code",
    )
    return T.all_therapies(
        rows.where("therapy_type = 'OP'").drop("therapy_type"),
        rows.where("therapy_type = 'ST'").drop("therapy_type"),
        rows.where("therapy_type NOT IN ('OP', 'ST')"),
    )


def dated_conditions(t):
    return t.orders.selectExpr(
        "cast(o_orderkey as string) AS condition_id", "cast(o_orderdate as date) AS asserted_date", "o_orderpriority"
    )


_SEQ = ["therapy_type", "months_diff", "medication_statement_atc_code"]


def _wide_sequence_sql(max_n: int, source: str) -> str:
    names = {"therapy_type": "therapy_type", "months_diff": "months_diff", "medication_statement_atc_code": "atc"}
    cells = ", ".join(f"max({names[c]}) FILTER (n = {i}) AS {c}_{i}" for c in _SEQ for i in range(1, max_n + 1))
    return f"SELECT l_orderkey, {cells} FROM ({source}) GROUP BY 1"


query(
    "therapy_sequence",
    f"""SELECT cast(o_orderkey as varchar) AS condition_id, s.* EXCLUDE (l_orderkey) FROM orders
        LEFT JOIN ({_wide_sequence_sql(10, SEQUENCED_SQL)}) s ON l_orderkey = o_orderkey""",
)(
    lambda t: T.therapy_sequence(dated_conditions(t), line_therapies(t), cols=_SEQ).drop("asserted_date", "o_orderpriority")
)

def first_line(t, max_n: int = 4):
    return T.therapy_sequence(dated_conditions(t), line_therapies(t), max_n, 1, _SEQ)


FIRST_LINE_SQL = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY months_diff, therapy_id, therapy_type) AS n
    FROM (SELECT *, round({months('start', 'asserted_date')}, 2) AS months_diff FROM ({LINE_THERAPIES_SQL})) WHERE months_diff BETWEEN 0 AND 1"""
FIRST_LINE_WIDE_SQL = f"""SELECT cast(o_orderkey as varchar) AS condition_id, o_orderpriority, s.* EXCLUDE (l_orderkey)
    FROM orders JOIN ({_wide_sequence_sql(4, FIRST_LINE_SQL)}) s ON l_orderkey = o_orderkey"""
query("therapy_sequence_first_line", FIRST_LINE_WIDE_SQL)(lambda t: first_line(t).drop("asserted_date"))

query(
    "therapy_index",
    f"SELECT therapy_id, cast(l_orderkey as varchar) AS reason_reference, cast(n as int) AS therapy_index FROM ({SEQUENCED_SQL}) WHERE n <= 10",
)(
    lambda t: T.therapy_index(line_therapies(t), dated_conditions(t)).select("therapy_id", "reason_reference", "therapy_index")
)

COMBO_SQL = f"""SELECT condition_id, o_orderpriority, array_to_string(list_sort(list_distinct([therapy_type_1, therapy_type_2, therapy_type_3, therapy_type_4])), '+') AS combo_label
    FROM ({FIRST_LINE_WIDE_SQL})"""
query("therapy_combinations", f'SELECT combo_label, count(*) AS "count" FROM ({COMBO_SQL}) GROUP BY 1')(
    lambda t: T.therapy_combinations(first_line(t))
)

_FIRST_TYPES_SQL = f"SELECT l_orderkey, string_agg(DISTINCT therapy_type, '+' ORDER BY therapy_type) AS combo_label FROM ({FIRST_LINE_SQL}) GROUP BY 1"
query("therapy_combinations_of_all", f'SELECT combo_label, count(*) AS "count" FROM orders JOIN ({_FIRST_TYPES_SQL}) ON l_orderkey = o_orderkey GROUP BY 1')(
    lambda t: T.therapy_combinations(T.all_combinations(dated_conditions(t), line_therapies(t), 1))
)

query(
    "therapy_combinations_by_metastasis",
    f"""SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'metastatic' ELSE 'non_metastatic' END AS metastatic_flag, combo_label, count(*) AS "count"
        FROM ({COMBO_SQL}) GROUP BY 1, 2""",
)(
    lambda t: T.therapy_combinations_by_metastasis(
        first_line(t).withColumns(
            {
                "metastasis_loc": F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN 'OSS' END"),
                "metastasis_date_first": F.lit(None).cast("date"),
            }
        )
    )
)

query(
    "sequence_counts",
    f"""SELECT therapy_type_1, therapy_type_2, therapy_type_3, therapy_type_4, count(*) AS "count", concat_ws('+', therapy_type_1, therapy_type_2, therapy_type_3, therapy_type_4) AS pattern
        FROM ({FIRST_LINE_WIDE_SQL}) GROUP BY 1, 2, 3, 4""",
)(lambda t: T.sequence_counts(first_line(t)))

query("leading_ordinals", f"SELECT condition_id, o_orderpriority, therapy_type_1, therapy_type_2, months_diff_1, months_diff_2, medication_statement_atc_code_1, medication_statement_atc_code_2 FROM ({FIRST_LINE_WIDE_SQL})")(
    lambda t: T.leading_ordinals(first_line(t).drop("asserted_date"), 2)
)

CODE_CELL = "concat(' ', l_partkey % 40, ' |', l_suppkey % 40)"
query(
    "atc_groups",
    """WITH m AS (SELECT cast(p_partkey as varchar) AS code, p_brand FROM part WHERE p_partkey < 40 AND p_partkey % 4 <> 0)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
            concat_ws('|', (SELECT p_brand FROM m WHERE code = cast(l_partkey % 40 as varchar)), (SELECT p_brand FROM m WHERE code = cast(l_suppkey % 40 as varchar))) AS gruppe_1,
            concat_ws('|', CASE WHEN l_linenumber > 3 THEN (SELECT p_brand FROM m WHERE code = cast(l_partkey % 40 as varchar)) END) AS gruppe_2 FROM lineitem""",
)(
    lambda t: T.atc_groups(
        t.lineitem.selectExpr(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            f"concat_ws('-', {H.OBS_ID}, {H.day('l_shipdate')}) AS id",
            f"{CODE_CELL} AS code_1",
            "CASE WHEN l_linenumber > 3 THEN cast(l_partkey % 40 as string) END AS code_2",
        ),
        t.part.where("p_partkey < 40 AND p_partkey % 4 <> 0").selectExpr("cast(p_partkey as string) AS atc_code", "p_brand AS gruppe"),
        "id",
        "code",
    ).drop("id", "code_1", "code_2")
)

query(
    "map_code_list",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws('|', CASE l_partkey % 40 WHEN 1 THEN 'A' WHEN 2 THEN 'B' END, CASE l_suppkey % 40 WHEN 1 THEN 'A' WHEN 2 THEN 'B' END) AS g FROM lineitem""",
)(
    lambda t: t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", f"{CODE_CELL} AS c").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        C.map_code_list("c", F.create_map(F.lit("1"), F.lit("A"), F.lit("2"), F.lit("B"))).alias("g"),
    )
)
