"""Distributions, profiles, survival, federation, quality reports (H22 to H42, I, J, K) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cohorts as CQ
from checks import linkage as LQ
from checks import shape as H
from checks import views as VQ
from checks.dates import LINES, MIXED_TEXT, PEOPLE_SQL, lines
from checks.registry import query
from cohortloom.functions import codes as C
from cohortloom.functions import dates as D
from cohortloom.functions import text as X
from cohortloom.operators import federate as FE
from cohortloom.operators import predicates as PR
from cohortloom.operators import quality as QU
from cohortloom.operators import quantiles as QT
from cohortloom.operators import stats as S
from cohortloom.operators import survival as SV
from cohortloom.operators import tumours as TU
from cohortloom.operators import views as V
from cohortloom.plans.studies import pca_federated
from cohortloom.sources import sinks as SK

Q = H.Q
GLEASON_COUNTS = ", ".join(f"count(*) FILTER (gleason_score = {g}) AS gleason_{g}_count" for g in S.GLEASON)

# One row per condition: age, score, cohort flag, metastases.
COHORT_SQL = f"""SELECT *, CASE WHEN age_at_diagnosis < 65 AND gleason_score >= 8 THEN 1 ELSE 0 END AS cohort_flag,
    CASE o_orderkey % 5 WHEN 0 THEN 'OSS' WHEN 1 THEN 'PUL| OSS |PUL' WHEN 2 THEN ' | ' WHEN 3 THEN 'HEP' END AS metastasis_loc,
    CASE WHEN o_orderkey % 5 <> 4 THEN asserted_date + cast(o_orderkey % 300 as int) END AS metastasis_date_first
    FROM ({LQ.SCORED}) JOIN (SELECT o_orderkey, asserted_date FROM ({PEOPLE_SQL})) USING (o_orderkey)"""


def cohort(t):
    return PR.flag_cohort(LQ.scored(t)).withColumns(
        {
            "metastasis_loc": F.expr(
                "CASE o_orderkey % 5 WHEN 0 THEN 'OSS' WHEN 1 THEN 'PUL| OSS |PUL' WHEN 2 THEN ' | ' WHEN 3 THEN 'HEP' END"
            ),
            "metastasis_date_first": F.expr(
                "CASE WHEN o_orderkey % 5 <> 4 THEN date_add(asserted_date, cast(o_orderkey % 300 as int)) END"
            ),
        }
    )


query(
    "counts_by_year",
    f'SELECT cast(year(asserted_date) as int) AS diagnosis_year, count(*) AS "count", sum(cohort_flag)::bigint AS cohort_count, {GLEASON_COUNTS} FROM ({COHORT_SQL}) GROUP BY 1',
)(lambda t: S.counts_by_year(cohort(t)))

KIND_SQL = f"""SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 'OSS' WHEN 1 THEN 'OSS|PUL' WHEN 3 THEN 'HEP' ELSE 'NON' END AS metastasis_kind FROM ({COHORT_SQL})"""
METASTASIS_COUNTS_SQL = f"""SELECT metastasis_kind, count(*) AS overall_count, sum(cohort_flag)::bigint AS cohort_count,
    count(*) FILTER (datediff('day', asserted_date, metastasis_date_first) < 121.75) AS synchron_count, {GLEASON_COUNTS} FROM ({KIND_SQL}) GROUP BY 1"""
query("counts_by_metastasis", METASTASIS_COUNTS_SQL)(lambda t: S.counts_by_metastasis(cohort(t)))

AGE_SQL = f"""SELECT cast(CASE WHEN age_at_diagnosis > 100 THEN 100 ELSE (ceil(age_at_diagnosis / 5) - 1) * 5 END as int) AS age_class, count(*) AS "count",
    sum(cohort_flag)::bigint AS cohort_count, {GLEASON_COUNTS} FROM ({COHORT_SQL}) WHERE age_at_diagnosis > 0 AND age_at_diagnosis <= 150 GROUP BY 1"""
query("counts_by_age_class", AGE_SQL)(lambda t: S.counts_by_age_class(cohort(t)))

query("normalise_set_string", f"SELECT o_orderkey, metastasis_kind FROM ({KIND_SQL})")(
    lambda t: cohort(t).select("o_orderkey", C.normalise_set_string("metastasis_loc").alias("metastasis_kind"))
)

query(
    "age_groups",
    f"""SELECT o_orderkey, CASE WHEN a > 0 AND a <= 18 THEN '0-18' WHEN a > 18 AND a <= 30 THEN '18-30' WHEN a > 30 AND a <= 45 THEN '30-45'
        WHEN a > 45 AND a <= 60 THEN '45-60' WHEN a > 60 AND a <= 75 THEN '60-75' WHEN a > 75 AND a <= 90 THEN '75-90' WHEN a > 90 AND a <= 120 THEN '90+' END AS age_group
        FROM (SELECT o_orderkey, age_at_diagnosis AS a FROM ({LQ.SCORED}))""",
)(lambda t: LQ.scored(t).select("o_orderkey", C.age_group("age_at_diagnosis").alias("age_group")))

BIN_CODES = "CASE o_orderkey % 7 WHEN 0 THEN 'C93.1' WHEN 1 THEN 'C93.11' WHEN 2 THEN 'C92.3' WHEN 3 THEN 'C92.41' WHEN 4 THEN 'C91.0' WHEN 5 THEN NULL ELSE 'C92.40' END"
query(
    "leukaemia_bins",
    "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'C93.1' WHEN 1 THEN 'C93.1' WHEN 2 THEN 'C92.3' WHEN 3 THEN 'C92.4' WHEN 6 THEN 'C92.4' ELSE 'C92.0' END AS icd_bin FROM orders",
)(lambda t: t.orders.selectExpr("o_orderkey", f"{BIN_CODES} AS c").select("o_orderkey", C.leukaemia_bin("c").alias("icd_bin")))

query(
    "distribution",
    """SELECT kind, n AS "count", round(n * 100.0 / sum(n) OVER (), 6) AS percentage FROM
        (SELECT event_type AS kind, count(*) AS n FROM events WHERE event_id % 9 <> 0 GROUP BY 1)""",
)(
    lambda t: S.distribution(
        t.events.selectExpr("CASE WHEN event_id % 9 <> 0 THEN event_type END AS event_type"), "event_type", "kind"
    ).withColumn("percentage", F.round("percentage", 6))
)

query(
    "value_counts",
    """SELECT loinc_code, loinc_display, lab_quantity_unit, count(*) AS "count" FROM (""" + VQ.LABS_SQL + """) GROUP BY 1, 2, 3""",
)(lambda t: S.value_counts(V.labs(H.observation(t)), ["loinc_code", "loinc_display", "lab_quantity_unit"]))

query(
    "distinct_patients_by",
    "SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS num_patients FROM orders GROUP BY 1, 2",
)(lambda t: S.distinct_patients_by(t.orders, ["o_orderpriority", "o_orderstatus"], "o_custkey"))

query(
    "cohort_funnel",
    f"""WITH x AS (SELECT o_custkey, {H.ICD} LIKE 'C61%' AS a, o_orderstatus = 'F' AS b, o_orderdate < timestamp '1998-04-01' AS c FROM orders)
        SELECT 0 AS step_no, 'all' AS step, count(DISTINCT o_custkey) AS n FROM x UNION ALL
        SELECT 1, 'prostate', count(DISTINCT o_custkey) FROM x WHERE a UNION ALL
        SELECT 2, 'treated', count(DISTINCT o_custkey) FROM x WHERE a AND b UNION ALL
        SELECT 3, 'before', count(DISTINCT o_custkey) FROM x WHERE a AND b AND c UNION ALL
        SELECT 4, 'after', count(DISTINCT o_custkey) FROM x WHERE a AND b AND NOT c""",
)(
    lambda t: S.cohort_funnel(
        t.orders.selectExpr("*", f"{H.ICD} LIKE 'C61%' AS a", "o_orderstatus = 'F' AS b", "o_orderdate < timestamp_ntz'1998-04-01' AS c"),
        {
            "all": F.lit(True),
            "prostate": F.col("a"),
            "treated": F.expr("a AND b"),
            "before": F.expr("a AND b AND c"),
            "after": F.expr("a AND b AND NOT c"),
        },
        "o_custkey",
    )
)

query(
    "entity_summary",
    f"""SELECT entity_or_parent, n AS "count", round(m, 6) AS mean_age FROM (SELECT entity_or_parent, count(*) AS n, avg(age_at_diagnosis) AS m
        FROM ({CQ.ENTITIES_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)""",
)(lambda t: S.entity_summary(CQ.tumours(t), "entity_or_parent", top_n=20).withColumn("mean_age", F.round("mean_age", 6)))

query(
    "pair_matrix_top30",
    f"""SELECT entity_or_parent_1, entity_or_parent_2, count_pair, round(count_female_pair / count_pair, 6) AS female_ratio
        FROM ({CQ.STATS_SQL}) ORDER BY count_pair DESC, entity_or_parent_1, entity_or_parent_2 LIMIT 30""",
)(
    lambda t: S.pair_matrix(TU.pair_statistics(CQ.pairs(t)), top_n=30).select(
        "entity_or_parent_1", "entity_or_parent_2", "count_pair", F.round("female_ratio", 6).alias("female_ratio")
    )
)

query(
    "pair_matrix_above_five",
    f"SELECT entity_or_parent_1, entity_or_parent_2, count_pair FROM ({CQ.STATS_SQL}) WHERE count_pair > 5",
)(
    lambda t: S.pair_matrix(TU.pair_statistics(CQ.pairs(t)), min_count=5).select(
        "entity_or_parent_1", "entity_or_parent_2", "count_pair"
    )
)

query(
    "wide_matrix",
    f"""SELECT entity_or_parent_1, coalesce(sum(count_pair) FILTER (entity_or_parent_2 = 'C50'), 0)::bigint AS "C50",
        coalesce(sum(count_pair) FILTER (entity_or_parent_2 = 'C61'), 0)::bigint AS "C61" FROM ({CQ.STATS_SQL}) GROUP BY 1""",
)(lambda t: S.wide_matrix(TU.pair_statistics(CQ.pairs(t)), ["C50", "C61"], "count_pair"))

PANELS = {"clicks": ["click", "view"], "errors": ["error"], "orders": ["purchase"]}
query(
    "lab_panel_means",
    """WITH p AS (SELECT user_id, min(ts) + INTERVAL 10 DAY AS diagnosed FROM events GROUP BY 1),
        l AS (SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 'clicks' WHEN event_type = 'error' THEN 'errors' WHEN event_type = 'purchase' THEN 'orders' END AS lab_value,
            concat('u', event_id % 2) AS unit FROM events),
        n AS (SELECT l.*, row_number() OVER (PARTITION BY l.user_id, lab_value ORDER BY abs(epoch_us(ts) - epoch_us(diagnosed)), ts, event_id) AS rn
            FROM p JOIN l ON l.user_id = p.user_id WHERE lab_value IS NOT NULL)
        SELECT lab_value, unit, count(value) AS "count", round(avg(value), 6) AS mean FROM n WHERE rn = 1 GROUP BY 1, 2""",
)(
    lambda t: S.lab_panel_means(
        t.events.groupBy("user_id").agg((F.min("ts") + F.expr("INTERVAL '10' DAY")).alias("diagnosed")),
        t.events.selectExpr("user_id", "event_type", "cast(value as string) AS value", "concat('u', event_id % 2) AS unit", "ts", "event_id"),
        "user_id",
        "diagnosed",
        "ts",
        PANELS,
        "event_type",
        "value",
        "unit",
        "event_id",
    ).withColumn("mean", F.round("mean", 6))
)

# Two-tumour timing ------------------------------------------------------------------------------

TIMED_SQL = f"""SELECT o_custkey, entity_or_parent_1, entity_or_parent_2, d1, d2, datediff('day', d1, d2) AS timediff, m1, loc,
    CASE WHEN m1 <= d2 - INTERVAL 3 MONTH THEN 'yes' ELSE 'no' END AS spread FROM
    (SELECT o_custkey, max(entity_or_parent) FILTER (malignancy_number = 1) AS entity_or_parent_1, max(entity_or_parent) FILTER (malignancy_number = 2) AS entity_or_parent_2,
        max(asserted_date) FILTER (malignancy_number = 1) AS d1, max(asserted_date) FILTER (malignancy_number = 2) AS d2,
        CASE WHEN o_custkey % 3 > 0 THEN max(asserted_date) FILTER (malignancy_number = 1) + cast(o_custkey % 50 as int) END AS m1,
        CASE o_custkey % 4 WHEN 0 THEN 'OSS' WHEN 1 THEN 'PUL|OSS' WHEN 2 THEN '' END AS loc FROM ({CQ.TWO_SQL}) GROUP BY 1)"""


def timed(t):
    wide = (
        CQ.two(t)
        .groupBy("o_custkey")
        .agg(
            *[
                F.max(F.when(F.col("malignancy_number") == n, F.col(c))).alias(f"{a}_{n}" if a[0] == "e" else f"{a}{n}")
                for c, a in (("entity_or_parent", "entity_or_parent"), ("asserted_date", "d"))
                for n in (1, 2)
            ]
        )
        .selectExpr(
            "*",
            "CASE WHEN o_custkey % 3 > 0 THEN date_add(d1, cast(o_custkey % 50 as int)) END AS m1",
            "cast(null as date) AS m2",
            "CASE o_custkey % 4 WHEN 0 THEN 'OSS' WHEN 1 THEN 'PUL|OSS' WHEN 2 THEN '' END AS loc",
        )
        .withColumn("timediff", D.days_between("d2", "d1"))
    )
    return S.meta_flags(wide, 3, "loc", "m1", "m2", "d2").withColumnRenamed("meta_before_dx_T1_interval_yes", "spread")


query(
    "meta_flags",
    f"""SELECT o_custkey, spread, CASE WHEN spread = 'yes' THEN 1 ELSE 0 END AS hit, CASE WHEN loc <> '' THEN 'yes' ELSE 'no' END AS meta_at_first,
        0 AS meta_before_dx_T2 FROM ({TIMED_SQL})""",
)(
    lambda t: timed(t).select(
        "o_custkey", "spread", F.col("meta_1_before_T2_interval").alias("hit"), "meta_at_first", "meta_before_dx_T2"
    )
)

query(
    "flag_by_entity",
    f"""SELECT entity_or_parent_2, spread, n, round(n / sum(n) OVER (PARTITION BY entity_or_parent_2) * 100.0, 6) AS percentage
        FROM (SELECT entity_or_parent_2, spread, count(*) AS n FROM ({TIMED_SQL}) GROUP BY 1, 2)""",
)(lambda t: S.flag_by_entity(timed(t), "entity_or_parent_2", "spread").withColumn("percentage", F.round("percentage", 6)))

SITES_SQL = f"SELECT entity_or_parent_1, entity_or_parent_2, unnest(string_split(loc, '|')) AS location FROM ({TIMED_SQL}) WHERE loc <> ''"
query("location_entity_counts", f"SELECT location, entity_or_parent_2, count(*) AS n FROM ({SITES_SQL}) GROUP BY 1, 2")(
    lambda t: S.location_entity_counts(timed(t), "loc", "entity_or_parent_2")
)
query(
    "location_entity_counts_by_first",
    f"""SELECT entity_or_parent_1, location, entity_or_parent_2, count(*) AS n FROM ({SITES_SQL}) WHERE entity_or_parent_1 IN
        (SELECT entity_or_parent_1 FROM ({TIMED_SQL}) GROUP BY 1 HAVING count(*) > 10) GROUP BY 1, 2, 3""",
)(lambda t: S.location_entity_counts(timed(t), "loc", "entity_or_parent_2", "entity_or_parent_1", 10))

query("location_combinations", f"SELECT DISTINCT loc, entity_or_parent_2 FROM ({TIMED_SQL})")(
    lambda t: S.location_combinations(timed(t), ["loc", "entity_or_parent_2"])
)


def km_sql(source: str, strata: list[str], time: str = "timediff") -> str:
    by = ", ".join(strata)
    part = f"PARTITION BY {by} " if strata else ""
    return f"""WITH e AS (SELECT {by}{', ' if strata else ''}{time} AS time, count(*) AS d FROM ({source}) GROUP BY ALL),
        r AS (SELECT *, sum(d) OVER ({part}ORDER BY time DESC) AS n FROM e)
        SELECT {by}{', ' if strata else ''}cast(time as int) AS time, n::bigint AS n_risk, d AS n_event, round(CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w = 1 THEN 0
            ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d / n) ELSE 0 END) OVER w) END, 10) AS survival FROM r WINDOW w AS ({part}ORDER BY time)"""


query("kaplan_meier", km_sql(TIMED_SQL, ["spread"]))(
    lambda t: SV.kaplan_meier(timed(t), "timediff", ["spread"]).withColumn("survival", F.round("survival", 10))
)
query(
    "kaplan_meier_per_group",
    km_sql(
        f"""SELECT * FROM ({TIMED_SQL}) WHERE entity_or_parent_1 IN (SELECT entity_or_parent_1 FROM ({TIMED_SQL}) GROUP BY 1
            HAVING count(*) > 20 AND count(DISTINCT spread) >= 2)""",
        ["entity_or_parent_1", "spread"],
    ),
)(
    lambda t: SV.kaplan_meier_per_group(timed(t), "timediff", "entity_or_parent_1", "spread", 20).withColumn(
        "survival", F.round("survival", 10)
    )
)

# Censored survival over line items: shipped late counts as event.
query(
    "kaplan_meier_censored",
    f"""WITH x AS (SELECT l_returnflag, datediff('day', asserted_date, ship_date) AS time, CASE WHEN l_linenumber > 2 THEN 1 ELSE 0 END AS ev FROM ({LINES.replace('l_linenumber,', 'l_linenumber, l_returnflag,')})),
        e AS (SELECT l_returnflag, time, count(*) AS leaving, sum(ev) AS d FROM x GROUP BY 1, 2),
        r AS (SELECT *, sum(leaving) OVER (PARTITION BY l_returnflag ORDER BY time DESC) AS n FROM e)
        SELECT l_returnflag, cast(time as int) AS time, n::bigint AS n_risk, d::bigint AS n_event, round(CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w = 1 THEN 0
            ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d / n) ELSE 0 END) OVER w) END, 10) AS survival FROM r WINDOW w AS (PARTITION BY l_returnflag ORDER BY time)""",
)(
    lambda t: SV.kaplan_meier(
        t.lineitem.selectExpr("l_orderkey", "l_returnflag", "cast(l_shipdate as date) AS s", "cast(l_linenumber > 2 as int) AS ev")
        .join(t.orders.selectExpr("o_orderkey AS l_orderkey", "cast(o_orderdate as date) AS d"), "l_orderkey")
        .withColumn("time", F.datediff("s", "d")),
        "time",
        ["l_returnflag"],
        "ev",
    ).withColumn("survival", F.round("survival", 10))
)

# Date quality -----------------------------------------------------------------------------------

query(
    "date_quality_profile",
    """SELECT 'a' AS col, count(*) AS n_total, count(*) FILTER (o_orderkey % 12 <> 11) AS n_nonempty, count(*) FILTER (o_orderkey % 12 < 10) AS n_parsed,
        count(*) FILTER (o_orderkey % 12 >= 10) AS n_na, 0 AS n_1970, count(*) FILTER (o_orderkey % 12 IN (0, 1)) AS prec_day, count(*) FILTER (o_orderkey % 12 = 2) AS prec_month,
        count(*) FILTER (o_orderkey % 12 = 3) AS prec_year, 0 AS n_inconsistent, 0 AS n_implausible_year FROM orders
        UNION ALL SELECT 'b', count(*), count(*), count(*), 0, count(*) FILTER (o_orderkey % 2 = 0), count(*), 0, 0, 0, count(*) FILTER (o_orderkey % 2 = 1) FROM orders""",
)(
    lambda t: S.date_quality_profile(
        t.orders.selectExpr(f"{MIXED_TEXT} AS a", "CASE WHEN o_orderkey % 2 = 0 THEN '1970-01-01' ELSE '1901-02-03' END AS b"), ["a", "b"]
    )
)

query(
    "epoch_raw_values",
    "SELECT CASE o_orderkey % 3 WHEN 0 THEN '1970-01-01' WHEN 1 THEN '01.01.1970' ELSE '1970-01-01T00:00:00' END AS raw, count(*) AS n FROM orders GROUP BY 1",
)(
    lambda t: S.epoch_raw_values(
        t.orders.selectExpr("CASE o_orderkey % 3 WHEN 0 THEN '1970-01-01' WHEN 1 THEN '01.01.1970' ELSE '1970-01-01T00:00:00' END AS x"), "x", top_n=10
    )
)

query(
    "sign_counts",
    f"""SELECT count(d) AS valid, count(*) FILTER (d < 0) AS negative, count(*) FILTER (d = 0) AS zero, count(*) FILTER (d > 0) AS positive
        FROM (SELECT datediff('day', asserted_date, ship_date) AS d FROM ({LINES}))""",
)(lambda t: S.sign_counts(lines(t), "ship_date", "asserted_date"))

QUANTILES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]

# Continuous values: nearly every row has one of its own, and three groups hold all rows.
query(
    "exact_quantiles",
    "SELECT l_returnflag, l_linestatus, "
    + ", ".join(f"round(quantile_cont(l_extendedprice * (1 + l_tax), {p}), 5) AS price_{i}, quantile_disc(l_quantity, {p}) AS quantity_{i}" for i, p in enumerate(QUANTILES))
    + " FROM lineitem GROUP BY ALL",
)(
    lambda t: QT.join_null_safe(
        QT.exact_quantiles(t.lineitem.selectExpr("l_returnflag", "l_linestatus", "l_extendedprice * (1 + l_tax) AS price"), ["l_returnflag", "l_linestatus"], ["price"], QUANTILES),
        QT.exact_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity"], QUANTILES, interpolated=False),
        ["l_returnflag", "l_linestatus"],
    ).select(
        "l_returnflag",
        "l_linestatus",
        *[F.round(F.col("price_quantiles")[i], 5).alias(f"price_{i}") for i in range(len(QUANTILES))],
        *[F.col("l_quantity_quantiles")[i].alias(f"quantity_{i}") for i in range(len(QUANTILES))],
    )
)

_DAYS = f"(SELECT datediff('day', asserted_date, ship_date) AS days FROM ({LINES}))"
query(
    "quantile_summary",
    "SELECT count(*) AS n, min(days)::int AS min, round(avg(days), 6) AS mean, max(days)::int AS max, "
    + ", ".join(f"round(quantile_cont(days, {p}), 6) AS q{round(p * 100):02d}" for p in S.PROBS)
    + f" FROM {_DAYS}",
)(
    lambda t: (
        lambda d: d.select(*[F.round(c, 6).alias(c) if c == "mean" or c[0] == "q" else F.col(c) for c in d.columns])
    )(S.quantile_summary(lines(t).withColumn("days", D.days_between("ship_date", "asserted_date")), "days"))
)

_BREAKS = [*S.DAY_BREAKS, None]
_BINS = " ".join(
    f"WHEN days > {lo} AND days <= {hi} THEN '({lo},{hi}]'" if hi is not None else f"WHEN days > {lo} THEN '({lo},inf)'"
    for lo, hi in zip(_BREAKS, _BREAKS[1:], strict=False)
)
query("day_histogram", f"SELECT CASE {_BINS} END AS bin, count(*) AS n FROM {_DAYS} WHERE days > -1 GROUP BY 1")(
    lambda t: S.day_histogram(lines(t).withColumn("days", D.days_between("ship_date", "asserted_date")), "days")
)

query("seeded_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(concat(o_orderkey, '|42')), o_orderkey LIMIT 20")(lambda t: S.seeded_sample(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 20))

query("tail_rows", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")(
    lambda t: S.head_by(t.events.select("event_id", "user_id", "ts"), ["ts", "event_id"], 20, tail=True).drop("ts")
)

# Federation: every nation is a site.
SITE_SQL = f"""SELECT n_name AS site, cast(year(asserted_date) as int) AS diagnosis_year, count(*) AS "count", sum(cohort_flag)::bigint AS cohort_count
    FROM ({COHORT_SQL}) JOIN orders USING (o_orderkey) JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2"""


def sites(t, by):
    """Cohort rows with their site."""
    home = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("site")
    )
    return cohort(t).join(home, "o_custkey").groupBy("site", *by)


query(
    "merge_sites",
    f'SELECT diagnosis_year, sum("count")::double AS "count", sum(cohort_count)::double AS cohort_count FROM ({SITE_SQL}) GROUP BY 1',
)(
    lambda t: FE.merge_sites(
        sites(t, [F.year("asserted_date").alias("diagnosis_year")]).agg(
            F.count(F.lit(1)).alias("count"), F.sum("cohort_flag").alias("cohort_count")
        ),
        ["diagnosis_year"],
    )
)

FLAGGED_SITE_SQL = f"""SELECT lower(trim(concat(' ', metastasis_kind, ' '))) AS combo_label, CASE WHEN cohort_flag = 1 THEN 'metastatic' ELSE 'non_metastatic' END AS metastatic_flag, count(*)::double AS "count"
    FROM ({KIND_SQL}) GROUP BY 1, 2"""


def flagged_sites(t):
    return FE.merge_sites(
        sites(
            t,
            [
                F.concat(F.lit(" "), C.normalise_set_string("metastasis_loc"), F.lit(" ")).alias("combo_label"),
                F.expr("CASE WHEN cohort_flag = 1 THEN 'METASTATIC' ELSE 'non_metastatic ' END").alias("metastatic_flag"),
            ],
        ).agg(F.count(F.lit(1)).alias("count")),
        ["combo_label", "metastatic_flag"],
        normalise_keys=True,
    )


query("merge_sites_normalised", FLAGGED_SITE_SQL)(flagged_sites)

query(
    "metastatic_pivot",
    f"""SELECT combo_label, coalesce(sum("count") FILTER (metastatic_flag = 'metastatic'), 0) AS metastatic, coalesce(sum("count") FILTER (metastatic_flag = 'non_metastatic'), 0) AS non_metastatic,
        sum("count") AS total FROM ({FLAGGED_SITE_SQL}) GROUP BY 1""",
)(lambda t: FE.split_metastatic_pivot(flagged_sites(t)))

_TAIL_SUMS = ", ".join(f'sum("{c}")::double AS "{c}"' for c in FE.AGE_COUNTS)
query(
    "tail_classes",
    f"""SELECT CASE WHEN age_class < 45 THEN 40 WHEN age_class > 80 THEN 85 ELSE age_class END AS age_class,
        CASE WHEN age_class < 45 THEN '<45' WHEN age_class > 80 THEN '>=85' ELSE concat(age_class, ' - ', age_class + 4) END AS age_class_label, {_TAIL_SUMS},
        sum("count" - gleason_6_count - gleason_7_count - gleason_8_count - gleason_9_count - gleason_10_count)::double AS no_gleason_count FROM ({AGE_SQL}) GROUP BY 1, 2""",
)(lambda t: FE.collapse_tail_classes(S.counts_by_age_class(cohort(t))))

query(
    "min_cell_filter",
    f"SELECT metastasis_kind, overall_count, cohort_count FROM ({METASTASIS_COUNTS_SQL}) WHERE (overall_count > 3 OR cohort_count > 3) AND metastasis_kind <> 'NON'",
)(lambda t: FE.min_cell_filter(S.counts_by_metastasis(cohort(t))).select("metastasis_kind", "overall_count", "cohort_count"))

query("recent_years", 'SELECT cast(year(o_orderdate) as int) AS diagnosis_year, count(*) AS n FROM orders GROUP BY 1 HAVING cast(year(o_orderdate) as int) >= 1998')(
    lambda t: FE.recent_years(t.orders.groupBy(F.year("o_orderdate").alias("diagnosis_year")).agg(F.count(F.lit(1)).alias("n")), since=1998)
)

# Quality reports --------------------------------------------------------------------------------

query(
    "uncoded_medications",
    f"""SELECT concat('drug ', l_partkey % 5) AS "Substanzbezeichnung", '' AS "ATC-Code", count(*) AS "count" FROM lineitem GROUP BY 1""",
)(
    lambda t: QU.uncoded_medications(
        t.lineitem.selectExpr("concat('drug ', l_partkey % 5) AS Substanzbezeichnung")
    )
)

query(
    "uncoded_classifications",
    f"""SELECT concat('class ', {Q} % 7) AS name, {H.pick(Q, ['I', 'II'])} AS stadium, '' AS snomed_code, '' AS snomed_display, '' AS value_snomed_code, '' AS value_snomed_display,
        count(*) AS "count" FROM lineitem WHERE {H.OBS_KIND} = 6 GROUP BY 1, 2""",
)(lambda t: QU.uncoded_classifications(V.uncoded_observations(H.observation(t))))

query(
    "uncoded_side_effects",
    """SELECT event_type AS nebenwirkung_bezeichnung, '' AS snomed_code, '' AS snomed_display, count(*) AS "count" FROM events WHERE event_id % 3 <> 0 GROUP BY 1""",
)(lambda t: QU.uncoded_side_effects(V.uncoded_adverse_events(H.adverse_event(t))))

query("stage_counts", "SELECT 'orders' AS stage, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys FROM orders")(
    lambda t: QU.stage_counts(t.orders, "orders", "o_custkey")
)

query("duplicate_key_report", 'SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY 1 HAVING count(*) > 1')(
    lambda t: QU.duplicate_key_report(t.orders, "o_custkey")
)

# Scalars and sinks ------------------------------------------------------------------------------

query(
    "labelled_text",
    "SELECT event_id, concat('Wirkstoff: ', event_type, ' (Dosis: ', coalesce(CASE WHEN event_id % 3 > 0 THEN cast(user_id as varchar) END, 'nan'), ')') AS label FROM events",
)(
    lambda t: t.events.select(
        "event_id",
        F.concat(
            X.labelled([("Wirkstoff: ", F.col("event_type")), (" (Dosis: ", F.expr("CASE WHEN event_id % 3 > 0 THEN user_id END"))]),
            F.lit(")"),
        ).alias("label"),
    )
)

query("lines_to_bars", "SELECT doc_id, replace(replace(text, chr(13) || chr(10), '|'), chr(10), '|') AS text FROM documents")(
    lambda t: t.documents.select("doc_id", X.lines_to_bars("text").alias("text"))
)

query(
    "joined_arrays",
    "SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS kinds, cast(null as varchar) AS bounds FROM events GROUP BY 1",
)(
    lambda t: SK.joined_arrays(
        t.events.groupBy("user_id").agg(
            F.sort_array(F.collect_set("event_type")).alias("kinds"), F.struct(F.min("ts").alias("a"), F.max("ts").alias("b")).alias("bounds")
        )
    )
)

query(
    "numeric_coercion",
    "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN round(value, 4) END AS number FROM events",
)(
    lambda t: t.events.selectExpr("event_id", "CASE WHEN event_id % 4 = 0 THEN '<0,5' ELSE cast(value as string) END AS v").select(
        "event_id", F.round(F.col("v").try_cast("double"), 4).alias("number")
    )
)

# Federated totals -------------------------------------------------------------------------------


def site_tables(t):
    """The four aggregates of every site, stacked."""

    def counts(by):
        return sites(t, by).agg(
            F.count(F.lit(1)).alias("count"),
            F.count(F.lit(1)).alias("overall_count"),
            F.sum("cohort_flag").alias("cohort_count"),
            *[F.count_if(F.col("gleason_score") == g).alias(f"gleason_{g}_count") for g in S.GLEASON],
        )

    kind = C.normalise_set_string("metastasis_loc")
    flag = F.expr("CASE WHEN cohort_flag = 1 THEN 'metastatic' ELSE 'non_metastatic' END")
    return {
        "diagnosis_year": counts([F.year("asserted_date").alias("diagnosis_year")]),
        "age_class": counts([C.age_class("age_at_diagnosis").alias("age_class")]),
        "metastasis_loc": counts([kind.alias("metastasis_kind")]),
        "therapy_combinations_met": counts([kind.alias("combo_label"), flag.alias("metastatic_flag")]),
    }


query(
    "pca_federated_split",
    f"""SELECT lower(metastasis_kind) AS combo_label, sum(cohort_flag)::double AS metastatic, sum(1 - cohort_flag)::double AS non_metastatic, count(*)::double AS total
        FROM ({KIND_SQL}) GROUP BY 1""",
)(lambda t: pca_federated(site_tables(t))["therapies_metastasis_split"])
query(
    "pca_federated_sites",
    f"""SELECT metastasis_kind, count(*)::double AS overall_count, sum(cohort_flag)::double AS cohort_count FROM ({KIND_SQL}) WHERE metastasis_kind <> 'NON' GROUP BY 1
        HAVING count(*) > 3 OR sum(cohort_flag) > 3""",
)(lambda t: pca_federated(site_tables(t))["metastasis_loc"].select("metastasis_kind", "overall_count", "cohort_count"))
