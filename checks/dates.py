"""Date operators (group F) against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import shape as H
from checks.registry import query
from cohortloom.functions import dates as D
from cohortloom.operators import dates as OD

DAY = H.day("o_orderdate")
GERMAN_DAY = f"concat(substr({DAY}, 9, 2), '.', substr({DAY}, 6, 2), '.', substr({DAY}, 1, 4))"
GERMAN_MONTH = f"concat(substr({DAY}, 6, 2), '.', substr({DAY}, 1, 4))"

# Text of every shape the partial-date parser knows, and some it must refuse.
PARTIAL_TEXT = f"""CASE o_orderkey % 8 WHEN 0 THEN {DAY} WHEN 1 THEN substr({DAY}, 1, 7)
    WHEN 2 THEN substr({DAY}, 1, 4) WHEN 3 THEN {GERMAN_DAY} WHEN 4 THEN {GERMAN_MONTH}
    WHEN 5 THEN concat({DAY}, 'T08:00:00') WHEN 6 THEN concat(substr({DAY}, 1, 4), '-02-31') END"""
PARTIAL_PRECISION = """CASE WHEN o_orderkey % 8 IN (0, 3, 6) THEN 'DAY' WHEN o_orderkey % 8 IN (1, 4) THEN 'MONTH'
    WHEN o_orderkey % 8 = 2 THEN 'YEAR' END"""
PARTIAL_RESULT = f"""CASE WHEN o_orderkey % 8 IN (0, 3) THEN {DAY}
    WHEN o_orderkey % 8 IN (1, 4) THEN concat(substr({DAY}, 1, 7), '-15')
    WHEN o_orderkey % 8 = 2 THEN concat(substr({DAY}, 1, 4), '-07-01') END"""


def strings(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def stamps(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})


def months(a: str, b: str) -> str:
    """months_between of two dates in SQL."""
    return (
        f"(12 * (year({a}) - year({b})) + month({a}) - month({b}) + CASE WHEN day({a}) = day({b}) "
        f"OR (last_day({a}) = {a} AND last_day({b}) = {b}) THEN 0 "
        f"ELSE (day({a}) - day({b})) / cast(31 as double) END)"
    )


query(
    "partial_dates",
    f"SELECT o_orderkey, {PARTIAL_PRECISION} AS prec, {PARTIAL_RESULT} AS parsed FROM orders",
)(
    lambda t: t.orders.selectExpr("o_orderkey", f"{PARTIAL_TEXT} AS text").select(
        "o_orderkey",
        D.date_precision("text").alias("prec"),
        D.parse_partial_date("text").cast("string").alias("parsed"),
    )
)

query(
    "partial_dates_with_datetimes",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 5 THEN {DAY} ELSE {PARTIAL_RESULT} END AS parsed FROM orders""",
)(
    lambda t: t.orders.selectExpr("o_orderkey", f"{PARTIAL_TEXT} AS text").select(
        "o_orderkey", D.parse_partial_date("text", allow_datetime=True).cast("string").alias("parsed")
    )
)

query(
    "cast_dates",
    f"""SELECT o_orderkey, {PARTIAL_RESULT} AS asserted_date, {PARTIAL_PRECISION} AS asserted_date_precision,
        {DAY} AS recorded_date, 'DAY' AS recorded_date_precision FROM orders""",
)(
    lambda t: strings(
        OD.cast_dates(
            t.orders.selectExpr(
                "o_orderkey", f"{PARTIAL_TEXT} AS asserted_date", f"{DAY} AS recorded_date"
            ),
            ["asserted_date", "recorded_date"],
        ),
        "asserted_date",
        "recorded_date",
    )
)

MIXED_TEXT = f"""CASE o_orderkey % 12 WHEN 0 THEN {DAY} WHEN 1 THEN concat(' ', {DAY}, 'T23:59:00+01:00')
    WHEN 2 THEN substr({DAY}, 1, 7) WHEN 3 THEN substr({DAY}, 1, 4) WHEN 4 THEN {GERMAN_DAY}
    WHEN 5 THEN replace({GERMAN_DAY}, '.', '/') WHEN 6 THEN replace({DAY}, '-', '/')
    WHEN 7 THEN cast(datediff(cast(o_orderdate as date), date'1899-12-30') as string)
    WHEN 8 THEN cast(datediff(cast(o_orderdate as date), date'1970-01-01') * 86400L as string)
    WHEN 9 THEN cast(datediff(cast(o_orderdate as date), date'1970-01-01') * 86400000L as string)
    WHEN 10 THEN '0' ELSE '' END"""


def mixed_sql(month: str, year: str) -> str:
    full = f"""CASE WHEN o_orderkey % 12 IN (0, 1, 4, 5, 6, 7, 8, 9) THEN {DAY}
        WHEN o_orderkey % 12 = 2 THEN concat(substr({DAY}, 1, 7), '{month}')
        WHEN o_orderkey % 12 = 3 THEN concat(substr({DAY}, 1, 4), '{year}') END"""
    return f"""SELECT o_orderkey, {full} AS parsed, CASE WHEN o_orderkey % 12 IN (0, 1) THEN 'day'
        WHEN o_orderkey % 12 = 2 THEN 'month' WHEN o_orderkey % 12 = 3 THEN 'year' ELSE 'unknown' END AS prec
        FROM orders"""


def mixed(t, fill: str) -> DataFrame:
    rows = t.orders.selectExpr("o_orderkey", f"{MIXED_TEXT} AS text")
    p = rows.select("o_orderkey", D.parse_mixed_date("text", fill).alias("p"))
    return p.select("o_orderkey", F.col("p.date").cast("string").alias("parsed"), F.col("p.precision").alias("prec"))


query("mixed_dates_mid", mixed_sql("-15", "-07-01"))(lambda t: mixed(t, "mid"))
query("mixed_dates_start", mixed_sql("-01", "-01-01"))(lambda t: mixed(t, "start"))

query(
    "prefix_date",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 5) THEN {DAY} END AS parsed FROM orders",
)(
    lambda t: t.orders.selectExpr("o_orderkey", f"{PARTIAL_TEXT} AS text").select(
        "o_orderkey", D.prefix_date("text").cast("string").alias("parsed")
    )
)

PEOPLE_SQL = f"""SELECT o_orderkey, o_custkey, cast(o_orderdate as date) AS asserted_date,
    cast({H.BIRTHDATE_DUCK} as date) AS birthdate FROM orders JOIN customer ON c_custkey = o_custkey"""


def people(t) -> DataFrame:
    """Conditions with day-precise dates beside their patients."""
    born = t.customer.selectExpr(
        "c_custkey AS o_custkey", f"cast({H.BIRTHDATE} as date) AS birthdate", f"{H.GENDER} AS gender"
    )
    return t.orders.selectExpr(
        "o_orderkey", "o_custkey", "cast(o_orderdate as date) AS asserted_date", f"{H.ICD} AS icd10_code"
    ).join(born, "o_custkey")


query(
    "age_at_diagnosis",
    f"""SELECT o_orderkey, round(datediff('day', birthdate, asserted_date) / cast(365.25 as double), 2) AS age_at_diagnosis
        FROM ({PEOPLE_SQL})""",
)(lambda t: OD.compute_age(people(t)).select("o_orderkey", "age_at_diagnosis"))

LINES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) AS ship_date,
    cast(o_orderdate as date) AS asserted_date FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


def lines(t) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(l_shipdate as date) AS ship_date"
    ).join(
        t.orders.selectExpr("o_orderkey AS l_orderkey", "cast(o_orderdate as date) AS asserted_date"),
        "l_orderkey",
    )


query(
    "months_diff",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({months('ship_date', 'asserted_date')}, 2) AS ship_date_diff FROM ({LINES})",
)(
    lambda t: OD.months_diff(lines(t), "ship_date", "asserted_date").drop("ship_date", "asserted_date")
)

query(
    "months_to_reference_all",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        round({months('ship_date', 'asserted_date')}, 2) AS months_between_asserted_ship_date,
        round({months('(ship_date + 40)', 'asserted_date')}, 2) AS months_between_asserted_end_date,
        cast(year(asserted_date) as int) AS asserted_year FROM ({LINES})""",
)(
    lambda t: OD.drop_date_columns(
        OD.year_columns(
            OD.months_to_reference_all(lines(t).withColumn("end_date", F.date_add("ship_date", 40)))
        )
    )
)

query(
    "year_range",
    "SELECT cast(min(year(o_orderdate)) as int) AS year_min, cast(max(year(o_orderdate)) as int) AS year_max FROM orders",
)(lambda t: OD.year_range(people(t)))

query(
    "date_range_profile",
    f"""SELECT count(DISTINCT o_custkey) AS n_patients, cast(min(asserted_date) as varchar) AS min_asserted_date,
        cast(max(asserted_date) as varchar) AS max_asserted_date, cast(min(birthdate) as varchar) AS min_birthdate,
        cast(max(birthdate) as varchar) AS max_birthdate FROM ({PEOPLE_SQL})""",
)(
    lambda t: strings(
        OD.date_range_profile(people(t), ["asserted_date", "birthdate"], "o_custkey"),
        "min_asserted_date",
        "max_asserted_date",
        "min_birthdate",
        "max_birthdate",
    )
)

query(
    "month_threshold",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        asserted_date <= ship_date - INTERVAL 3 MONTH AS early FROM ({LINES})""",
)(
    lambda t: lines(t)
    .withColumn("early", D.at_least_months_before("asserted_date", "ship_date", 3))
    .drop("ship_date", "asserted_date")
)

query(
    "shift_days",
    "SELECT event_id, strftime(ts - INTERVAL 17 DAY, '%Y-%m-%d %H:%M:%S') AS shifted FROM events",
)(
    lambda t: t.events.select(
        "event_id", F.date_format(D.shift_days("ts", -17), "yyyy-MM-dd HH:mm:ss").alias("shifted")
    )
)

query(
    "combine_date_time",
    """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') END AS combined
        FROM events""",
)(
    lambda t: stamps(
        t.events.selectExpr(
            "event_id",
            "CASE WHEN event_id % 10 = 0 THEN '31.02.2024' ELSE date_format(ts, 'dd.MM.yyyy') END AS d",
            "date_format(ts, 'HH:mm') AS m",
        ).select("event_id", D.combine_date_time("d", "m").alias("combined")),
        "combined",
    )
)

# Events spread over two years of local time; the two switching nights come out exactly.
LOCAL_DUCK = """(date_trunc('hour', CASE WHEN event_id % 50 = 0 THEN timestamp '2024-03-31 02:30:00'
    WHEN event_id % 50 = 1 THEN timestamp '2024-10-27 02:30:00' ELSE ts END) + INTERVAL 30 MINUTE
    + CASE WHEN event_id % 50 > 1 THEN INTERVAL (cast(event_id % 300 as int)) DAY ELSE INTERVAL 0 DAY END)"""
query(
    "localize_berlin",
    f"""WITH x AS (SELECT event_id, {LOCAL_DUCK} AS x FROM events)
        SELECT event_id, strftime(CASE
            WHEN x >= timestamp '2024-03-31 02:00:00' AND x < timestamp '2024-03-31 03:00:00' THEN timestamp '2024-03-31 01:00:00'
            WHEN x >= timestamp '2024-10-27 02:00:00' AND x < timestamp '2024-10-27 03:00:00' THEN NULL
            WHEN x >= timestamp '2024-03-31 03:00:00' AND x < timestamp '2024-10-27 02:00:00' THEN x - INTERVAL 2 HOUR
            ELSE x - INTERVAL 1 HOUR END, '%Y-%m-%d %H:%M:%S') AS instant FROM x""",
)(
    lambda t: stamps(
        t.events.selectExpr(
            "event_id",
            """date_trunc('hour', CASE WHEN event_id % 50 = 0 THEN timestamp_ntz'2024-03-31 02:30:00'
                WHEN event_id % 50 = 1 THEN timestamp_ntz'2024-10-27 02:30:00' ELSE ts END)
                + INTERVAL '30' MINUTE
                + CASE WHEN event_id % 50 > 1 THEN make_dt_interval(cast(event_id % 300 as int)) ELSE INTERVAL '0' DAY END AS x""",
        ).select("event_id", D.localize("x").alias("instant")),
        "instant",
    )
)

query(
    "split_datetime",
    """SELECT event_id, strftime(ts, '%d.%m.%Y') AS datum, strftime(ts, '%H:%M') AS zeit FROM events""",
)(
    lambda t: t.events.selectExpr("event_id", "date_format(ts, 'dd.MM.yyyy HH:mm') AS text").select(
        "event_id",
        D.split_datetime("text")[0].alias("datum"),
        D.split_datetime("text")[1].alias("zeit"),
    )
)

ISO_TEXT = f"""CASE o_orderkey % 6 WHEN 0 THEN {DAY} WHEN 1 THEN concat({DAY}, 'T10:30:00+01:00')
    WHEN 2 THEN concat({DAY}, 'T10:30:00Z') WHEN 3 THEN '9999-12-31' WHEN 4 THEN 'unbekannt' END"""
ISO_RESULT = f"""CASE o_orderkey % 6 WHEN 0 THEN concat({DAY}, ' 00:00:00') WHEN 1 THEN concat({DAY}, ' 09:30:00')
    WHEN 2 THEN concat({DAY}, ' 10:30:00') END"""
query(
    "parse_iso",
    f"SELECT o_orderkey, {ISO_RESULT} AS parsed, o_orderkey % 6 IN (3, 4) AS failed FROM orders",
)(
    lambda t: stamps(
        t.orders.selectExpr("o_orderkey", f"{ISO_TEXT} AS text").select(
            "o_orderkey", D.parse_iso("text").alias("parsed"), D.parse_failed("text").alias("failed")
        ),
        "parsed",
    )
)

query(
    "default_time_zone",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN strftime(o_orderdate - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')
        WHEN o_orderkey % 6 IN (1, 2) THEN {ISO_RESULT} END AS parsed FROM orders""",
)(
    lambda t: stamps(
        t.orders.selectExpr("o_orderkey", f"{ISO_TEXT} AS text").select(
            "o_orderkey", D.default_time_zone("text").alias("parsed")
        ),
        "parsed",
    )
)

query(
    "days_between",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(datediff('day', asserted_date, ship_date) as bigint) AS days FROM ({LINES})",
)(
    lambda t: lines(t)
    .withColumn("days", D.days_between("ship_date", "asserted_date").cast("bigint"))
    .drop("ship_date", "asserted_date")
)

query(
    "mixed_dayfirst",
    """SELECT event_id, strftime(CASE event_id % 4 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('minute', ts)
        WHEN 2 THEN date_trunc('day', ts) END, '%Y-%m-%d %H:%M:%S') AS parsed FROM events""",
)(
    lambda t: stamps(
        t.events.selectExpr(
            "event_id",
            """CASE event_id % 4 WHEN 0 THEN date_format(ts, 'dd.MM.yyyy') WHEN 1 THEN date_format(ts, 'dd.MM.yyyy HH:mm')
                WHEN 2 THEN date_format(ts, 'yyyy-MM-dd') ELSE 'x' END AS text""",
        ).select("event_id", D.mixed_dayfirst("text").alias("parsed")),
        "parsed",
    )
)

query("birth_year", f"SELECT c_custkey, cast(year(cast({H.BIRTHDATE_DUCK} as date)) as int) AS birth_year FROM customer")(
    lambda t: t.customer.selectExpr("c_custkey", f"cast({H.BIRTHDATE} as date) AS b").select(
        "c_custkey", D.birth_year("b").alias("birth_year")
    )
)
