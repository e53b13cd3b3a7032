"""Sources and streams (groups A and M) against SQL."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from checks import shape as H
from checks import views as VQ
from checks.deid import KEY, hmac_sql
from checks.registry import query
from cohortloom.operators import views as V
from cohortloom.session import new_shared_path
from cohortloom.sources import delimited as DL
from cohortloom.sources import registry as RG
from cohortloom.sources import resources as RS
from cohortloom.streaming import state as SA
from cohortloom.streaming import streams as ST


def bundles(t):
    """One bundle text per order with its condition and its patient."""

    def resource(df, kind, keep):
        fields = [c for c in df.columns if c not in keep]
        return df.select(*keep, F.to_json(F.struct(F.lit(kind).alias("resourceType"), *fields)).alias(kind))

    # The tables' own columns are joined; texts, many times as long, are written out behind the joins.
    numbers = t.orders.selectExpr("o_orderkey", "o_custkey AS c_custkey")
    joined = t.orders.join(numbers, "o_orderkey").join(t.customer, "c_custkey")
    known = t.customer.columns
    conditions = resource(H.condition(SimpleNamespace(orders=joined), known), "Condition", known)
    both = resource(H.patient(SimpleNamespace(customer=conditions), ["Condition"]), "Patient", ["Condition"])
    text = F.concat(
        F.lit('{"resourceType":"Bundle","type":"transaction","entry":[{"fullUrl":"urn:1","resource":'),
        "Condition",
        F.lit('},{"resource":'),
        "Patient",
        F.lit("}]}"),
    )
    # A list of one keeps conditions on the text from writing it out a second time.
    return both.select(F.explode(F.array(text)).alias("value"))


query("bundle_conditions", VQ.CONDITION_SQL)(
    lambda t: V.conditions(RS.parse_resources(RS.bundle_entries(bundles(t)), "Condition"))
)
query(
    "bundle_entry_counts",
    "SELECT 'Condition' AS resource_type, count(*) AS n FROM orders UNION ALL SELECT 'Patient', count(*) FROM orders",
)(
    lambda t: RS.bundle_entries(bundles(t)).groupBy("resource_type").agg(F.count(F.lit(1)).alias("n"))
)

query(
    "server_page_filter",
    "SELECT concat('Patient/', user_id) AS ref, event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)",
)(
    lambda t: RS.server_page_filter(
        t.events.selectExpr("concat('Patient/', user_id) AS ref", "event_id"),
        t.customer.where("c_custkey % 3 = 0").selectExpr("concat('Patient/', c_custkey) AS k"),
        F.col("ref"),
    )
)

XML_PATIENT = """concat('<Patient><Patienten_Stammdaten Patient_ID="', c_custkey, '"><Patienten_Geschlecht>', CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'W' END,
    '</Patienten_Geschlecht></Patienten_Stammdaten><Menge_Meldung><Meldung Meldung_ID="m', c_custkey, '"><Meldedatum>10.03.2015</Meldedatum>',
    '<Tumorzuordnung Tumor_ID="1"><Primaertumor_ICD_Code>C', lpad(cast(c_custkey % 97 as string), 2, '0'), '</Primaertumor_ICD_Code></Tumorzuordnung>',
    CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('<Diagnose Tumor_ID="1"><Menge_Histologie><Histologie Histologie_ID="h1"><Grading>B</Grading></Histologie>',
        CASE WHEN c_custkey % 3 = 2 THEN '<Histologie Histologie_ID="h2"><Morphologie_Code>8460/2</Morphologie_Code></Histologie>' ELSE '' END,
        '</Menge_Histologie><cTNM TNM_ID="t"><TNM_T>1c</TNM_T></cTNM></Diagnose>') END, '</Meldung></Menge_Meldung></Patient>')"""
query(
    "registry_reports",
    """SELECT cast(c_custkey as varchar) AS patient_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'W' END AS gender, concat('m', c_custkey) AS report_id,
        concat('C', lpad(cast(c_custkey % 97 as varchar), 2, '0')) AS icd10_code, h AS histology_id, CASE WHEN h = 'h1' THEN 'B' END AS grading,
        CASE WHEN h = 'h2' THEN '8460/2' END AS morphology, CASE WHEN h IS NOT NULL THEN '1c' END AS c_t
        FROM customer LEFT JOIN (VALUES ('h1', 1), ('h1', 2), ('h2', 2)) v(h, k) ON c_custkey % 3 = k""",
)(
    lambda t: RG.registry_reports(
        RG.parse_registry_xml(t.customer.selectExpr(f"{XML_PATIENT} AS xml"), "xml")
    ).select("patient_id", "gender", "report_id", "icd10_code", "histology_id", "grading", "morphology", "c_t")
)

query("read_increment", "SELECT event_id, user_id FROM events WHERE ts > timestamp '2024-01-15 00:00:00'")(
    lambda t: RG.read_increment(
        t.events.select("event_id", "user_id", "ts"), "ts", F.lit("2024-01-15").cast("timestamp_ntz")
    ).drop("ts")
)
query("next_offset", "SELECT max(event_id) AS last, count(*) AS n_rows FROM events WHERE event_id > 100")(
    lambda t: RG.next_offset(RG.read_increment(t.events, "event_id", 100), "event_id")
)

query("code_book", "SELECT p_brand AS code, p_name AS title FROM part WHERE p_partkey % 3 > 0")(
    lambda t: DL.code_book(
        t.part.selectExpr(
            "CASE WHEN p_partkey % 3 = 0 THEN concat('heading;', p_type) ELSE concat_ws(';', '1', '2', '3', '4', '5', '6', p_brand, 'x', p_name, '') END AS value"
        )
    )
)
query(
    "raw_field",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN concat('\"', s_name) END AS field FROM supplier",
)(
    lambda t: t.supplier.selectExpr(
        "s_suppkey", "CASE WHEN s_suppkey % 2 = 0 THEN concat('1;\"', s_name, ';3') ELSE '1' END AS line"
    ).select("s_suppkey", DL.raw_field("line", 1).alias("field"))
)

# Streams: the given event file is the source; state goes to the shared folder.


def event_stream(t):
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)


def paths(t, *labels):
    return [new_shared_path(t.spark, x) for x in labels]


@query(
    "upsert_latest",
    "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2",
)
def upsert_latest(t):
    root, checkpoint = paths(t, "state", "progress")
    key, order = ["user_id", "event_type"], ["ts", "event_id"]
    ST.upsert_latest(event_stream(t), root, checkpoint, key, order).awaitTermination()
    return SA.current_state(t.spark, root).select("user_id", "event_type", "event_id")


@query(
    "upsert_in_batches",
    "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM events GROUP BY 1, 2",
)
def upsert_in_batches(t):
    """Seven batches in the order of their numbers, not of time; each runs twice."""
    (root,) = paths(t, "state")
    for i in range(7):
        for again in (False, True):
            batch = t.events.where(F.col("event_id") % 7 == i).select("user_id", "event_type", "event_id", "ts")
            if SA.upsert_batch(batch, i, root, ["user_id", "event_type"], ["ts", "event_id"], buckets=8) == again:
                raise AssertionError(f"batch {i} was {'written again' if again else 'left out'}")
    SA.drop_old_versions(t.spark, root, keep=1)
    return SA.current_state(t.spark, root)


@query("poll_increment", "SELECT event_id, user_id FROM events WHERE event_id > 50")
def poll_increment(t):
    target, checkpoint = new_shared_path(t.spark, "increment"), new_shared_path(t.spark, "progress")
    changed = RG.read_increment(event_stream(t), "event_id", 50).select("event_id", "user_id")
    ST.poll_increment(changed, target, checkpoint).awaitTermination()
    return t.spark.read.schema("event_id long, user_id long").parquet(target)


@query(
    "route_topics",
    f"""SELECT event_id, concat('fhir.pseudonymized.', event_type) AS topic, {hmac_sql('cast(user_id as varchar)')} AS key FROM events""",
)
def route_topics(t):
    root, checkpoint = paths(t, "topics", "progress")
    messages = event_stream(t).selectExpr("event_id", "concat('fhir.', event_type) AS topic", "cast(user_id as string) AS key")
    ST.route_stream(messages, root, checkpoint, KEY).awaitTermination()
    return ST.read_routed(t.spark, root, "event_id bigint, key string")


@query("stream_dq_counts", 'SELECT event_type AS nebenwirkung_bezeichnung, count(*) AS "count" FROM events WHERE event_id % 3 <> 0 GROUP BY 1')
def stream_dq_counts(t):
    root, checkpoint = paths(t, "counts", "progress")
    by = ["nebenwirkung_bezeichnung"]
    uncoded = V.uncoded_adverse_events(H.adverse_event(SimpleNamespace(events=event_stream(t))))
    ST.keep_counts(ST.stream_dq_counts(uncoded, by), root, checkpoint, by, buckets=4).awaitTermination()
    return SA.current_state(t.spark, root)


@query(
    "stream_daily_counts",
    """SELECT date_trunc('day', ts)::timestamp AS window_start, event_type, count(*) AS "count" FROM events GROUP BY ALL""",
)
def stream_daily_counts(t):
    root, checkpoint = paths(t, "counts", "progress")
    events = event_stream(t).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    ST.keep_counts(ST.stream_dq_counts(events, ["event_type"], "ts"), root, checkpoint, ["window_start", "event_type"]).awaitTermination()
    return SA.current_state(t.spark, root)


# Packed text can't be split, so one task reads a file: its rows are bounded (0.7 GB of bundles of 1.4 kB).
BUNDLES_A_FILE = 500_000


@query(
    "stream_bundles",
    f"""SELECT {hmac_sql("cast(o_orderkey as varchar)")} AS id, concat('Patient/', {hmac_sql("cast(o_custkey as varchar)")}) AS subject FROM orders""",
)
def stream_bundles(t):
    source, target, checkpoint = paths(t, "bundles", "resources", "progress")
    # Bundles are many times as long as the rows they are made of, and much of them is the same in each.
    bundles(t).write.option("compression", "lz4").option("maxRecordsPerFile", BUNDLES_A_FILE).text(source)
    arriving = t.spark.readStream.schema("value string").option("maxFilesPerTrigger", 3).text(source)
    resources = ST.stream_pseudonymise(ST.stream_resources(arriving, "Condition"), KEY)
    ST.poll_increment(resources.select("id", F.col("subject.reference").alias("subject")), target, checkpoint).awaitTermination()
    return t.spark.read.schema("id string, subject string").parquet(target)


query(
    "stream_resources_pseudonymised",
    f"""SELECT {hmac_sql("cast(o_orderkey as varchar)")} AS id, concat('Patient/', {hmac_sql("cast(o_custkey as varchar)")}) AS subject FROM orders""",
)(
    lambda t: ST.stream_pseudonymise(ST.stream_resources(bundles(t), "Condition"), KEY).select(
        "id", F.col("subject.reference").alias("subject")
    )
)
