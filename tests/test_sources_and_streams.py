"""Readers, writers and streams on files."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.dictionary import TABLES
from cohortloom.functions.deid import hmac_sha256
from cohortloom.operators import views as V
from cohortloom.operators.letters import rebuild_tables
from cohortloom.plans.run_all import run_study
from cohortloom.schemas import RESOURCE_TYPES, schema_of
from cohortloom.session import materialise
from cohortloom.sources import delimited as DL
from cohortloom.sources import lines as LN
from cohortloom.sources import registry as RG
from cohortloom.sources import resources as RS
from cohortloom.sources import sinks as SK
from cohortloom.streaming import state as SA
from cohortloom.streaming import streams as ST


def test_bundles_one_per_line_and_lake(spark, tmp_path, rows):
    lines = [
        {"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Patient", "id": f"{i}", "gender": "male"}}]} for i in range(3)
    ] + [{"resourceType": "Bundle"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.ndjson").write_text("\n".join(json.dumps(x) for x in lines))
    got = RS.read_bundles(spark, str(tmp_path / "in"), ["Patient", "Condition"], one_per_line=True)
    assert rows(V.patients(got["Patient"]), "patient_resource_id", "gender") == [(f"Patient/{i}", "male") for i in range(3)]
    assert got["Condition"].count() == 0
    got["Patient"].write.parquet(str(tmp_path / "lake" / "Patient"))
    assert RS.read_lake(spark, str(tmp_path / "lake"), "Patient").schema == schema_of("Patient")


def test_views_over_a_lake_open_only_their_partition(spark, tmp_path, rows):
    from checks import shape
    from checks.registry import Tables

    observations = shape.observation(Tables(spark, "/root/testdata/sf0.001"))
    RS.write_lake(observations, str(tmp_path), "Observation")
    stored = RS.read_lake(spark, str(tmp_path), "Observation")
    for make in (V.deaths, V.tnm_nm_staging, V.performance_status, V.labs, V.uncoded_observations, V.other_classifications):
        assert rows(make(stored)) == rows(make(observations)), make.__name__
    plan = V.metastases(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [kind" in plan and "metastasis" in plan


def test_ndjson(spark, tmp_path):
    (tmp_path / "e.ndjson").write_text('{"resourceType":"Encounter","id":"1","status":"finished","class":{"code":"IMP"},"unknown":5}\n')
    assert RS.read_ndjson(spark, str(tmp_path / "e.ndjson"), "Encounter").first()["class"]["code"] == "IMP"


def test_schemas_are_declared():
    assert all(schema_of(t)["id"].dataType.typeName() == "string" for t in RESOURCE_TYPES)


def test_registry_xml(spark, tmp_path, rows):
    (tmp_path / "r.xml").write_text(
        """<?xml version="1.0"?><ADT xmlns="urn:x"><Menge_Patient><Patient><Patienten_Stammdaten Patient_ID="007"><Patienten_Geschlecht>W</Patienten_Geschlecht></Patienten_Stammdaten>
        <Menge_Meldung><Meldung Meldung_ID="m"><Tumorzuordnung Tumor_ID="1"><Primaertumor_ICD_Code>D07.3</Primaertumor_ICD_Code><Diagnosedatum>08.08.2015</Diagnosedatum></Tumorzuordnung>
        <Diagnose Tumor_ID="1"><Menge_Histologie><Histologie Histologie_ID="1"><Grading>B</Grading></Histologie><Histologie Histologie_ID="2"/></Menge_Histologie><cTNM TNM_ID="k"><TNM_T>is</TNM_T></cTNM></Diagnose></Meldung>
        <Meldung Meldung_ID="n"/></Menge_Meldung></Patient></Menge_Patient></ADT>"""
    )
    df = RG.registry_reports(RG.read_registry_xml(spark, str(tmp_path / "r.xml")))
    assert rows(df, "patient_id", "report_id", "icd10_code", "histology_id", "c_t") == [
        ("007", "m", "D07.3", "1", "is"),
        ("007", "m", "D07.3", "2", "is"),
        ("007", "n", None, None, None),
    ]


def test_delimited(spark, tmp_path, rows):
    p = tmp_path
    (p / "t.csv").write_bytes("a;b\nä;1\nö;x\n".encode("latin1"))
    assert rows(DL.read_csv_table(spark, str(p / "t.csv"), "a string, b string", encoding="ISO-8859-1"), "a") == [("ä",), ("ö",)]
    (p / "codes.csv").write_text("icd_code\nC92.0\n C92.1 \nC92.0\n")
    assert rows(DL.read_code_list(spark, str(p / "codes.csv"))) == [("C92.0",), ("C92.1",)]
    (p / "book.txt").write_text("1;chapter\n" + ";".join("abcdef") + ";5-604;h;Title;z\n")
    assert rows(DL.read_fixed_code_file(spark, str(p / "book.txt"))) == [("5-604", "Title")]
    (p / "raw.csv").write_text('x;"Name";z\n1;"broken;3\n2\n')
    assert rows(DL.read_raw_column(spark, str(p / "raw.csv"), "Name")) == [('"broken', False), (None, True)]
    (p / "u1.csv").write_text("a;b\n1;2\n")
    (p / "u2.csv").write_text("b;c\n3;4\n")
    assert rows(DL.union_csv_files(spark, [str(p / "u1.csv"), str(p / "u2.csv")])) == [("1", "2", None), (None, "3", "4")]
    (p / "m.csv").write_text("k;count\nx;3.0\n")
    assert rows(DL.read_merged(spark, str(p), ["m.csv"])["m.csv"]) == [("x", 3)]


def test_sinks(spark, tmp_path, rows):
    layout = SK.StudyLayout(str(tmp_path), "s")
    assert layout.csv("x", True).endswith("s/deidentified/df_x.csv") and "deidentified" not in layout.parquet("x")
    df = spark.createDataFrame([(["a", "b"], 'q"\\'), (None, "z")], "l array<string>, t string")
    SK.write_csv(df, layout.csv("x"), single_file=True)
    back = spark.read.option("sep", ";").option("header", True).csv(layout.csv("x"))
    assert rows(back, "l") == [(None,), ("a|b",)]
    SK.write_quoted_csv(df.select("t"), str(tmp_path / "quoted"))
    lines = "".join(f.read_text() for f in (tmp_path / "quoted").glob("part-*.csv"))
    assert '"t"' in lines and '"z"' in lines
    SK.write_parquet(df, layout.parquet("x"))
    assert spark.read.parquet(layout.parquet("x")).count() == 2
    dictionary = SK.data_dictionary(spark, {"t": {"a": "A", "b": "B"}})
    assert rows(dictionary) == [("t", "a", "A"), ("t", "b", "B")]
    everything = SK.data_dictionary(spark, TABLES)
    assert everything.count() == everything.select("table_name", "column_name").distinct().count() > 60
    assert SK.describe_columns(df, {"t": "text"}).schema["t"].metadata == {"comment": "text"}


@pytest.fixture
def tiny_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64b")
    yield
    spark.conf.set(name, before)


def test_line_numbers_over_splits_and_files(spark, tmp_path, rows, tiny_splits):
    rng = random.Random(8)
    want = []
    for f in "abc":
        lines = ["".join(rng.choices("xyz ä", k=rng.choice([0, 3, 40, 200]))) for _ in range(rng.randrange(60))]
        (tmp_path / f).write_bytes(b"".join(x.encode() + rng.choice([b"\n", b"\r\n"]) for x in lines))
        want += [(f, i + 1, x) for i, x in enumerate(lines)]
    df = LN.numbered_lines(spark, str(tmp_path)).withColumn("file", F.element_at(F.split("file", "/"), -1))
    assert df.rdd.getNumPartitions() > 3
    assert rows(df, "file", "line", "value") == sorted(want, key=lambda t: tuple(str(x) for x in t))


def test_records_keep_quoted_line_breaks(spark, tmp_path, rows, tiny_splits):
    rng = random.Random(9)
    want = []
    for f in "ab":
        table = [["k", "text", "n"], *[[str(i), rng.choice(["plain", 'a "quoted"; word', "two\nlines", "\n\nthree; \"\n", "x" * 150]), ""] for i in range(80)]]
        with open(tmp_path / f, "w", newline="") as out:
            for row in table:
                csv.writer(out, delimiter=";", lineterminator="\n").writerow(row)
                if rng.random() < 0.2:
                    out.write("\n")  # a blank line between records
        got = [(int(r["row_number"]), r["k"], r["text"], r["n"]) for r in LN.read_numbered_csv(spark, str(tmp_path / f)).collect()]
        assert sorted(got) == [(i, *[c or None for c in row]) for i, row in enumerate(table) if i]
        want += [(f, i + 1) for i in range(len(table))]
    both = LN.numbered_records(spark, str(tmp_path)).withColumn("file", F.element_at(F.split("file", "/"), -1))
    assert rows(both, "file", "record") == sorted(want, key=lambda t: tuple(str(x) for x in t))
    (tmp_path / "open").write_text('a;b\n1;"x\n2;y\n')
    with pytest.raises(Exception, match="a quote is not closed in"):
        LN.numbered_records(spark, str(tmp_path / "open")).collect()


def test_column_of_a_second_file(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id;drug\n1;"x;\ny"\n2;z\n')
    (tmp_path / "b.csv").write_text('id;code;drug\n1;"A;q\n2\n')
    found = DL.add_raw_column(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), "code")
    assert rows(found, "row_number", "id", "drug", "code") == [(1, "1", "x;\ny", '"A'), (2, "2", "z", None)]
    (tmp_path / "b.csv").write_text("id;code\n1;A\n")
    with pytest.raises(Exception, match="row without partner: 2"):
        DL.add_raw_column(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), "code").collect()


def test_materialised_tables_use_the_shared_folder(spark, shared):
    out = materialise(spark.range(5), "five")
    assert out.count() == 5 and shared in out.inputFiles()[0]


def write_event(folder, name, rows_):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("id", "v", "at"), r, strict=True))) for r in rows_))


def test_upsert_is_idempotent(spark, tmp_path, rows):
    source, root, progress = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "progress")
    key, order = ["id"], ["at"]

    def run(checkpoint):
        stream = spark.readStream.schema("id string, v int, at long").json(str(source))
        ST.upsert_latest(stream, root, checkpoint, key, order, buckets=4).awaitTermination()

    write_event(source, "1.json", [("a", 1, 1), ("a", 2, 3), ("b", 1, 1)])
    run(progress)
    write_event(source, "2.json", [("a", 9, 2), ("b", 5, 7), ("c", 1, 1)])
    run(progress)
    want = [("a", 2, 3), ("b", 5, 7), ("c", 1, 1)]
    assert rows(SA.current_state(spark, root), "id", "v", "at") == want
    # The same batches again from scratch are known and change nothing.
    run(str(tmp_path / "progress2"))
    assert rows(SA.current_state(spark, root), "id", "v", "at") == want


def test_state_is_one_set_of_buckets_whatever_happened(spark, tmp_path, rows, monkeypatch):
    root = str(tmp_path / "state")
    rng = random.Random(3)
    best: dict[str, tuple] = {}

    def batch(i):
        made = [(rng.choice("abcdefghijklm"), i * 100 + j, rng.choice([None, *range(50)])) for j in range(20)]
        return made, spark.createDataFrame(made, "k string, v int, at int")

    def note(made):
        for k, v, at in made:
            best[k] = max(best.get(k, (-2, 0)), (-1 if at is None else at, v))

    for i in range(6):
        made, df = batch(i)
        if i == 3:  # the writer is lost after its data and before its manifest
            with monkeypatch.context() as m:
                m.setattr(SA.files, "write_small", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError, match="lost"):
                    SA.upsert_batch(df, i, root, ["k"], ["at", "v"], buckets=8)
            assert rows(SA.current_state(spark, root), "k", "v") == sorted((k, v) for k, (_, v) in best.items())
        assert SA.upsert_batch(df, i, root, ["k"], ["at", "v"], buckets=8)
        note(made)
        assert not SA.upsert_batch(df, i, root, ["k"], ["at", "v"])
        assert rows(SA.current_state(spark, root), "k", "v") == sorted((k, v) for k, (_, v) in best.items())
    state = SA.current_state(spark, root)
    assert len({f.rsplit("/", 2)[1] for f in state.inputFiles()}) <= 8 and state.count() == len(best)
    assert SA.upsert_batch(batch(9)[1].limit(0), 9, root, ["k"], ["at", "v"])  # nothing is touched
    assert SA.drop_old_versions(spark, root, keep=1) > 0
    assert rows(SA.current_state(spark, root), "k", "v") == sorted((k, v) for k, (_, v) in best.items())
    with pytest.raises(ValueError, match="kept by"):
        SA.upsert_batch(batch(10)[1], 10, root, ["v"], ["at"])
    with pytest.raises(FileNotFoundError):
        SA.current_state(spark, str(tmp_path / "none"))


def test_a_batch_touches_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "state")
    SA.upsert_batch(spark.range(1000).selectExpr("id AS k", "1 AS at"), 0, root, ["k"], ["at"], buckets=16)
    SA.upsert_batch(spark.range(1).selectExpr("id AS k", "2 AS at"), 1, root, ["k"], ["at"])
    assert sorted(SA.manifest(spark, root)["buckets"].values()) == [0] * 15 + [1]
    assert SA.current_state(spark, root).where("at = 2").count() == 1 and SA.current_state(spark, root).count() == 1000


def test_routed_messages_arrive_once(spark, tmp_path, rows):
    source, root, progress = tmp_path / "in", str(tmp_path / "topics"), str(tmp_path / "progress")
    for i, part in enumerate([[("fhir.a", "x"), ("fhir.b", "y")], [("fhir.a", "z"), ("other", None)]]):
        source.mkdir(exist_ok=True)
        (source / f"{i}.json").write_text("\n".join(json.dumps({"topic": a, "key": b, "n": i}) for a, b in part))
        stream = spark.readStream.schema("topic string, key string, n int").json(str(source))
        ST.route_stream(stream, root, progress, b"k").awaitTermination()
    # A batch that runs again replaces itself; one that was stopped half-way isn't read.
    again = spark.createDataFrame([("fhir.pseudonymized.a", "k", 0)], "topic string, key string, n int")
    ST.routed_writer(root)(again, 0)
    again.write.partitionBy("topic").parquet(f"{root}/batch=000000000007")
    (tmp_path / "topics" / "batch=000000000007" / "_SUCCESS").unlink()
    found = ST.read_routed(spark, root, "key string, n int")
    assert rows(found, "topic", "n") == [("fhir.pseudonymized.a", 0), ("fhir.pseudonymized.a", 1), ("other", 1)]
    assert rows(ST.read_routed(spark, root, "key string, n int", "other"), "key") == [(None,)]
    assert ST.read_routed(spark, str(tmp_path / "none"), "n int").count() == 0


def test_late_rows_are_left_out_of_running_counts(spark, tmp_path, rows):
    source, root, progress = tmp_path / "in", str(tmp_path / "counts"), str(tmp_path / "progress")
    source.mkdir()
    parts = [[("a", "2020-01-01T01:00:00"), ("a", "2020-01-01T02:00:00")], [("b", "2020-01-09T00:00:00"), ("a", "2020-01-01T05:00:00")],
             [("a", "2020-01-01T06:00:00"), ("b", "2020-01-08T23:00:00"), ("b", "2020-01-09T03:00:00")]]
    for i, part in enumerate(parts):
        (source / f"{i}.json").write_text("\n".join(json.dumps({"what": a, "at": b}) for a, b in part))
        stream = spark.readStream.schema("what string, at timestamp").json(str(source))
        counts = ST.stream_dq_counts(stream, ["what"], "at", late="2 days")
        ST.keep_counts(counts, root, progress, ["window_start", "what"], buckets=4).awaitTermination()
    found = SA.current_state(spark, root).select(F.date_format("window_start", "dd").alias("day"), "what", "count")
    assert rows(found) == [("01", "a", 3), ("08", "b", 1), ("09", "b", 2)]


def test_bundle_stream_pseudonymised(spark, tmp_path, rows):
    source = tmp_path / "bundles"
    source.mkdir()
    (source / "b.json").write_text(
        json.dumps({"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Condition", "id": "1", "subject": {"reference": "Patient/7"}}}]}, indent=2)
    )
    resources = ST.stream_pseudonymise(ST.stream_resources(ST.stream_bundle_files(spark, str(source)), "Condition"), b"k")
    for _ in range(2):
        ST.poll_increment(resources.select("id", "subject.reference"), str(tmp_path / "out"), str(tmp_path / "p")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = spark.range(1).select(hmac_sha256(F.lit("1"), b"k"), F.concat(F.lit("Patient/"), hmac_sha256(F.lit("7"), b"k")))
    assert rows(got) == rows(want)


def test_running_counts(spark, tmp_path, rows):
    write_event(tmp_path / "in", "1.json", [("a", 1, 1), ("a", 2, 3), ("b", 1, 1)])
    stream = spark.readStream.schema("id string, v int, at long").json(str(tmp_path / "in"))
    q = ST.stream_dq_counts(stream, ["id"]).writeStream.format("memory").queryName("dq").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("dq")) == [("a", 2), ("b", 1)]


def test_rebuilt_tables(spark, tmp_path, rows):
    (tmp_path / "r.json").write_text(
        json.dumps({"patient_id": "1", "source_type": "xml", "letter_key": "k", "genes": [{"gene": "KIT", "mutated": True}], "karyotypes": [], "eln_risk": []})
    )
    assert rows(rebuild_tables(spark, str(tmp_path))["genes"], "patient_mrn", "account_id", "gene", "mutated") == [("1", "", "KIT", True)]


def test_a_study_is_saved_apart_from_its_deidentified_form(spark, tmp_path):
    empty = {t: spark.createDataFrame([], schema_of(t)) for t in RESOURCE_TYPES}
    run_study("data_quality", empty, str(tmp_path))
    assert (tmp_path / "data_quality" / "parquet" / "df_adverse-event-mappings.parquet").exists()
    assert not (tmp_path / "data_quality" / "deidentified").exists()


def test_many_files_take_one_scan_for_each_header(spark, tmp_path, rows):
    headers = ["a;count", "count;a;b", "a;count", "a; count"]
    want = []
    for i in range(60):
        names = headers[i % 4]
        row = {"a": f"{i}", "count": f"{i}.0", "b": "x", " count": "7"}
        (tmp_path / f"t {i}+ä.csv").write_text(names + "\n" + ";".join(row[n] for n in names.split(";")) + "\n")
        own = set(names.split(";"))
        want.append((f"t {i}+ä.csv", str(i), i if "count" in own else None, "x" if "b" in own else None, "7" if " count" in own else None))
    merged = DL.read_merged_rows(spark, str(tmp_path))
    assert rows(merged, "table", "a", "count", "b", " count") == sorted(want, key=lambda t: tuple(str(x) for x in t))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3
    one = DL.read_merged(spark, str(tmp_path), ["t 5+ä.csv"])["t 5+ä.csv"]
    assert rows(one) == [(5, "5", "x")]
    trimmed = DL.csv_files_by_header(spark, [str(tmp_path / f"t {i}+ä.csv") for i in range(4)], trim=True)
    assert set(trimmed) == {("a", "count"), ("count", "a", "b")}
    odd = tmp_path / "odd.csv"
    odd.write_text(";x;x\n1;2;3\n")
    assert DL.union_csv_files(spark, [str(odd)]).columns == ["_c0", "x1", "x2"]


def test_bundle_texts_are_written_behind_the_joins(spark):
    import re

    from checks.ingest import bundles
    from checks.registry import Tables

    rows = bundles(Tables(spark, "/root/testdata/sf0.001"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not re.search("to_json|structstojson", plan[plan.index("Join") :])
    counted = rows.selectExpr("get_json_object(value, '$.entry[1].resource.id') AS id").where("id IS NOT NULL")
    assert counted.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()


def test_small_splits_share_tasks(spark, tmp_path):
    from checks.files import small_splits

    for i in range(60):
        (tmp_path / f"{i:02d}.txt").write_text("".join(f"{i} {j}\n" for j in range(400)))
    with small_splits(spark, "1k", tasks=10):
        df = LN.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() <= 40
        wrong = df.where(F.concat(F.regexp_extract("file", "([0-9]+).txt$", 1).cast("int"), F.lit(" "), (F.col("line") - 1).cast("string")) != F.col("value"))
        assert df.count() == 24000 and wrong.count() == 0


def test_streamed_bundles_are_stored_packed_in_bounded_files(spark, tmp_path, monkeypatch, rows):
    import hashlib
    import hmac
    import os

    from checks import ingest
    from checks.deid import KEY
    from checks.registry import QUERIES

    folder = str(tmp_path / "tables")
    spark.range(1200).selectExpr(
        "id AS o_orderkey", "id % 70 AS o_custkey", "date_add(date'1995-01-01', cast(id % 900 AS int)) AS o_orderdate"
    ).coalesce(2).write.parquet(f"{folder}/orders.parquet")
    spark.range(60).selectExpr("id AS c_custkey", "md5(cast(id AS string)) AS c_name").write.parquet(f"{folder}/customer.parquet")
    monkeypatch.setattr(ingest, "paths", lambda t, *labels: [str(tmp_path / x) for x in labels])
    monkeypatch.setattr(ingest, "BUNDLES_A_FILE", 300, raising=False)
    got = rows(QUERIES["stream_bundles"](spark, folder), "id", "subject")

    def hashed(n):
        return hmac.new(KEY, str(n).encode(), hashlib.sha256).hexdigest()

    # Orders of customers who aren't there have no bundle.
    assert got == sorted((hashed(i), f"Patient/{hashed(i % 70)}") for i in range(1200) if i % 70 < 60)
    stored = spark.read.text(str(tmp_path / "bundles"))
    text = stored.agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert sum(os.path.getsize(p) for p in (tmp_path / "bundles").glob("part-*")) * 5 < text
    assert stored.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] <= 300
