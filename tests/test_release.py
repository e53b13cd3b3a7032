"""What must not leave: identifiers in de-identified tables, keys in plan texts."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks import shape as H
from checks.registry import Tables
from cohortloom.functions.deid import hmac_sha256
from cohortloom.operators import deident as G
from cohortloom.operators import letters as LT
from cohortloom.operators import views as V
from cohortloom.plans import studies as ST
from cohortloom.plans.base import deidentified, lazily
from cohortloom.plans.letter_study import letter_study

KEY = b"0123456789abcdef"


def leaking(df):
    """Text columns with a reference in clear."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return []
    found = df.agg(*[F.max(F.col(f"`{c}`").rlike("(Patient|Encounter|Condition|Observation|Procedure)/")).alias(c) for c in texts]).first()
    return [c for c in texts if found[c]]


@pytest.mark.parametrize("study", ["study_d", "all_conditions"])
def test_no_reference_survives(spark, study):
    source = H.source(Tables(spark, "/root/testdata/sf0.001"))
    server = V.server_conditions(source["Condition"]).withColumn("patient_mrn", F.lit("mrn"))
    tables = deidentified(getattr(ST, study)(source, server=server, keep=lazily), G.RunSecret(KEY, 3))
    names = ["mii_conditions", "mii_conditions_2_mals", "mii_conditions_1_mal", "2_malignancies", "metastasis", "progressions", "all_obds_clean"]
    asked = [n for n in names if n in tables]
    assert asked
    assert {n: leaking(tables[n]) for n in asked} == {n: [] for n in asked}


def test_every_table_has_rules(spark):
    source = H.source(Tables(spark, "/root/testdata/sf0.001"))
    for study in (ST.study_d, ST.study_pca, ST.all_conditions):
        tables = deidentified(study(source, keep=lazily), G.RunSecret(KEY, 3))
        for name in tables:
            assert not any(c in G.HASHED for c in tables[name].columns)


def test_columns_without_rule_are_not_released(spark):
    df = spark.createDataFrame([("a", "b")], "condition_id string, note string")
    with pytest.raises(G.UnknownColumn, match="note"):
        G.deidentify(df, KEY)
    with pytest.raises(G.UnknownColumn, match="other_reference"):
        G.deidentify_table(spark.createDataFrame([("a",)], "other_reference string"), G.TABLE_SPECS["labs"], G.RunSecret(KEY, 0))


def test_server_conditions_and_findings(spark):
    server = spark.createDataFrame([("c", "Patient/RAW", "Encounter/RAW")], "condition_id string, all_condition_patient_reference string, condition_encounter_reference string")
    assert leaking(G.deidentify_server(server, KEY)) == [] and leaking(G.deidentify(server, KEY)) == []
    full = server.withColumn("patient_mrn", F.lit("7"))
    assert leaking(G.deidentify_table(full, G.TABLE_SPECS["conditions"], G.RunSecret(KEY, 0))) == []
    letter = spark.createDataFrame([("4711", "x", "2020-01-01", "FLT3 positiv. ELN: adverse.")], "patient_id string, account_id string, document_date string, therapie_text string")
    letters = LT._letter(letter, {c: F.col(c) for c in letter.columns})
    keyed = LT.letter_key(letters)
    found = LT.findings_tables(LT.extract_findings(keyed))
    for name in ("genes", "eln_risk"):
        rows = G.deidentify_table(found[name], G.TABLE_SPECS[name], G.RunSecret(KEY, 0)).collect()
        assert rows and not any("4711" in str(v) for r in rows for v in r)


def test_keys_are_not_in_plan_texts(spark):
    df = spark.range(1).select(hmac_sha256(F.col("id").cast("string"), b"secret key"))
    text = df._jdf.queryExecution().toString()
    pads = [bytes(b ^ x for b in b"secret key") for x in (0x36, 0x5C)]
    assert all(p.hex() not in text.lower().replace(" ", "") and str(list(p))[1:-1] not in text for p in pads)
    assert df.first()[0] == __import__("hmac").new(b"secret key", b"0", "sha256").hexdigest()


def test_a_long_letter_loses_nothing(spark):
    genes = ["FLT3", "NPM1", "TP53", "IDH1", "IDH2", "KIT", "NRAS"]
    text = "12/19: NPM1 negativ. 03/20: NPM1 positiv. " + " ".join(f"{g} positiv." for g in genes) * 3
    docs = spark.createDataFrame(
        [(f'<section id="M5_Therapie"><content>{text}</content></section>', "p", "a", "2021-05-01", "s", "t"), ("<d/>", "q", "a", "", "s", "t")],
        "xmldocument string, patid string, patientaccountid string, lastsaveddatetime string, letterstatus string, templatename string",
    )
    tables = letter_study(docs)
    rows = {(r.gene, r.mutated, r.date) for r in tables["genes"].collect()}
    assert rows == {("NPM1", False, "2019-12"), *((g, True, "2021-05-01") for g in genes if g != "NPM1")}
    assert tuple(tables["skipped"].first()) == (2, 1) and tables["rejected"].count() == 0


def test_letter_texts_are_worked_out_once(spark):
    text = "NPM1 positiv. ELN-Risiko: ungünstig. Karyotyp " + "x" * 400 + ". TP53 " + "y" * 400 + " negativ."
    docs = spark.createDataFrame(
        [(f'<section id="M5_Therapie"><content>{text}</content></section>', "p", "a", "2021-05-01", "s", "t")],
        "xmldocument string, patid string, patientaccountid string, lastsaveddatetime string, letterstatus string, templatename string",
    )
    tables = letter_study(docs)
    assert {(r.kind, r.problems) for r in tables["rejected"].collect()} == {("genes", "gene_evidence"), ("karyotypes", "karyotype_text,karyotype_evidence")}
    for name in ("genes", "karyotypes", "eln_risk", "rejected"):
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        # Each section is looked for once, sentences are split once, whichever conditions follow.
        assert plan.count("M5_Therapie") == 1 and plan.count("(?<=[.;!?])") == 1


def test_tables_are_computed_once(spark, tmp_path):
    from cohortloom.plans.base import Tables as Results
    from cohortloom.plans.base import save
    from cohortloom.sources.sinks import StudyLayout

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([("c1", "C61"), ("c2", "C50")], "condition_id string, icd10_code string")
    tables = Results({"facts": lambda: rows.mapInArrow(count, rows.schema)})
    layout = StudyLayout(str(tmp_path), "s")
    kept = save(tables, layout)
    save(deidentified(kept, G.RunSecret(KEY, 1)), layout, is_deidentified=True)
    assert seen.value == 2 and kept["facts"].count() == 2 and seen.value == 2


def test_letters_are_saved(spark, tmp_path):
    from cohortloom.plans.run_all import run_letters

    docs = spark.createDataFrame(
        [('<section id="M5_Therapie"><content>FLT3 positiv.</content></section>', "p", "a", "2021-05-01", "s", "t")],
        "xmldocument string, patid string, patientaccountid string, lastsaveddatetime string, letterstatus string, templatename string",
    )
    tables = run_letters(docs, str(tmp_path))
    assert [r.gene for r in tables["genes"].collect()] == ["FLT3"]


def test_rejected_bundles_are_counted(spark, tmp_path):
    from cohortloom.sources.resources import bundle_rejects, land_bundles, landed_entries, landed_rejects

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.json").write_text('{"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Patient", "id": "p"}}]}')
    (tmp_path / "in" / "cut.json").write_text('{"resourceType": "Bundle", "entry": [{"resource": {"resou')
    assert bundle_rejects(spark.read.text(str(tmp_path / "in"), wholetext=True)).count() == 1
    counts = land_bundles(spark, str(tmp_path / "in"), str(tmp_path / "lake"), ["Patient"]).first()
    assert (counts.bundles, counts.rejected) == (2, 1)
    assert spark.read.parquet(str(tmp_path / "lake" / "Patient")).count() == 1
    (kept,) = landed_rejects(spark, str(tmp_path / "lake")).collect()
    assert kept.value.endswith('"resou')
    assert landed_entries(spark, str(tmp_path / "lake")).select("resource_type").collect() == [("Patient",)]


def test_bundles_are_read_and_parsed_once(spark, tmp_path):
    from cohortloom.sources.resources import landed_rows

    lines = ['{"entry":[{"resource":{"resourceType":"Patient","id":"1"}},{"resource":{"id":"2"}}]}', "[", '{"entry":[]}', "", '{"x":1}']
    (tmp_path / "b.txt").write_text("\n".join(lines))
    passed = Observation("test")
    rows = landed_rows(spark.read.text(str(tmp_path)), passed=passed)
    got = sorted(((r.status, r.resource_type, r.bundle) for r in rows.collect()), key=str)
    assert got == sorted([("entry", "Patient", None), ("entry", None, None), *[("rejected", None, x) for x in ("[", '{"x":1}', "")]], key=str)
    assert passed.get == {"bundles": 5, "rejected": 3}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("from_json") + plan.count("jsontostructs") == 1


def test_linked_labs(spark):
    from cohortloom.plans.base import server_labs_of

    base = spark.createDataFrame([("c", "7", None), ("c", "7", None), ("d", "8", None)], "condition_id string, patid_pseudonym string, asserted_date date")
    labs = spark.createDataFrame(
        [("o1", "Patient/RAW", "718-7", "Hb", "2020-03-04T10:00:00", 1.5, "g/dL", None, "7"), ("o2", "Patient/X", "718-7", "Hb", "bad", 2.0, "g/dL", None, "9")],
        "observation_id string, observation_patient_reference string, loinc_code string, loinc_display string, lab_dateTime string, lab_quantity_value double, lab_quantity_unit string, lab_codeableconcept_code string, patient_mrn string",
    )
    linked = server_labs_of(base, labs)
    (row,) = linked.collect()
    assert (row.condition_id, row.observation_id, str(row.lab_dateTime)) == ("c", "o1", "2020-03-04")
    out = G.deidentify(linked, KEY)
    assert leaking(out) == [] and not {"patient_mrn", "lab_dateTime", "observation_id"} & set(out.columns)
