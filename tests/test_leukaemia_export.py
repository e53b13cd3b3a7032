"""The leukaemia export as a whole on the smallest folder."""

import pytest
from pyspark.sql import functions as F

from checks import studies as Q
from checks.registry import Tables
from cohortloom.operators.deident import run_secret
from cohortloom.plans import leukaemia as LK


@pytest.fixture(scope="module")
def exported(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    hospital = Q.hospital_tables(t)
    drugs = t.events.selectExpr(
        "concat('Customer#', lpad(user_id, 9, '0')) AS `KIS-Patienten-ID`",
        "date_format(ts, 'dd.MM.yyyy') AS Datum",
        "event_type AS Wirkstoff",
        "cast(event_id AS string) AS Dosis",
    )
    out, lookup = LK.deidentified_export(hospital, run_secret(b"k" * 256, 9), {"drugs": (drugs, "KIS-Patienten-ID")})
    return hospital, drugs, out, lookup


def test_no_record_number_survives(exported):
    _, _, out, _ = exported
    assert {"patients", "encounters", "conditions", "labs", "procedures", "drugs"} <= set(out)
    for name in ("patients", "encounters", "drugs"):
        df = out[name]
        texts = [c for c, t in df.dtypes if t == "string"]
        raw = df.select(*[F.count_if(F.col(f"`{c}`").rlike("Customer#|Patient/")).alias(f"c{i}") for i, c in enumerate(texts)])
        assert sum(raw.first()) == 0, name


def test_hashes_still_join(exported):
    hospital, drugs, out, lookup = exported
    known = hospital["patients"].join(drugs, F.col("patient_mrn") == F.col("KIS-Patienten-ID"), "left_semi")
    hashed = out["patients"].join(out["drugs"].select("patient_mrn"), "patient_mrn", "left_semi")
    assert hashed.count() == known.count()
    assert lookup.columns == ["patient_mrn", "patient_mrn_hash"]


def test_matching_drug_data(exported):
    hospital, drugs, _, _ = exported
    tables = LK.with_drug_data(hospital, drugs, "KIS-Patienten-ID")
    report = tables["match_report"].first()
    assert report["n_matched"] <= min(report["n_patients"], report["n_drug_patients"])
    assert tables["labs_with_drugs"].count() <= hospital["labs"].count()
