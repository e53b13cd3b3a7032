"""Operators on small fixtures, against brute force where that is the clearer answer."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import deaths as DE
from cohortloom.operators import deident as G
from cohortloom.operators import federate as FE
from cohortloom.operators import letters as LT
from cohortloom.operators import linkage as L
from cohortloom.operators import nearest as N
from cohortloom.operators import ordering as O
from cohortloom.operators import predicates as PR
from cohortloom.operators import quality as QU
from cohortloom.operators import quantiles as QT
from cohortloom.operators import stats as S
from cohortloom.operators import survival as SV
from cohortloom.operators import therapies as T
from cohortloom.operators import tumours as TU
from cohortloom.operators.skew import number_rows, spread_join
from cohortloom.plans import leukaemia as LK
from cohortloom.plans import studies as ST

DAY0 = dt.date(2020, 1, 1)


def test_nearest_event_against_brute_force(spark, rows):
    rng = random.Random(1)
    base = [(i, rng.choice(["hot", "a", "b", None]), rng.choice([None, *range(200)])) for i in range(120)]
    events = [(1000 + i, "hot" if i % 3 == 0 else rng.choice("abc"), rng.choice([None, *range(0, 200, 7)])) for i in range(300)]

    def day(n):
        return None if n is None else DAY0 + dt.timedelta(days=n)

    b = spark.createDataFrame([(i, k, day(n)) for i, k, n in base], "i int, k string, d date")
    e = spark.createDataFrame([(i, k, day(n)) for i, k, n in events], "e int, k string, seen date")
    for width in (1, 30, 1000):
        got = dict(rows(N.nearest_event(b, e, "k", "d", "seen", "e", slice_days=width), "i", "e"))
        for i, k, n in base:
            near = [(abs(m - n), m, j) for j, kk, m in events if kk == k and m is not None] if k and n is not None else []
            assert got[i] == (min(near)[2] if near else None), (i, k, n)
    inner = N.nearest_event(b, e, "k", "d", "seen", "e", how="inner")
    assert inner.where("e IS NULL").count() == 0


def test_number_rows_equals_window(spark, rows):
    rng = random.Random(2)
    data = [(i, "hot" if i % 2 else rng.choice("ab"), DAY0 + dt.timedelta(days=rng.randrange(90))) for i in range(400)]
    df = spark.createDataFrame(data, "id int, k string, d date")
    got = number_rows(df, ["k"], ["d", "id"], {"month": F.trunc("d", "month")}, previous={"d": "before"})
    by_key = {}
    for i, k, d in sorted(data, key=lambda x: (x[2], x[0])):
        by_key.setdefault(k, []).append((i, d))
    want = sorted(
        ((i, n + 1, seq[n - 1][1] if n else None) for seq in by_key.values() for n, (i, _) in enumerate(seq)),
        key=lambda t: tuple(str(x) for x in t),
    )
    assert rows(got, "id", "ordinal", "before") == want


def test_hot_key_join_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 400_000, 1, 8).selectExpr(
            "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN null ELSE id % 20000 END AS k", "sha2(cast(id as string), 256) AS pad"
        )
        out = O.multi_flag(df, "k").agg(F.sum("double_patid"), F.max("pad"), F.count(F.lit(1)))
        (row,) = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert row[2] == 400_000
        want = df.groupBy("k").count().where("k IS NOT NULL AND count > 1").agg(F.sum("count")).first()[0]
        assert row[0] == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, rows, how):
    many = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "c")], "i int, k string")
    one = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, v int")
    assert rows(spread_join(many, one, ["k"], how)) == rows(many.join(one, ["k"], how).select(*spread_join(many, one, ["k"], how).columns))


def test_window_group_limit_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = O.top_per_key(df, ["k"], [F.col("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_event_keeps_all_causes(spark, rows):
    df = spark.createDataFrame(
        [("p", "2020-01-02", "o2", "C1"), ("p", "2020-01-02", "o2", "C2"), ("p", "2020-01-02", "o3", "C3"), ("q", None, "o4", "C4")],
        "p string, d string, o string, c string",
    )
    assert rows(O.first_event_with_ties(df, "p", "d", "o"), "p", "c") == [("p", "C1"), ("p", "C2")]
    assert rows(O.first_event_with_ties(df, "p", "d", "o", keep_undated=True), "p", "c") == [("p", "C1"), ("p", "C2"), ("q", "C4")]


def test_consolidated_deaths(spark):
    df = spark.createDataFrame(
        [("p", "C61", "2020-01-02", "o1", "N"), ("p", "C61", "2020-01-02", "o2", None), ("p", "I10", "2020-01-03", "o3", "U"), ("p", None, None, "o4", None)],
        f"{DE.PATIENT} string, death_cause_icd10 string, date_death string, observation_resource_id string, death_cause_tumor string",
    )
    (r,) = DE.consolidate_deaths(df).collect()
    assert (r["date_death"], r["observation_resource_id"], r["death_cause_tumor"], r["death_cause_icd10"]) == ("2020-01-02", "o1", "J", "C61|I10")


def test_is_deceased_honours_the_flag(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, true, null, null, null, null), (2, false, null, null, null, null), (3, null, null, null, null, null),
           (4, null, null, null, 'C61', null) AS t(i, deceased_boolean, deceased_datetime, date_death, death_cause_icd10, death_cause_tumor)"""
    )
    assert [r[0] for r in DE.is_deceased(df).orderBy("i").select("is_deceased").collect()] == [True, False, False, True]


def test_tumour_tables(spark, rows):
    d = dt.date
    df = spark.createDataFrame(
        [
            ("p", "c1", d(2010, 1, 31), "C61", 50.0, "male", 1),
            ("p", "c2", d(2011, 1, 31), "C67", 51.0, "male", 1),
            ("p", "c3", d(2012, 1, 31), "C18", 52.0, "male", 1),
            ("q", "c4", d(2015, 6, 1), "C50", 60.0, "female", 0),
            ("r", "c5", d(2015, 6, 1), "C50", 60.0, "female", 1),
        ],
        "patient_resource_id string, condition_id string, asserted_date date, entity_or_parent string, age_at_diagnosis double, gender string, double_patid int",
    )
    two = TU.two_malignancies(df)
    assert rows(two, "condition_id", "malignancy_number", "malignancy_count", "months_between") == [("c1", 1, 3, None), ("c2", 2, 3, 12.0)]
    wide = TU.pivot_tumours(two, TU.one_malignancy(df), ["condition_id", "entity_or_parent"])
    assert rows(wide, "patient_resource_id", "condition_id_1", "condition_id_2", "entity_or_parent_1") == [
        ("p", "c1", "c2", "C61"),
        ("q", "c4", None, "C50"),
    ]
    (pair,) = TU.pair_statistics(TU.tumour_pairs(two)).collect()
    assert (pair["entity_or_parent_1"], pair["entity_or_parent_2"], pair["count_pair"], pair["months_between_median_2"]) == ("C61", "C67", 1, 12.0)


def test_ordered_concat_has_one_shape(spark, rows):
    df = spark.createDataFrame([("g", f"{i:03d}", None if i == 3 else f"v{i}") for i in range(7)], "g string, id string, v string")
    whole = T.ordered_concat(df, ["g"], "id", ["v"])
    assert rows(whole, "g", "v") == [("g", "v0| v1| v2| v4| v5| v6")]
    many = spark.range(10_001).selectExpr("'g' AS g", "lpad(cast(id as string), 6, '0') AS id", "'v' AS v")
    (row,) = T.ordered_concat(many, ["g"], "id", ["v"]).collect()
    assert row.v.count("v") == 10_001
    alone = spark.createDataFrame([(None, "1", "a"), (None, "2", None)], "g string, id string, v string")
    assert rows(T.ordered_concat(alone, ["g"], "id", ["v"]), "g", "v") == [(None, ""), (None, "a")]


NO_TIMES = ["unbekannt", "12:30", "12:30:15", "", "2020-13", "31.02.2020", "2020-5-1", "99", None]


@pytest.mark.parametrize("match", [N.nearest_event, N.nearest_per_key])
def test_nearest_event_reads_times_in_all_forms(spark, rows, match):
    base = spark.createDataFrame([("k", "2020-05-01"), ("m", "2020-05-01"), ("n", "12:30"), (None, "2020")], "k string, day string")
    events = [("k", x, i) for i, x in enumerate(NO_TIMES)] + [("n", "2020-05-01", 20), (None, "2020", 21)]
    events += [("m", "30.4.2020", 30), ("m", "2020-05", 31), ("m", "1.5.2020 0:01", 32), ("m", "12:30", 33)]
    out = match(base, spark.createDataFrame(events, "k string, at string, e int"), "k", "day", "at", "e")
    assert rows(out, "k", "at_first", "e") == [(None, None, None), ("k", None, None), ("m", "2020-05", 31), ("n", None, None)]


def test_nearest_per_key_against_brute_force(spark, rows):
    rng = random.Random(5)
    forms = [("%Y-%m-%d", 1), ("%d.%m.%Y", 1), ("%Y-%m", 30), ("%m.%Y", 30), ("%Y", 365)]

    def written():
        form, _ = rng.choice(forms)
        return rng.choice([None, "09:15", *[(DAY0 + dt.timedelta(days=rng.randrange(900))).strftime(form)] * 8])

    def span(text):
        if text is None or ":" in text:
            return None
        if "." in text:
            text = "-".join(reversed(text.split(".")))
        y, *rest = map(int, text.split("-"))
        first = dt.date(y, *(rest + [1, 1])[:2])
        after = first + dt.timedelta(days=1) if len(rest) == 2 else dt.date(y + (rest[0] == 12), rest[0] % 12 + 1, 1) if rest else dt.date(y + 1, 1, 1)
        day = 86_400_000_000
        return first.toordinal() * day, after.toordinal() * day - 1

    base = [(k, written()) for k in ("hot", *"abcdefghijkl")]
    events = [(1000 + i, "hot" if i % 3 == 0 else rng.choice("abcdefghijk"), written()) for i in range(400)]
    b = spark.createDataFrame(base, "k string, d string")
    e = spark.createDataFrame(events, "e int, k string, seen string").withColumn("_b", F.lit(1)).withColumn("_seen", F.lit(2))
    for by in ("start", "gap"):
        want = []
        for k, d in base:
            near = []
            for i, kk, t in events:
                if kk == k and span(d) and span(t):
                    (a, z), (s, u) = span(d), span(t)
                    near.append(((abs(a - s) if by == "start" else max(0, a - u, s - z)), abs(a - s), s, i))
            want.append((k, min(near)[3] if near else None))
        got = N.nearest_per_key(b, e, "k", "d", "seen", "e", by=by)
        assert rows(got, "k", "e") == sorted(want, key=lambda t: tuple(str(x) for x in t))
        assert rows(N.nearest_per_key(b, e, "k", "d", "seen", "e", by=by, how="inner"), "k", "e") == [w for w in sorted(want) if w[1]]


def test_nearest_per_key_sorts_no_times(spark):
    base = spark.range(100).selectExpr("id AS k", "date'2020-05-01' AS d")
    events = spark.range(3000).selectExpr("id % 100 AS k", "date_add(date'2020-01-01', cast(id % 300 AS int)) AS seen", "id AS e")
    found = N.nearest_per_key(base, events, "k", "d", "seen", "e")
    assert found.count() == 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Window" not in plan and final.count("Exchange hashpartitioning") <= 2 and "min_by" in final


def test_combinations_count_every_therapy(spark, rows):
    conditions = spark.createDataFrame([("c", dt.date(2020, 1, 1)), ("d", dt.date(2020, 1, 1))], "condition_id string, asserted_date date")
    kinds = ["CH"] * 12 + ["OP"]
    therapies = spark.createDataFrame([(f"t{i:02d}", "c", k, dt.date(2020, 1, 2 + i)) for i, k in enumerate(kinds)], "therapy_id string, reason_reference string, therapy_type string, therapy_start_date date")
    assert rows(T.all_combinations(conditions, therapies), "condition_id", "combo_label") == [("c", "CH+OP"), ("d", "")]
    assert rows(T.all_combinations(conditions, therapies, 4), "condition_id", "combo_label") == [("c", "CH+OP")]


def test_atc_groups(spark, rows):
    df = spark.createDataFrame([("x", "L01| L02 |?", None), ("y", None, "L02")], "id string, code_1 string, code_2 string")
    mapping = spark.createDataFrame([("L01 ", "A"), ("L02", "B"), ("", "C")], "atc_code string, gruppe string")
    assert rows(T.atc_groups(df, mapping, "id", "code"), "id", "gruppe_1", "gruppe_2") == [("x", "A|B", ""), ("y", "", "B")]


def test_kaplan_meier(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1)], "t int, ev int")
    got = [(r["time"], r["n_risk"], r["n_event"], round(r["survival"], 6)) for r in SV.kaplan_meier(df, "t", [], "ev").orderBy("time").collect()]
    assert got == [(1, 4, 1, 0.75), (2, 3, 0, 0.75), (3, 2, 2, 0.0)]


def test_column_bind_fails_on_missing_partner(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "row int, a string")
    b = spark.createDataFrame([(1, "p")], "row int, b string")
    with pytest.raises(Exception, match="row without partner"):
        L.column_bind(a, b, "row", ["b"]).collect()


def test_deidentified_tables_keep_no_raw_key(spark):
    df = spark.createDataFrame(
        [("Condition/1", "Patient/1", "o", "2020-01-05", "s1")],
        "condition_id string, patient_resource_id string, observation_id string, asserted_date string, subject_reference string",
    ).withColumn("asserted_date", F.to_date("asserted_date")).withColumn("grading_date", F.date_add("asserted_date", 31))
    out = G.deidentify(df, b"k")
    assert out.columns == ["condition_id_hash", "patient_resource_id_hash", "months_between_asserted_grading_date", "asserted_year"]
    raw = {"Condition/1", "Patient/1", "o", "s1"}
    assert not raw & {str(v) for v in out.first()}
    wide = spark.createDataFrame([("a", "b", "c", "OP")], "condition_id_2 string, therapy_id_1 string, part_of_reference string, therapy_type_1 string")
    assert G.deidentify(wide, b"k").columns == ["therapy_type_1", "condition_id_2_hash"]
    for name, spec in G.TABLE_SPECS.items():
        cols = [*spec.hashed, *spec.shifted]
        one = spark.createDataFrame([tuple("2020-01-02" if c in spec.shifted else f"raw-{c}" for c in cols)], ", ".join(f"`{c}` string" for c in cols))
        row = G.deidentify_table(one, spec, G.run_secret(b"k", 5)).first()
        assert not [v for v in row if str(v).startswith("raw-")], name


def test_day_shift_is_reversible(spark):
    df = spark.sql("SELECT timestamp'2024-01-31 10:00:00' AS t")
    from cohortloom.functions.dates import shift_days

    assert df.select(shift_days(shift_days("t", 17), -17) == F.col("t")).first()[0]


def test_secrets_stay_out_of_repr():
    assert "key" not in repr(G.run_secret(b"topsecret", 3)) and "3" not in repr(G.run_secret(b"topsecret", 3))
    assert -30 <= G.run_secret().day_shift <= 30 and len(G.run_secret().key) == 32


def test_observed_counts(spark, tmp_path):
    df, seen = QU.counted(spark.range(10).selectExpr("nullif(id, 3) AS id"), "stage", "id")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"n_rows": 10, "n_null_keys": 1}


def test_extractor_retries_and_keeps_failures(spark):
    letters = spark.createDataFrame(
        [("1", "empty"), ("2", "boom"), ("3", "FLT3 positiv")], "patient_id string, therapie_text string"
    )
    full = letters.select(*[(F.col(c) if c in letters.columns else F.lit(None).cast("string")).alias(c) for c in LT.LETTER_COLUMNS]).withColumn("letter_key", F.col("patient_id"))

    def extractor(letter):
        if letter["therapie_text"] == "boom":
            raise ValueError("no answer")
        if letter["therapie_text"] == "empty":
            return {}
        return {"genes": [{"gene": "FLT3", "mutated": True, "variant_detail": None, "date": None, "evidence_text": None}]}

    done = spark.createDataFrame([("9",)], "letter_key string")
    got = {r["patient_id"]: (len(r["genes"]), r["attempts"], r["error"]) for r in LT.extract_findings(full, extractor, done).collect()}
    assert got == {"1": (0, 4, None), "2": (0, 1, "ValueError: no answer"), "3": (1, 1, None)}
    by_rule = LT.extract_findings(full).where("patient_id = '3'").first()
    assert [(g["gene"], g["mutated"]) for g in by_rule["genes"]] == [("FLT3", True)]


def test_negative_phrases_win(spark):
    text = "FLT3: nicht nachweisbar. NPM1 nachweisbar; TP53 Wildtyp. KIT ohne Aussage."
    df = spark.createDataFrame([(text,)], "v string").select(F.inline(LT.rule_findings("v", F.lit("2020"))["genes"]))
    assert {(r["gene"], r["mutated"], r["date"]) for r in df.collect()} == {("FLT3", False, "2020"), ("NPM1", True, "2020"), ("TP53", False, "2020")}


@pytest.mark.parametrize("sentence, want", [
    ("NPM1 positiv, FLT3 negativ.", "NPM1+ FLT3-"),
    ("NPM1 positiv und FLT3 negativ", "NPM1+ FLT3-"),
    ("NPM1, FLT3 und IDH1 negativ.", "NPM1- FLT3- IDH1-"),
    ("Nachweis einer Mutation in NPM1, FLT3 und IDH1", "NPM1+ FLT3+ IDH1+"),
    ("FLT3 negativ, NPM1, TP53 mutiert", "FLT3- NPM1+ TP53+"),
    ("kein Nachweis einer NPM1-Mutation, FLT3-ITD nachweisbar", "NPM1- FLT3+"),
    ("NPM1 nicht sicher nachweisbar; TP53: positiv", "NPM1- TP53+"),
    ("NPM1 mutiert: nein, KIT mutiert: ja", "NPM1- KIT+"),
    ("BCR-ABL Positiv, JAK2 Negativer Befund", "BCR-ABL+ JAK2-"),
    ("NPM1 unmutiert, FLT3 mutierte Variante", "NPM1- FLT3+"),
    ("Die Postpositivität von NPM1 bleibt offen", ""),
    ("FLT3X positiv und xKIT negativ", ""),
    ("NPM1 positiv, NPM1 negativ", "NPM1+ NPM1-"),
    ("Weder ASXL1 noch RUNX1, nur CEBPA", ""),
    ("weder nachgewiesen bei WT1", "WT1-"),
])
def test_each_gene_takes_its_own_result(spark, sentence, want):
    df = spark.createDataFrame([(sentence,)], "v string").select(F.inline(LT.rule_findings("v", F.lit("2020"))["genes"]))
    assert " ".join(f"{r['gene']}{'+' if r['mutated'] else '-'}" for r in df.collect()) == want


def test_site_table_without_key_is_an_error(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text(";diagnosis_year ;count\n0;2000;3\n1;2001;4\n")
    (tmp_path / "b.csv").write_text(";diagnosis_year;count\n0;2000;5\n")
    (tmp_path / "c.csv").write_text(";other;count\n0;2000;100\n")
    with pytest.raises(ValueError, match="c.csv has no column diagnosis_year"):
        FE.read_site_tables(spark, [str(tmp_path / f"{n}.csv") for n in "abc"], ["diagnosis_year"])
    df = FE.read_site_tables(spark, [str(tmp_path / f"{n}.csv") for n in "ab"], ["diagnosis_year"])
    assert rows(FE.merge_sites(df, ["diagnosis_year"])) == [("2000", 8.0), ("2001", 4.0)]


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10)], "v int")
    r = S.quantile_summary(df, "v", [0.25, 0.5]).first()
    assert (r["q25"], r["q50"]) == (1.75, 2.5)


def test_quantiles_of_any_group(spark, rows):
    rng = random.Random(11)
    data = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, rng.random() * 10 ** rng.randrange(-3, 9), -rng.random(), 5.0]), rng.choice([None, *range(7)])) for _ in range(900)]
    data += [("one", 2.5, None), ("none", None, None), ("hot", float("inf"), 1), ("hot", -float("inf"), 1)]
    df = spark.createDataFrame(data, "g string, x double, y int").repartition(5)
    probs = [0.0, 0.01, 0.3, 0.5, 1.0]
    for interpolated in (True, False):
        found = {r["g"]: r for r in QT.exact_quantiles(df, ["g"], ["x", "y"], probs, interpolated=interpolated).collect()}
        assert set(found) == {"hot", "a", None, "one"}
        for g, row in found.items():
            for c, i in (("x", 1), ("y", 2)):
                own = sorted(r[i] for r in data if r[0] == g and r[i] is not None)
                if not own:
                    assert row[f"{c}_quantiles"] is None
                    continue
                for p, q in zip(probs, row[f"{c}_quantiles"]):
                    at = (len(own) - 1) * p
                    low, high = own[int(at)], own[-int(-at // 1)]
                    want = (low if low == high else low + (high - low) * (at - int(at))) if interpolated else own[max(1, -int(-len(own) * p // 1)) - 1]
                    assert q == pytest.approx(want, rel=1e-12) or (math.isnan(q) and math.isnan(want))
    (whole,) = QT.exact_quantiles(df, [], ["y"], [0.5], interpolated=False).collect()
    assert whole[0] == [sorted(r[2] for r in data if r[2] is not None)[len([r for r in data if r[2] is not None]) // 2 - (len([r for r in data if r[2] is not None]) % 2 == 0)]]
    assert QT.exact_quantiles(df.limit(0), ["g"], ["x"], probs).collect() == []


def test_pages_of_any_group(spark):
    rng = random.Random(6)
    data = [(rng.choice(["hot", "hot", "a", None]), i, rng.choice([None, "", "x" * rng.randrange(30)])) for i in range(900)] + [("none", 1, None), ("long", 1, "y" * 500)]
    df = spark.createDataFrame(data, "g string, page int, v string").repartition(5)
    found = {}
    for r in T.paged_concat(df, ["g"], ["page"], "v", page=100).collect():
        found[r["g"], r["page"]] = r["v"]
        assert len(r["v"]) <= 100 + 30 or r["g"] == "long"
    for g in ("hot", "a", None, "long"):
        pages = [found[k] for k in sorted((k for k in found if k[0] == g), key=lambda k: k[1])]
        assert "| ".join(pages) == "| ".join(v for k, _, v in sorted(data, key=lambda r: r[1]) if k == g and v is not None)
    assert not any(k[0] == "none" for k in found) and sum(k[0] == "hot" for k in found) > 20


def test_nearest_event_deals_its_rows_once(spark):
    base = spark.range(100).selectExpr("id AS k", "timestamp_seconds(id * 100000) AS d")
    events = spark.range(500).selectExpr("id % 100 AS k", "id AS e", "timestamp_seconds(id * 20000) AS seen")
    near = N.nearest_event(base, events, "k", "d", "seen", "e")
    for name, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(name, value)
    try:
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the rows, one for the summary by key, one for its way back.
    reused = plan.count("ReusedExchange")
    assert reused == 1 and plan.count(" Exchange ") - reused == 3


def test_few_diagnoses_are_merged_with_many_therapies(spark):
    therapies = spark.range(60).selectExpr("concat('c', id % 30) AS reason_reference", "DATE'2020-03-01' AS therapy_start_date")
    conditions = spark.createDataFrame([("c1", dt.date(2020, 1, 1)), ("c1", dt.date(2020, 1, 1))], "condition_id string, asserted_date date")
    dated = T.dated_therapies(therapies, conditions)
    # A broadcast decided behind the shuffle has each task read the files of adjacent tasks, however full.
    assert "SortMergeJoin" in dated._jdf.queryExecution().executedPlan().toString()
    assert dated.count() == 60 and dated.where("months_diff IS NOT NULL").count() == 2


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_two_malignancies_read_their_rows_once(spark, rows):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), f"c{i}", rng.choice([None, *(DAY0 + dt.timedelta(days=n) for n in range(40))]), rng.choice([0, 1, 1])) for i in range(500)]
    data += [("single", "c900", DAY0, 1), ("pair", None, DAY0, 1), ("pair", "c901", DAY0, 1)]
    df = spark.createDataFrame(data, "patient_resource_id string, condition_id string, asserted_date date, double_patid int")
    two = TU.two_malignancies(df)
    assert optimized(two).count("LogicalRDD") + optimized(two).count("LocalRelation") == 1
    want = []
    for p in ("hot", "a", "b", "pair"):
        own = sorted((x for x in data if x[0] == p and x[3] == 1), key=lambda x: (x[2] is not None, x[2] or DAY0, x[1] is not None, x[1] or ""))
        want += [(p, own[n][1], n + 1, len(own), own[0][2] if n else None) for n in (0, 1)]
    got = rows(two, "patient_resource_id", "condition_id", "malignancy_number", "malignancy_count", "date_prev")
    assert got == sorted(want, key=lambda t: tuple(str(x) for x in t))


def test_pairs_are_worked_out_once(spark, rows):
    pairs = spark.range(40).selectExpr(
        "if(id % 5 = 0, null, 'C' || id % 2) AS entity_or_parent_1", "'C50' AS entity_or_parent_2", "if(id % 7 = 0, null, id) AS age_1",
        "id * 2.0D AS age_2", "if(id = 39, 9999, id) AS months_between_2", "if(id % 3 = 0, 'male', 'female') AS gender",
    )
    stats, outliers = TU.pair_statistics(pairs), TU.pair_outliers(pairs)
    assert "Range" not in optimized(stats) and "Range" not in optimized(outliers)
    assert rows(stats, "entity_or_parent_1", "count_pair") == [("C0", 16), ("C1", 16), (None, 8)]
    assert rows(outliers, "entity_or_parent_1", "measure", "value") == [("C1", "months_between_2", 9999.0)]


def test_filters_on_prepared_conditions_parse_no_dates_again(spark, rows):
    raw = spark.createDataFrame(
        [(1, "2001-05", "1960-01-01", None, "C61.9"), (2, "1970", "1960-01-01", None, "C61.9"), (3, None, "1960", None, "C61"), (4, "2001-05-02", "2002", None, "C61"), (5, "2001", "1950-07-01", "2003-05", "C44.1")],
        "id int, asserted_date string, birthdate string, date_death string, icd10_code string",
    )
    people = spark.range(10).selectExpr("cast(id as int) AS id", "id % 2 AS half").hint("merge")
    clean = PR.clean_conditions(ST.prepare_conditions(raw.join(people, "id", "left")))
    assert not any("RLIKE" in line for line in optimized(clean).splitlines() if "Filter" in line)
    assert rows(clean, "id", "asserted_date", "asserted_date_precision", "age_at_diagnosis") == [(1, dt.date(2001, 5, 15), "MONTH", 41.37)]


@pytest.mark.parametrize("width", [1, 30, 1000])
def test_nearest_event_for_each_value(spark, rows, width):
    rng = random.Random(9)
    base = [(i, rng.choice(["hot", "a", "b", None]), rng.choice([None, *range(150)])) for i in range(80)]
    events = [(1000 + i, "hot" if i % 3 == 0 else rng.choice("abc"), rng.choice(["x", "y", "z", "w", None]), rng.choice([None, *range(0, 150, 7)])) for i in range(200)]

    def day(n):
        return None if n is None else DAY0 + dt.timedelta(days=n)

    b = spark.createDataFrame([(i, k, day(n)) for i, k, n in base], "i int, k string, d date")
    e = spark.createDataFrame([(i, k, v, day(n)) for i, k, v, n in events], "e int, k string, v string, seen date")
    want = []
    for i, k, n in base:
        for v in ("x", "y", "z"):
            near = [(abs(m - n), m, j) for j, kk, vv, m in events if (kk, vv) == (k, v) and m is not None] if k and n is not None else []
            want += [(i, v, min(near)[2])] if near else []
    got = N.nearest_event(b, e, "k", "d", "seen", "e", how="inner", slice_days=width, each="v", values=["x", "y", "z"])
    assert rows(got, "i", "v", "e") == sorted(want, key=lambda t: tuple(str(x) for x in t))
    with pytest.raises(ValueError):
        N.nearest_event(b, e, "k", "d", "seen", "e", each="v", values=["x"])


def test_lab_panels_need_no_row_for_each_panel(spark, rows):
    patients = spark.createDataFrame([("p", DAY0), ("p", DAY0 + dt.timedelta(days=9)), ("q", DAY0), ("r", None), (None, DAY0)], "p string, d date")
    labs = spark.createDataFrame(
        [(1, "p", "777-3", "10", "g", "2020-01-02"), (2, "p", "26515-7", "20", "g", "2020-01-08"), (3, "p", "718-7", "x", "g", "2020-01-01"),
         (4, "p", "718-7", "7", None, "2020-01-10"), (5, "q", "777-3", "40", "g", "2021"), (6, "q", "nothing", "1", "g", "2020-01-01"),
         (7, "r", "777-3", "1", "g", "2020-01-01"), (8, None, "777-3", "1", "g", "2020-01-01")],
        "observation_id int, p string, loinc_code string, lab_quantity_value string, lab_quantity_unit string, t string",
    )
    means = S.lab_panel_means(patients, labs, "p", "d", "t")
    assert rows(means, "lab_value", "unit", "count", "mean") == [("hemoglobin", "g", 0, None), ("platelets", "g", 3, 70 / 3)]
    dealt = optimized(means).split("RepartitionByExpression")
    assert len(dealt) > 1 and not any("Generate" in below for below in dealt[1:])


def test_filters_on_diagnosis_times_parse_no_text_again(spark, rows):
    people = spark.createDataFrame(
        [("p", "2020-01-01T10:00:00+01:00", "1960-01-01", "m", "C92.0"), ("p", "bad", "1960", "m", "C92.0")],
        "condition_patient_reference string, diagnosis_recordedDate string, birth_date string, gender string, icd_code string",
    )
    labs = spark.createDataFrame(
        [(1, "p", "777-3", "10", "g", "2020-01-02"), (2, "p", "777-3", "20", "g", "2020-01-08")],
        "observation_id int, observation_patient_reference string, loinc_code string, lab_quantity_value string, lab_quantity_unit string, lab_dateTime string",
    )
    codes = spark.createDataFrame([], "patient_mrn string, effective_dateTime string, code_text string, value_code string, observation_id string")
    means = LK.summary(people, labs, labs.selectExpr("'1' AS ecog_performance_status"), codes)["lab_distribution"]
    assert rows(means, "lab_value", "unit", "count", "mean") == [("platelets", "g", 1, 10.0)]
    assert not any("diagnosis_recordedDate" in line for line in optimized(means).splitlines() if "Filter" in line)
