"""Column builders on edge rows."""

import hashlib
import hmac
import html

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import codes as C
from cohortloom.functions import dates as D
from cohortloom.functions import deid as X
from cohortloom.functions import fhir as P
from cohortloom.functions import text as T
from cohortloom.schemas import TYPE_ALIASES


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def one(df, col):
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_partial_dates(spark):
    df = texts(spark, "2020-02-29", "2020-02", "2020", "29.02.2020", "02.2020", "2020-02-31", "2020-02-03T10:00:00", None, "")
    assert one(df, D.date_precision("v")) == ["DAY", "MONTH", "YEAR", "DAY", "MONTH", "DAY", None, None, None]
    got = [None if d is None else d.isoformat() for d in one(df, D.parse_partial_date("v"))]
    assert got == ["2020-02-29", "2020-02-15", "2020-07-01", "2020-02-29", "2020-02-15", None, None, None, None]


def test_mixed_dates(spark):
    df = texts(
        spark, "2013-08-09T12:00:00Z", "08/2013", "03.04.2015", "12/31/2015", "20150403", "42000", "1420070400", "1420070400000", "0", " ", "31.12.9999"
    )
    got = [None if d is None else d.isoformat() for d in one(df, D.parse_mixed_date("v")["date"])]
    assert got == [
        "2013-08-09",
        None,
        "2015-04-03",
        "2015-12-31",
        "2015-04-03",
        "2014-12-27",
        "2015-01-01",
        "2015-01-01",
        None,
        None,
        "9999-12-31",
    ]


def test_localize_switching_nights(spark):
    df = texts(
        spark, "2024-03-31 01:59:00", "2024-03-31 02:30:00", "2024-03-31 03:00:00", "2024-10-27 01:59:00", "2024-10-27 02:30:00", "2024-10-27 03:00:00"
    )
    local = F.col("v").cast("timestamp_ntz")
    got = one(df, F.date_format(D.localize(local), "yyyy-MM-dd HH:mm"))
    assert got == ["2024-03-31 00:59", "2024-03-31 01:00", "2024-03-31 01:00", "2024-10-26 23:59", None, "2024-10-27 02:00"]


def test_iso(spark):
    df = texts(spark, "2020-01-02", "2020-01-02T03:04:05+02:00", "9999-12-31", "2020-05", "x", None)
    got = one(df, F.date_format(D.parse_iso("v"), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2020-01-02 00:00:00", "2020-01-02 01:04:05", None, "2020-05-01 00:00:00", None, None]
    assert one(df, D.parse_failed("v")) == [False, False, True, False, True, False]


def test_hmac_equals_library(spark):
    for key in (b"k", bytes(64), bytes(range(256))):
        df = texts(spark, "a", "Ümläut", "", None)
        want = [None if v is None else hmac.new(key, v.encode(), hashlib.sha256).hexdigest() for v in ("a", "Ümläut", "", None)]
        assert one(df, X.hmac_sha256("v", key)) == want


def test_record_numbers(spark):
    df = texts(spark, "123.0", "00123", "12.30", "-5.00", " 7 ", "", None)
    assert one(df, X.clean_mrn("v")) == ["123", "00123", "12.30", "-5", "7", None, None]


def test_set_strings_and_bins(spark):
    df = texts(spark, "b| a|b", "", None, " | ", "c")
    assert one(df, C.normalise_set_string("v")) == ["a|b", "NON", "NON", "NON", "c"]
    ages = spark.createDataFrame([(0, 0.0), (1, 18.0), (2, 18.01), (3, 90.0), (4, 120.0), (5, 121.0)], "i int, v double")
    assert one(ages, C.age_group("v")) == [None, "0-18", "18-30", "75-90", "90+", None]
    assert one(ages, C.age_class("v")) == [None, 15, 15, 85, 100, 100]


def test_entity_labels(spark):
    df = texts(spark, "C61", " c50.1 ", "C49.2", "D05.1", "D09.0", "D09.1", "I10", "C6", "", None)
    assert one(df, C.entity_label("v")) == ["Prostata", "Brust", "C49", "Brust", "Harnblase", "D09", "I10", None, None, None]
    assert one(df, C.entity_group("v"))[:3] == ["C61", " c50.1 ".split(".")[0], "C49"]


def test_paths_over_missing_structure(spark):
    concept = TYPE_ALIASES["CodeableConcept"]
    df = spark.sql(
        f"""SELECT 0 AS i, cast(null AS {concept}) AS c UNION ALL
            SELECT 1, cast(named_struct('coding', array(), 'text', null) AS {concept}) UNION ALL
            SELECT 2, cast(named_struct('coding', array(named_struct('system', 's', 'version', null, 'code', null, 'display', null)), 'text', null) AS {concept}) UNION ALL
            SELECT 3, cast(named_struct('coding', array(named_struct('system', 't', 'version', null, 'code', 'x', 'display', null),
                named_struct('system', 's', 'version', '1', 'code', 'y', 'display', 'Y')), 'text', 'z') AS {concept})"""
    )
    assert one(df, P.coding_code("c", "s")) == [None, None, None, "y"]
    assert one(df, P.first_code("c")) == [None, None, None, "x"]
    assert one(df, P.has_coding("c", "s", ["y"])) == [False, False, False, True]
    assert one(df, P.lacks_code("c")) == [True, True, True, False]
    assert one(df, P.lacks_code("c", "t")) == [True, True, True, False]
    assert one(df, P.coding_code_any("c", ["s", "t"])) == [None, None, None, "x"]


def test_reference_keys(spark):
    df = texts(spark, "Patient/1", "http://host/fhir/Patient/1", "Patient/1/_history/2", "urn:uuid:5", None)
    ref = F.struct(F.col("v").alias("reference"))
    assert one(df, P.reference_key(ref)) == ["Patient/1", "Patient/1", "Patient/1", None, None]


def test_sections_of_tag_soup(spark):
    df = texts(
        spark,
        '<d></x><Section id="M5_Therapie"><CONTENT>a &lt; b</CONTENT> x <content><b>c</b></content></Section></d>',
        "<section id='M5_Therapie'><content> </content></section>",
        "<section id='other'><content>q</content></section>",
        None,
    )
    assert one(df, T.extract_section("v", "M5_Therapie")) == ["a < b\n\nc", None, None, None]


def test_html(spark):
    df = texts(spark, "<h2>A</h2><p>x<br>y &amp; z</p><ul><li>1</li><li>2</li></ul><script>no</script>")
    assert one(df, T.html_to_text("v")) == ["## A\n\nx\ny & z\n\n- 1\n- 2"]


def test_finding_dates(spark):
    df = texts(spark, "12/19", "13.12.19", "3.4.2021", "2020", "bald", None)
    assert one(df, T.normalise_finding_date("v", F.lit("2022-02-03T00:00:00"))) == [
        "2019-12",
        "2019-12-13",
        "2021-04-03",
        "2020",
        "2022-02-03",
        "2022-02-03",
    ]


def test_safe_names(spark):
    assert one(texts(spark, "a b/c", "--x--", "Ä"), T.safe_name("v")) == ["a-b-c", "x", ""]


def test_all_references_of_html(spark):
    names = ["alpha;", "Alpha;", "hearts;", "NotEqualTilde;", "fjlig;", "amp", "amp;", "AMP", "copy", "copyright", "notit;", "notin;", "eacute", "eacutex", "nbsp;", "bogus;", "b", ""]
    numbers = ["#945;", "#x3b1", "#X3B1;", "#128;", "#x9F;", "#129;", "#0;", "#xD800;", "#x110000;", "#160;", "#", "#x;", "#12345678;", "#38;lt;"]
    cases = [f"a &{n} b&{n}c" for n in names + numbers] + ["&&amp;&", "&lt;&lt;", "&ampamp;"]
    df = spark.createDataFrame([(c,) for c in cases], "v string").select("v", T.decode_entities("v").alias("got"))
    for r in df.collect():
        want = html.unescape(r["v"]).replace("\u00a0", " ")
        if "#129" not in r["v"] and "#12345678" not in r["v"]:
            assert r["got"] == want, r["v"]


@pytest.mark.parametrize("page, want", [
    ('<p title="x>y">one</p>', "one"),
    ("<p title='a > b' data=\"<i>\">one</p>two", "one\n\ntwo"),
    ("a < b and c > d", "a < b and c > d"),
    ("one<!-- <p>two</p> -- > -->three", "onethree"),
    ("one<!-- open", "one"),
    ("one <b", "one"),
    ("one <b>two", "one two"),
    ("<!DOCTYPE html><?xml version='1'?>x", "x"),
    ("x<![CDATA[<b> &amp; ]] ]]>y", "x<b> &amp; ]] y"),
    ("x<![CDATA[<b>", "x<b>"),
    ("<SCRIPT>if (a<b) {}</SCRIPT >x<style>p{}", "x"),
    ('<h2 class=">">T</h2><ul><li id="a>">u</li></ul>', "## T\n\n- u"),
    ("&alpha;&beta; &lt;b&gt;", "\u03b1\u03b2 <b>"),
    ("<p>it's \"quoted\"</p>", "it's \"quoted\""),
    ('broken <a href="x>y</a> z', "broken y z"),
])
def test_pages_to_text(spark, page, want):
    assert one(texts(spark, page), T.html_to_text("v")) == [want]


def test_references_of_many_names(spark):
    from html import unescape

    many = " ".join(f"&#{n};&zz{n}" for n in range(300, 300 + T.FEW_NAMES)) + "&amp;&copyright&#x41;"
    few = "&eacute;x&amp;lt;&#x65;&#101;1&notit;& &#; &zz;&eacute;"
    assert one(texts(spark, many, few), T.decode_entities("v")) == [unescape(many), unescape(few)]


def test_a_section_is_looked_for_once(spark):
    df = texts(spark, "x").select(T.extract_section("v", "only_id").alias("s"))
    assert df._jdf.queryExecution().analyzed().toString().count("only_id") == 1
