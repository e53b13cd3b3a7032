import hashlib

import pytest

from cohortloom.llm import warc
from cohortloom.llm.queries import QUERIES, SQL

SCHEMA = "page_id long, url string, html string, digest string, name int"


def brute(rows):
    first, out = {}, []
    for key, html in rows:
        if key is not None:
            data = (html or "").encode()
            first[data] = min(key, first.get(data, key))
    for key, html in rows:
        data = (html or "").encode()
        original = first.get(data) if len(data) >= 100 else None
        revisit = original is not None and original != key
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(k, f"http://x/{k}\r\ny", h, "d", 1) for k, h in rows], SCHEMA)


def test_round_trip(spark):
    body = "<p>é😀</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 4
    rows = [(9, body), (4, body), (7, body), (1, "short"), (2, "short"), (3, None), (5, ""), (6, "x" * 99), (8, "x" * 99), (10, "y" * 100), (11, "y" * 100)]
    rows += [(12, "z" * 500_000), (13, "\r\n\r\n"), (4, body), (None, body), (14, " " * 150), (20, "\x00\x1a" * 60), (19, "\x00\x1a" * 60)]
    got = sorted((tuple(r) for r in warc.archived(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert warc.archived(frame(spark, [])).collect() == []


def test_archives_hold_equal_payloads_once(spark, tmp_path):
    rows = [(i, "same payload " * 20) for i in range(50)] + [(100, "other " * 40)]
    path = f"{tmp_path}/warc"
    warc.write_archives(frame(spark, rows), path)
    read = warc.read_archives(spark, path).collect()
    assert sorted(int(r.name) for r in read if r.payload is not None) == [0, 100]
    assert {r.payload.decode() for r in read if r.payload is not None} == {"same payload " * 20, "other " * 40}


def test_damaged_archives_fail():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"nothing"))


def test_sql(spark):
    from checks.compare import differences, open_tables, sql_rows

    df = QUERIES["op4_warc_revisits"](spark, "/root/testdata/sf0.001")
    names, expected = sql_rows(open_tables("/root/testdata/sf0.001"), SQL["op4_warc_revisits"])
    assert differences(df.columns, df.collect(), names, expected) is None
