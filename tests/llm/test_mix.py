import re

import pytest

from cohortloom.llm import mix
from cohortloom.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, source string, size string, hash int, target string"


def targets(sizes):
    """Sources with their size to targets, by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return {**stopped, **share}
        stopped |= {s: 3 * sizes[s] for s in above}


def run(spark, rows):
    df = spark.createDataFrame([(k, t, s, "x", 1, "y") for k, t, s in rows], SCHEMA)
    return mix.mix(df).collect()


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_repeats(spark):
    rows = [(i, "w " * (i % 40 + 1), s) for i, s in enumerate(["b"] * 400 + ["a"] * 9 + [None] * 30 + ["é"] * 200 + ["c"] * 3)]
    rows += [(5000, None, "b"), (5001, "", "zero"), (None, "x y", "b"), (None, "x\x0by\x1fz q", "c"), (3, "again once", "b"), (3, "again once", "b")]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes)
    found = run(spark, rows)
    assert len(found) == len(rows)
    taken, largest = {}, {}
    for r in found:
        assert r.copies <= 3 and r.taken == r.size * r.copies
        assert (r.source_size, round(r.target, 6)) == (sizes[r.source], round(want[r.source], 6))
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    assert sorted(map(str, found)) == sorted(map(str, run(spark, rows[::-1])))


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "s"), (1, "a b", "s")]])
def test_small_tables(spark, rows):
    assert sum(r.taken for r in run(spark, rows)) == sum(words(t) for _, t, _ in rows)


def test_rows_are_repeated(spark):
    rows = [(i, "w " * 10, "a" if i < 3 else "b", "x", 1, "y") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix.repeated(df)
    assert out.columns == df.columns
    assert sum(r.source == "a" for r in out.collect()) == 9


def test_rows_are_repeated_by_their_own_source(spark):
    """Keys that are NULL or stand in two sources are taken as each source asks for."""
    rows = [(None if i % 2 else i, f"w{i} " * 10, "a" if i < 20 else "b", "x", 1, "y") for i in range(620)]
    rows += [(i, "other " * 10, "b", "x", 1, "y") for i in range(0, 20, 2)]
    out = mix.repeated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.source == "a" for r in out) == 60
    idless = [r.text for r in out if r.doc_id is None and r.source == "b"]
    assert 0 < len(set(idless)) and len(out) == 60 + sum(r.source == "b" for r in out)
    few = [(None, f"w{i} " * 10, "a" if i < 400 else "c", "x", 1, "y") for i in range(800)]
    out = mix.repeated(spark.createDataFrame(few, SCHEMA)).collect()
    for source, weight in (("a", 5), ("c", 2)):
        assert abs(sum(r.source == source for r in out) - 800 * weight / 7) <= 2


@pytest.mark.parametrize("rows", [
    [(None, "w " * 10, "a") for _ in range(400)] + [(i, f"w{i} " * 10, "b") for i in range(300)],
    [(None, f"w{i} " * 10, "a") for i in range(400)] + [(7, "w " * 50, "b") for _ in range(200)] + [(7, None, None)],
    [(7, "w " * 9, s) for s in "abcd" for _ in range(150)],
])
def test_null_and_repeated_keys_come_near_their_target(spark, rows):
    """Rows of one key, or of none, do not stand or fall together, not even equal ones."""
    found = run(spark, rows)
    taken, target, largest = {}, {}, {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], largest[r.source] = r.target, max(largest.get(r.source, 0), r.size)
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest[s] / 2
    assert sorted(map(str, found)) == sorted(map(str, run(spark, rows[::-1])))
    kept = mix.repeated(spark.createDataFrame([(k, t, s, "x", 1, "y") for k, t, s in rows], SCHEMA)).collect()
    for s in taken:
        assert sum(words(r.text) for r in kept if r.source == s) == taken[s]


def test_many_sources(spark):
    rows = [(i, "w " * (i % 23), f"s{i % 700:03}" if i % 11 else None) for i in range(2500)]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes)
    for r in run(spark, rows):
        assert (r.source_size, round(r.target, 6)) == (sizes[r.source], round(want[r.source], 6))


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(i, "w " * 10, "a" if i < 3 else "b", "x", 1, "y") for i in range(30)], SCHEMA)
    for name in ("_hash", "_text", "_name", "_rule", "_copies", "row", "copies", "threshold", "base", "left", "_of", "_at"):
        df = df.withColumnRenamed("target", name) if "target" in df.columns else df.withColumn(name, df[df.columns[0]])
    out = mix.repeated(df)
    assert out.columns == df.columns and out.schema == df.schema and out.count() > 0


def test_very_long_text(spark):
    (row,) = run(spark, [(1, "w " * 2_000_000, "a")])
    assert row.size == row.taken == 2_000_000


def test_sql(spark):
    from checks.compare import differences, open_tables, sql_rows

    df = QUERIES["op1_source_mix"](spark, "/root/testdata/sf0.001")
    names, expected = sql_rows(open_tables("/root/testdata/sf0.001"), SQL["op1_source_mix"])
    assert differences(df.columns, df.collect(), names, expected) is None
