import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortloom.llm import simhash

SCHEMA = "doc_id long, text string, fp string, root int"


def fingerprint(text):
    words = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), words))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            root[find(j)] = find(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, fps[i], least.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def found(spark, rows):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    return sorted(((r[0], r[1] % (1 << 64), r[2]) for r in simhash.near_duplicates(df).collect()), key=str)


def test_any_five_positions_hold_a_set():
    for five in combinations(range(8), 5):
        assert any(set(s) <= set(five) for s in simhash.SETS)


def test_against_brute_force(spark):
    words = [f"w{i % 97}{chr(97 + i % 13)}" for i in range(3000)]
    rows = [(i, " ".join(words[i * 7 : i * 7 + 300])) for i in range(60)]
    rows += [(100 + i, " ".join([*words[:i], "Changed", *words[i + 1 : 400]])) for i in range(60)]
    rows += [(7, rows[7][1]), (300, None), (301, ""), (302, " \n"), (303, "one"), (304, "One two"), (None, words[3]), (305, "é É")]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_hot_postings_are_refined(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = np.uint64(rng.integers(1 << 62))
    near = np.unique(base ^ rng.integers(0, 1 << 14, 900, dtype=np.uint64))
    fps = np.concatenate((near, rng.integers(0, 1 << 63, 400, dtype=np.uint64)))
    monkeypatch.setattr(simhash, "HOT", 50)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = [(r.u, r.v) for r in simhash.links(df).collect()]
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    a, b = (np.array([at[e[k]] for e in edges]) for k in (0, 1))
    close = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    want = simhash._roots(len(fps), close[:, 0], close[:, 1])
    assert (simhash._roots(len(fps), a, b) == want).all()
    assert len(edges) <= 56 * len(fps)


@pytest.mark.parametrize("n", [3000, 17000])
def test_wide_links(n):
    rng = np.random.default_rng(1)
    fp = np.unique(np.uint64(99) ^ rng.integers(0, 1 << 15 if n > 9000 else 1 << 24, n * 2, dtype=np.uint64))[:n]
    close = [np.argwhere(np.bitwise_count(fp[i : i + 500, None] ^ fp) <= 3) + (i, 0) for i in range(0, len(fp), 500)]
    close = np.concatenate(close)
    u, v = simhash._wide_links(fp)
    root = np.arange(len(fp))
    root[u] = v
    assert (root == simhash._roots(len(fp), close[:, 0], close[:, 1])).all()


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, text), (3, text), (3, text), (9, "other text of some words"), (1, None), (2, "")]
    rows += [(None, text), (None, "one two three four"), (None, "five six seven eight"), (None, "five six seven eight")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    found = kept.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [1, 3, 9]
    assert sorted(r.text for r in found if r.doc_id is None) == ["five six seven eight", "one two three four"]


def test_a_shared_key_keeps_only_the_texts_of_its_own_group(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "vw")
    rows = [(5, one), (5, two), (3, two), (5, one), (8, "some other words here")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(df).collect()) == [(3, two), (5, one), (8, "some other words here")]


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "something else entirely here"), (None, "a b c d"), (None, "quite alone"), (7, "seven x y"), (7, "seven other z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({n: F.col("doc_id") for n in ("_fp", "_own", "_kept", "fp", "row", "key", "n", "component_id")})
    out = simhash.keep_one(df)
    assert out.schema == df.schema
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert kept == sorted([(1, "a b c d"), (3, "something else entirely here"), (None, "quite alone"), (7, "seven x y"), (7, "seven other z")], key=str)
    assert all(r.key == r.doc_id == r._fp for r in out.collect())
