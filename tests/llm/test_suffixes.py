import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import suffixes

L = suffixes.LENGTH


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + L] for d in data for i in range(len(d) - L + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - L + 1):
            if count[d[i : i + L]] > 1:
                gone[i : i + L] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(spark, rows):
    df = spark.createDataFrame([(k, t, "x", [1]) for k, t in rows], "doc_id long, text string, spots string, runs array<int>")
    return sorted((tuple(r) for r in suffixes.removal_digests(df).collect()), key=str)


def wanted(rows):
    return sorted(((k, *b) for (k, _), b in zip(rows, brute([t for _, t in rows]))), key=str)


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) + rng.choice(["ti", "on", "er", "é", "ß"]) * rng.randrange(1, 4) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passage, line = prose(rng, 60), prose(rng, 14)
    rows = [(i, prose(rng, rng.randrange(5, 150))) for i in range(40)]
    rows += [(100 + i, prose(rng, i) + passage[: rng.randrange(150, 400)] + prose(rng, 40 + i)) for i in range(30)]
    rows += [(200 + i, prose(rng, 30) + line + prose(rng, 30)) for i in range(30)]
    rows += [(300, rows[3][1]), (3, rows[3][1]), (301, "a" * 900), (302, "a" * 199), (303, "ab" * 150), (304, None), (305, ""), (None, rows[8][1])]
    rows += [(306, passage + passage), (307, "x" + rows[5][1][:500] + "y"), (308, "\0" * 350), (309, "é" * 180)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == wanted(rows)


@pytest.mark.parametrize("hot, deep", [(0, 50_000), (5, 3), (0, 0)])
def test_hot_grams(spark, monkeypatch, hot, deep):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "DEEP", deep)
    rows = corpus(3)
    assert found(spark, rows) == wanted(rows)


def test_no_rows_and_short_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "a"), (1, "a"), (2, None)]) == wanted([(1, "a"), (1, "a"), (2, None)])


@pytest.mark.parametrize("shard", [1, 900, 3000, 1 << 20])
def test_shards_are_merged(shard):
    rng = random.Random(5)
    base = prose(rng, 80).encode()
    passages = [base[rng.randrange(40) : rng.randrange(240, 340)] for _ in range(60)] + [base[:250]] * 3
    gram = np.sort(np.array([rng.randrange(3) for _ in passages]))
    copies = np.ones(len(passages), np.int64)
    copies[7] = 2
    count = Counter()
    for g, p, c in zip(gram, passages, copies):
        for i in range(len(p) - L + 1):
            count[g, p[i : i + L]] += c
    # Grams that don't share strings, as the operator deals them.
    passages = [bytes([65 + g]) * 3 + p for g, p in zip(gram, passages)]
    count = Counter()
    for p, c in zip(passages, copies):
        for i in range(len(p) - L + 1):
            count[p[i : i + L]] += c
    seen = {}
    for g, p in zip(gram, passages):
        for i in range(len(p) - L + 1):
            seen.setdefault(p[i : i + L], set()).add(g)
    runs = suffixes.repeated_strings(gram, passages, copies, L, shard)
    for g, p, r in zip(gram, passages, runs):
        got = {i for a, b in r.reshape(-1, 2) for i in range(a, b + 1)}
        for i in range(len(p) - L + 1):
            s = p[i : i + L]
            if len(seen[s]) == 1:
                assert (i in got) == (count[s] > 1)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for n, letters in ((0, 2), (1, 2), (300, 2), (900, 1), (1500, 4), (700, 3)):
        data = rng.integers(97, 97 + letters, n).astype(np.uint8)
        data[n // 2 :] = data[: n - n // 2]
        raw = data.tobytes()
        sa = suffixes.suffix_array(data)
        assert [raw[i:] for i in sa] == sorted(raw[i:] for i in range(n))
        shared = suffixes.common_prefixes(data, sa)
        for k in range(1, n):
            a, b = raw[sa[k - 1] :], raw[sa[k] :]
            same = next((i for i in range(min(L, len(a), len(b))) if a[i] != b[i]), min(L, len(a), len(b)))
            assert shared[k] == same


def test_texts_without_repeats(spark):
    rows = [(1, "é" * 150 + "ü" * 30, 180), (2, "xé" + "é" * 149, 151), (3, None, 0), (4, "short", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = suffixes.without_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[3] == (None, None) and got[4] == ("short", 5)
    # The first byte of the first ü ends a string that occurs twice, so that letter goes as well.
    assert got[1] == ("ü" * 29, 29) and got[2] == ("x", 1)


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "é" * 150, 150), (2, "é" * 150, 150), (3, None, 0)], "doc_id long, text string, n_chars int")
    df = df.withColumns({n: F.col("doc_id") * 2 for n in ("_d1", "_d2", "_runs", "d1", "d2", "runs", "row", "new", "doc")})
    out = suffixes.without_repeats(df)
    assert out.schema == df.schema
    assert sorted((r.doc_id, r.text, r.n_chars, r.runs, r.row) for r in out.collect()) == [(1, "", 0, 2, 2), (2, "", 0, 4, 4), (3, None, None, 6, 6)]
    only = suffixes.without_repeats(df.select("text"))
    assert only.columns == ["text"] and only.count() == 3


def test_texts_beyond_a_segment(spark, monkeypatch):
    """A very long text, cut into segments of a few kilobytes, against counting all strings."""
    monkeypatch.setattr(suffixes, "_SEGMENT", 4096)
    rng = random.Random(4)
    piece = "".join(rng.choices("abcdefgh", k=700))
    long = "".join(rng.choices("abcdefgh", k=9000)) + piece + "".join(rng.choices("abcdefgh", k=5000)) + piece[:450]
    rows = [(1, long), (2, "x" + piece[100:400] + "y"), (3, "z" * 260)]
    count = Counter(t[i : i + L] for _, t in rows for i in range(len(t) - L + 1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in suffixes.removal_digests(df).collect():
        own = dict(rows)[r.doc_id]
        gone = {j for i in range(len(own) - L + 1) if count[own[i : i + L]] > 1 for j in range(i, i + L)}
        assert r.n_removed == len(gone)
        assert r.kept_sha256 == hashlib.sha256("".join(c for i, c in enumerate(own) if i not in gone).encode()).hexdigest()
