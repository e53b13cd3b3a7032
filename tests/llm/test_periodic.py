"""Periodic runs against a search of all periods."""

import hashlib
import random
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.llm import periodic


def brute_force(words):
    """All runs by trying every period on every stretch."""
    out, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            length = e - s
            if length >= max(6, 4 * q):
                part = words[s:e]
                smallest = next(p for p in range(1, q + 1) if all(a == b for a, b in zip(part, part[p:])))
                if smallest == q:
                    out.add((s, length, q))
            s = max(s + 1, e - q + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def best_of(runs):
    from fractions import Fraction

    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None


words_ = st.lists(st.sampled_from("abc"), max_size=60).map("".join)
loops = st.lists(st.tuples(st.text("ab", min_size=1, max_size=5), st.integers(1, 9)), max_size=6).map(lambda x: "".join(w * n for w, n in x))


@settings(max_examples=600, deadline=None)
@given(st.one_of(words_, loops))
def test_runs(text):
    words = [c.encode() for c in text]
    assert periodic.word_runs(words) == brute_force(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_array(x):
    a = np.array(x)
    assert periodic.suffix_array(a).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=40))
def test_branching_tandems(text):
    n = len(text)
    expected = {
        (d, i)
        for d in range(1, n // 4 + 1)
        for i in range(n - 2 * d + 1)
        if text[i : i + d] == text[i + d : i + 2 * d] and text[i + d] != text[i + 2 * d : i + 2 * d + 1]
    }
    assert periodic.branching_tandems(np.array([ord(c) for c in text])) == expected


def test_long_texts_take_time_in_proportion():
    cases = {
        "one word": [b"a"] * 200_000,
        "one period": [str(i % 7919).encode() for i in range(200_000)],
        "two words": [bytes([97 + (i.bit_count() & 1)]) for i in range(200_000)],
        "no runs": [str(i * i % 99_991).encode() for i in range(200_000)],
    }
    for name, words in cases.items():
        began = time.process_time()
        runs = periodic.word_runs(words)
        assert time.process_time() - began < 30, name
        if name.startswith("one"):
            assert len(runs) == 1 and runs[0][:2] == (0, 200_000)
        else:
            assert runs == []


def expected_row(key, text):
    words = [w.encode() for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    if key is not None and n and (h := zlib.crc32(str(key).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_force(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = best_of(runs)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(runs), *most, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_rows(spark, rows):
    rng = random.Random(4)
    docs = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choices("aäb ", k=rng.randrange(60)))) for i in range(150)]
    docs += [(i, "x y " * 9 + "z " + "w " * rng.randrange(12)) for i in range(150, 200)]
    docs += [(None, "a " * 7), (None, None), (7, ""), (7, None), (7, "b " * 6), (7, "b " * 6), (300, "lorem " * 5000)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    # Columns that bear the operator's own names are ignored.
    table = table.withColumns({n: F.lit("x") for n in ("key", "name", "start", "n_runs", "collapsed")})
    found = periodic.run_digests(table, edit=periodic.looped).drop("collapsed")
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = [expected_row(*d) for d in docs if d[0] != 300]
    assert rows(found.filter("doc_id IS NULL OR doc_id <> 300")) == sorted(expected, key=lambda t: tuple(str(x) for x in t))
    (long,) = rows(found.filter("doc_id = 300"), "n_runs", "start", "length", "period", "exponent_milli")
    assert long == (1, 0, 5000, 1, 5_000_000)


def test_collapsed_texts(spark, rows):
    docs = spark.createDataFrame([("a", "so so so so so so on"), ("b", "to be or not"), (None, None)], "doc_id string, text string")
    assert rows(periodic.run_digests(docs), "doc_id", "n_runs", "collapsed") == [(None, 0, ""), ("a", 1, "so on"), ("b", 0, "to be or not")]


def test_empty_table(spark):
    found = periodic.run_digests(spark.createDataFrame([], "doc_id bigint, text string"))
    assert found.collect() == []
