import zlib

import numpy as np
from pyspark.sql import functions as F

from cohortloom.llm import quality
from cohortloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = quality.classify(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    rows = found.join(table(spark, FOLDER, "labels"), "doc_id").collect()
    assert found.count() == table(spark, FOLDER, "documents").count()
    held = [r for r in rows if r.held_out]
    assert held and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_held_out_labels_do_not_count(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (sorted(map(tuple, quality.classify(docs, x).collect())) for x in (labels, turned))
    assert first == second


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 3), (1, "", "a", 3), (None, "some text", "a", 3), (2, "word " * 30000, "a", 3), (3, "!!! |", "a", 3)],
        "doc_id long, text string, score string, label int",
    )
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, 0), (3, 0, 0), (3, 1, 0), (None, 1, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        rows = quality.classify(docs, labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
        assert all(r.held_out for r in rows if r.doc_id is None)
    assert quality.classify(docs.limit(0), none).count() == 0
    assert quality.keep_good(docs, none).columns == docs.columns


def test_windows_reach_the_end_of_a_text():
    rng = np.random.default_rng(2)
    names = {n: i for i, n in enumerate(quality.FEATURES)}
    for n in (401, 800, 1000, 5000):
        clean = ("word and then " * n)[:n].encode()
        for junk in (b"!|" * 190, b"A" * 200):
            own = dict(zip(names, quality._row(clean + junk)))
            text = clean + junk
            starts = [*range(0, len(text) - 400, 200), len(text) - 400]
            for name, signs in (("upper_window", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("bar_window", b"|")):
                want = max(sum(b in signs for b in text[s : s + 400]) for s in starts) / 400
                assert abs(own[name] - want) < 1e-12
    words = [str(v) for v in rng.integers(0, 10**6, 137)] + ["same"] * 40
    least = min(len(set(words[s : s + 60])) for s in [*range(0, len(words) - 60, 30), len(words) - 60]) / 60
    assert quality._row(" ".join(words).encode())[names["distinct_window"]] == least


def test_one_round_against_a_search_of_all_trees():
    """The first table of a single feature: the best tree of up to four leaves by greedy cuts."""
    rng = np.random.default_rng(4)
    g, h = rng.normal(size=9), rng.random(9) + 0.2

    def value(s, e):
        return g[s:e].sum() ** 2 / (h[s:e].sum() + 1)

    parts = [(0, 9)]
    while len(parts) < 4:
        gain, s, k, e = max(((value(s, k) + value(k, e) - value(s, e), s, k, e) for s, e in parts for k in range(s + 1, e)), default=(0, 0, 0, 0))
        if gain <= 1e-9:
            break
        parts = [p for p in parts if p != (s, e)] + [(s, k), (k, e)]
    want = np.concatenate([np.full(e - s, g[s:e].sum() / (h[s:e].sum() + 1)) for s, e in sorted(parts)])
    assert np.allclose(quality._shallow(g, h, 0.0), want)
