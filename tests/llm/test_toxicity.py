import zlib

import numpy as np
from pyspark.sql import functions as F

from cohortloom.llm import toxicity
from cohortloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = toxicity.classify(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    rows = found.join(table(spark, FOLDER, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.93
    assert not any(r.predicted for r in held if not r.toxic)


def test_held_out_labels_do_not_count(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (sorted(map(tuple, toxicity.classify(docs, x).collect())) for x in (labels, turned))
    assert first == second


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 3), (1, "", "a", 3), (None, "i d i o t you", "a", 3), (2, "word " * 30000, "a", 3), (3, "!!! |", "a", 3)],
        "doc_id long, text string, score string, label int",
    )
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(1, 0, None), (3, 0, 0), (3, 1, 1), (None, 1, 0), (2, 0, 7)], schema)
    for labels in (none, odd):
        rows = toxicity.classify(docs, labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert toxicity.classify(docs.limit(0), none).count() == 0


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    z = rng.normal(size=2000)
    y = (rng.random(2000) < toxicity.sigmoid(z)).astype(int)
    places, shares = toxicity.isotonic(z, y)
    assert (np.diff(shares) >= 0).all() and (np.diff(places) >= 0).all()
    assert np.abs(np.interp(z, places, shares) - toxicity.sigmoid(z)).mean() < 0.08


def test_features_see_disguise():
    names = toxicity.FEATURES
    row = dict(zip(names, toxicity._row("You are an 1d10t and a l o s e r , st*pid !! du", {"=idiot": 3.0})))
    assert row["masked_known"] >= 1 and row["mark_runs"] > 0 and row["you_rate"] > 0


def test_pooling_against_the_min_max_formula():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 60):
        z, y = np.sort(rng.normal(size=n)), rng.integers(0, 2, n)
        places, shares = toxicity.isotonic(z, y)
        # Best rising fit at i: the largest of the least means of stretches around i.
        fit = [max(min(y[a : b + 1].mean() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        pools = {}
        for v, label in zip(fit, y):
            s, m = pools.get(v, (0, 0))
            pools[v] = (s + label, m + 1)
        want = np.maximum.accumulate([(pools[v][0] + 0.5) / (pools[v][1] + 1) for v in fit])
        assert np.allclose(np.interp(z, places, shares), want)


def test_one_round_against_a_search_of_all_cuts():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (200, 3)).astype(float)
    y = (x[:, 1] + rng.normal(size=200) > 3).astype(int)
    trees = toxicity.fit_trees(x, y, rounds=1, rate=1.0, depth=1)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = y - p, np.full(len(y), p * (1 - p))
    best = max(
        ((g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1), f, e) for f in range(3) for e in range(5) for left in [x[:, f] <= e] if 0 < left.sum() < len(y)),
    )
    left = x[:, best[1]] <= best[2]
    want = np.log(p / (1 - p)) + np.where(left, g[left].sum() / (h[left].sum() + 1), g[~left].sum() / (h[~left].sum() + 1))
    assert np.allclose(trees.logits(x), want)


def test_lexicon_against_plain_counts(spark):
    rows = [("du idiot hier", 1)] * 4 + [("ein guter tag", 0)] * 30 + [("Idioten! ja", 1)] * 3
    texts = spark.createDataFrame(rows, "text string, label int")
    want = {}
    count = {}
    for text, label in rows:
        words = {w.strip("!").lower() for w in text.split()}
        for g in {g for w in words for g in toxicity.grams(w)}:
            count.setdefault(g, [0, 0])[label] += 1
    for g, (clean, toxic) in count.items():
        odds = np.log(((toxic + 0.1) / (7 + 1)) / ((clean + 0.1) / (30 + 1)))
        if toxic >= 3 and odds >= np.log(10):
            want[g] = odds
    found = toxicity.learned_lexicon(texts)
    assert found.keys() == want.keys() and all(abs(found[g] - want[g]) < 1e-9 for g in want)


def test_a_repeated_key_is_learned_once(spark):
    from cohortloom.llm.labelled import learning_rows, learning_texts

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, None), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    found = learning_texts(docs, learning_rows(labels, "toxic", (7, 6), 10))
    assert sorted(map(tuple, found.collect())) == [("b", 1), ("text 0", 0)]
