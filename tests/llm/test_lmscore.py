import math
from collections import Counter, defaultdict

import numpy as np

from cohortloom.llm import lmscore
from cohortloom.llm.common import table

SCHEMA = "doc_id long, text string, score string, n_tokens int"


def model(texts, known):
    """Chance of a token after a context, by dictionaries."""
    tables = [defaultdict(Counter) for _ in range(lmscore.ORDER)]
    for text in texts:
        tokens = ["<"] * (lmscore.ORDER - 1) + [c if c in known else "?" for c in (text or "").lower()] + ["<"]
        for i in range(lmscore.ORDER - 1, len(tokens)):
            for n in range(lmscore.ORDER):
                tables[n][tuple(tokens[i - n : i])][tokens[i]] += 1

    def chance(context, token):
        p = 1 / lmscore.SIZE
        for n in range(lmscore.ORDER):
            own = tables[n].get(tuple(context[len(context) - n :]))
            if own:
                p = (own[token] + len(own) * p) / (sum(own.values()) + len(own))
        return p

    return chance


def loss(chance, text, known):
    tokens = ["<"] * (lmscore.ORDER - 1) + [c if c in known else "?" for c in (text or "").lower()] + ["<"]
    at = range(lmscore.ORDER - 1, len(tokens))
    return sum(-math.log2(chance(tokens[i - lmscore.ORDER + 1 : i], tokens[i])) for i in at) / len(at)


def test_against_dictionaries(spark):
    texts = ["The cat sat on the mat", "A dog, a DOG!", None, "", "straße é 漢字 😀", "zz" * 40, "The cat sat on the mat"]
    rows = [(i if i != 4 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = docs.filter("doc_id in (0, 1)").select("text")
    counted = Counter("".join((t or "").lower() for t in texts))
    known = {c for c, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0]))[: lmscore.SIZE - 2]}
    models = [model([t for t in x], known) for x in (texts[:2], texts)]
    got = lmscore.scored(docs, target).collect()
    assert len(got) == len(rows)
    for (key, text, *_), r in zip(sorted(rows, key=lambda r: str(r[0])), sorted(got, key=lambda r: str(r.doc_id))):
        want = [loss(m, text, known) for m in models]
        assert np.allclose([r.target_loss, r.background_loss, r.score], [*want, want[1] - want[0]], atol=1e-5)
        assert r.n_tokens == len((text or "").lower()) + 1


def test_odd_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lmscore.scored(docs, docs.select("text")).collect() == []
    docs = spark.createDataFrame([(1, "some text", "x", 1)], SCHEMA)
    only = lmscore.scored(docs, docs.select("text").limit(0)).first()
    assert math.isclose(only.target_loss, lmscore.BITS)


def test_target_documents_score_higher(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    rows = lmscore.scored(docs, lmscore.labelled_target(docs, labels)).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > np.mean(bad)


def test_every_character_counts(spark):
    """More different characters than the 30 of an earlier vocabulary, in several blocks; the rare ones tell."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789\n.,éèñäöüß漢字かなабвг"
    rows = [(i, letters, "x", 1) for i in range(30)] + [(100, "qqqq 漢漢漢漢", "x", 1), (101, "vvvv 字字字字", "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in lmscore.scored(docs, docs.filter("doc_id = 100").select("text")).collect()}
    assert got[100].target_loss < 2 < got[101].target_loss
    models = [model([t for _, t, *_ in x], set("".join(t for _, t, *_ in rows))) for x in ([rows[-2]], rows)]
    want = [loss(m, rows[-1][1], set(letters + "qv ")) for m in models]
    assert np.allclose([got[101].target_loss, got[101].background_loss], want, atol=1e-5)


def test_blocks_change_nothing(spark, monkeypatch):
    rows = [(i, f"text {i % 7} of {'éß漢'[i % 3]} words " * (i % 5), "x", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = docs.filter("doc_id < 9").select("text")
    whole = sorted(map(tuple, lmscore.scored(docs, target).collect()))
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 200)
    assert np.allclose(whole, sorted(map(tuple, lmscore.scored(docs, target).collect())))
