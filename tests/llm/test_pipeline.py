import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_simhash import brute as near_groups
from test_suffixes import L, brute as removed
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice("ab cd ef gh ij kl mn".split()) + rng.choice("op qr st uv é ß".split()) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randrange(20, 200)) for _ in range(60)]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(8)]
    texts += [texts[3], texts[3], texts[5].replace("ab", "ab", 1) + " x"]
    texts += [" ".join(w.upper() + "!!" for w in prose(rng, 80).split()) for _ in range(25)]
    texts += [None, "", "word"]
    rows = [(i, t, "en", None if i % 9 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, int(not (71 <= i < 96)), 0) for i in range(0, 96)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "repeated_passages", "mixing", "tokens"]
    before = {r.doc_id: r.text for r in docs.collect()}

    good = stages["quality"](spark, docs, folder)
    kept = {r.doc_id: r.text for r in good.collect()}
    assert good.columns == docs.columns and set(range(71)) <= set(kept)
    assert len(set(kept) & set(range(71, 96))) <= 2

    single = stages["near_duplicates"](spark, good, folder)
    left = {r.doc_id: r.text for r in single.collect()}
    assert single.columns == docs.columns
    assert set(left) == {c for _, _, c in near_groups(list(kept.items()))}

    clean = stages["repeated_passages"](spark, single, folder)
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert clean.columns == docs.columns and set(texts) == set(left)
    count = Counter(d[i : i + L] for d in ((t or "").encode() for t in left.values()) for i in range(len(d) - L + 1))
    for (key, text), (_, n, _, digest) in zip(left.items(), removed(list(left.values()))):
        new, chars = texts[key]
        assert new is None or chars == len(new)
        if not n:
            assert new == text
        else:
            data = text.encode()
            gone = np.zeros(len(data), bool)
            for i in range(len(data) - L + 1):
                gone[i : i + L] |= count[data[i : i + L]] > 1
            assert new == np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
            assert hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest() == digest

    mixed = stages["mixing"](spark, clean, folder)
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and max(times.values()) <= 3
    assert {r.doc_id: r.text for r in mixed.collect()} == {k: texts[k][0] for k in times}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = stages["tokens"](spark, mixed, folder).collect()
    assert Counter(r.doc_id for r in rows) == times
    for r in rows:
        ids = library.encode(texts[r.doc_id][0] or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert before[3] == before[68]


def test_run_is_the_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(tuple, pipeline.run(spark, folder).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
