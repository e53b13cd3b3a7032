import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  \n x", "<|endoftext|>", "hi<|endoftext|> there <|endoftext|>", "<|endoftext", "it's we'll I'M 'll",
    "ünï ςöd 漢字 😀🏽 ́x", "a" * 5000, " " * 300 + "x", "aaab" * 700, "\x00\x1f", "123 4567 ½² ٣", "x y z  ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_equals_the_library(library):
    random.seed(1)
    texts = ODD + ["".join(random.choice("abc de\n'st12é漢😀<|>.") for _ in range(random.randrange(300))) for _ in range(400)]
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    known = dict(vocabulary.special)
    for text, ids in zip(texts, vocabulary.encode(texts, known)):
        assert (ids, vocabulary.decode(ids)) == expected(library, text)


@pytest.mark.parametrize("kind", ["one letter", "letters", "base64", "digits"])
def test_long_pieces_take_time_in_proportion(library, kind):
    rng = random.Random(3)
    signs = {"one letter": "a", "letters": "etaoinshrdlu", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "digits": "0123456789"}[kind]
    text = "".join(rng.choices(signs, k=200_000))
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    began = time.process_time()
    (ids,) = vocabulary.encode([text], {})
    assert time.process_time() - began < 40
    part = text[:20_000]
    (short,) = vocabulary.encode([part], {})
    assert (short, vocabulary.decode(ids)) == (expected(library, part)[0], text)


def test_alone_equals_lockstep(library):
    rng = random.Random(8)
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    pieces = ["".join(rng.choices("abcdefgh", k=rng.choice([2, 3, 17, 900, 1500]))).encode() for _ in range(60)]
    assert [vocabulary._alone(p) for p in pieces] == vocabulary.encode_pieces(pieces)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    known = dict(vocabulary.special)
    for text in [*ODD, *ODD]:
        assert vocabulary.encode([text], known)[0] == expected(library, text)[0]


def test_rows(spark, library):
    rows = [(i, t, "k", 5) for i, t in enumerate([*ODD, None])] + [(None, "null key", "k", 5), (0, "", "k", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    found = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH).collect() if r.doc_id is not None)
    want = []
    for key, text, *_ in rows:
        if key is not None:
            ids, back = expected(library, text)
            want.append((key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert found == sorted(want)
    assert {r.decoded for r in bpe.encoded(docs, PATH).collect()} == {t or "" for _, t, *_ in rows}
    assert bpe.digests(docs.limit(0), PATH).count() == 0
