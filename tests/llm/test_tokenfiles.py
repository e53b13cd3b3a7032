"""Token files: the codec, the files, and the query's rows against the library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm import tokenfiles as T

FILE = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 70), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(2**60 - 1)), max_size=900))
def test_ids_come_back(ids):
    v = np.array(ids, np.uint64)
    words, offsets, escapes = T.pack(v)
    assert len(offsets) == -(-len(v) // T.BLOCK)
    assert len(escapes) == sum(i >= 2**60 - 1 for i in ids)
    assert (T.unpack(words, offsets, escapes, len(v)) == v).all()


def test_words_take_as_many_ids_as_fit():
    def plain(ids):
        words = 0
        for b in range(0, len(ids), T.BLOCK):
            own = ids[b : b + T.BLOCK]
            while own:
                words += 1
                own = own[next(c for c, bits in zip(T.COUNTS, T.BITS) if all(x < 1 << int(bits) for x in own[:c])) :]
        return words

    rng = random.Random(3)
    for _ in range(30):
        ids = [rng.randrange(1 << rng.choice([0, 1, 2, 5, 9, 16, 40])) for _ in range(rng.randrange(700))]
        assert len(T.pack(np.array(ids, np.uint64))[0]) == plain(ids)


def test_frames_come_back_and_cut_ones_fail():
    ids = [np.array(x, "<u4") for x in ([5, 1], [1], [70_000, 3, 2**32 - 1, 1])]
    data = T.frame_bytes(3, 0, 10, ["7", None, "nä"], ids) + T.END.encode()
    (frame,) = T.frames_of(data)
    assert frame[:3] == (3, 10, ["7", None, "nä"])
    assert frame[3].tolist() == [2, 1, 4] and frame[4].tolist() == np.concatenate(ids).tolist()
    with pytest.raises(ValueError):
        list(T.frames_of(data[:-3]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x260), st.sampled_from(" 'sdlrveß€ﬁ你́İΣς<|>\x1c\xa0½1²")), max_size=60), max_size=4))
def test_pieces_give_the_ids_of_the_library(texts):
    texts = [*texts, "it's <|endoftext|> I'll", "Ünïcode Straße 12½"]
    library = ENCODER.library
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ENCODER.encode(texts)] == expected


with open(FILE, encoding="utf-8") as _f:
    ENCODER = T.Encoder(_f.read())


def expected_rows(rows):
    """Rows of the query by plain Python: (doc_id, start, n_tokens, crc)."""
    library = Tokenizer.from_file(FILE)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, (_, t) in enumerate(rows)}
    out, start = [], 0
    for i in sorted(ids, key=lambda i: (rows[i][0] is not None, rows[i][0] or 0)):
        out.append((rows[i][0], start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())))
        start += len(ids[i])
    return out


@pytest.mark.parametrize("frame", [1 << 20, 50])
def test_rows_of_files(spark, monkeypatch, frame):
    monkeypatch.setattr(T, "FRAME", frame)
    rng = random.Random(1)
    words = ["Haus", "don't", "naïve", "x" * 40, "12", "…", "\n", "日本", "ΑΣ", "<|endoftext|>", "é"]
    rows = [(i * 3 - 100, " ".join(rng.choices(words, k=rng.randrange(40)))) for i in range(200)]
    rows += [(901, None), (902, ""), (903, "long " * 40_000), (904, "z" * 30_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    # Columns that bear the operator's own names are ignored.
    docs = docs.withColumns({c: F.lit(7) for c in ("key", "tie", "place", "kind", "value", "start", "part", "ids")})
    found = T.filed(docs, FILE, end_id=1)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected_rows(rows)


def test_null_and_repeated_keys(spark, rows):
    given_rows = [(None, "a b"), (None, "a b"), (None, None), (5, "c"), (5, "c"), (5, "d e f"), (-1, "")]
    found = rows(T.filed(spark.createDataFrame(given_rows, "doc_id int, text string"), FILE))
    assert sorted((r[0] is not None, r[0] or 0, r[2]) for r in found) == sorted((k is not None, k or 0, 1 + len((t or "").split())) for k, t in given_rows)
    by_start = sorted(found, key=lambda r: r[1])
    assert [r[0] for r in by_start] == [None, None, None, -1, 5, 5, 5]
    assert [r[1] for r in by_start] == np.cumsum([0, *[r[2] for r in by_start]])[:-1].tolist()


def test_parts_are_counted_on(spark):
    rows = [(f"k{i:03}", "one two three " * (i % 7)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    path = T.new_shared_path(spark, "parts")
    T.write_token_files(docs, FILE, path, part=1000)
    found = T.read_token_files(spark, path).orderBy("key").collect()
    assert [r["key"] for r in found] == [k for k, _ in rows]
    assert [r["start"] for r in found] == np.cumsum([0, *[r["n_tokens"] for r in found]])[:-1].tolist()
    assert [len(r["ids"]) // 4 for r in found] == [r["n_tokens"] for r in found] == [3 * (i % 7) + 1 for i in range(300)]
    assert spark.read.format("binaryFile").load(f"{path}/kind=ids").count() > 1


def test_empty_table(spark):
    found = T.filed(spark.createDataFrame([], "doc_id bigint, text string"), FILE)
    assert found.collect() == [] and found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
