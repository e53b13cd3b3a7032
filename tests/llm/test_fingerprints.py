"""Fingerprints and their likeness against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from cohortloom.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, n int, t string, sketch int"


def signed(h, bits=64):
    return h - (1 << bits) if h >> (bits - 1) else h


def hashed(*parts):
    """Spark's hash of strings and longs, each seeded by the one before."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def units(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [u for w in words for u in ([w] if len(w) <= fp.LONG else [w[i : i + fp.GRAM] for i in range(len(w) - fp.GRAM + 1)])]


def anchored(text):
    """Anchors by place, None where a k-mer is not chosen."""
    own = units(text)
    if len(own) < 4:
        return [hashed(" ".join(own)) >> 32] if own else []
    inner = [hashed(a, b) for a, b in zip(own, own[1:])]
    return [hashed(inner[i], inner[i + 2]) >> 32 if min(inner[i], inner[i + 2]) <= inner[i + 1] else None for i in range(len(own) - 3)]


def told(anchors):
    return "".join("-" if a is None else f"{a & 0xFFFFFFFF:08x}" for a in anchors)


def read(fingerprint):
    """Anchors and places back from the text of a fingerprint."""
    return [None if x == "-" else x for x in re.findall("-|[0-9a-f]{8}", fingerprint)]


def likeness(a, b):
    first_a, first_b = ({x: i for i, x in reversed([*enumerate(s)]) if x is not None} for s in (a, b))
    if not first_a and not first_b:
        return 1.0
    width = max(8, max(len(a), len(b)) // 16)
    offsets = [first_b[x] - first_a[x] for x in first_a.keys() & first_b.keys()]
    matched = max((n for shift in (0, width // 2) for n in Counter((o + shift) // width for o in offsets).values()), default=0)
    return matched / (len(first_a) + len(first_b) - matched)


def edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[key] = (text, text[: len(text) - half] + following[:half], following)
    return out


def found(spark, rows):
    return fp.compared(spark.createDataFrame([(k, t, 1, "x", 2) for k, t in rows], SCHEMA)).collect()


def prose(n, step=7):
    return " ".join(f"w{(i * step) % 101}é" for i in range(n))


def test_rows_against_plain_python(spark):
    rng = random.Random(2)
    rows = [(i * 3, prose(5 + 13 * i % 90, i + 1)) for i in range(40)] + [(4, None), (5, ""), (8, "😀é" * 50), (200, "one"), (None, "null key here now")]
    rows += [(300 + i, " ".join(rng.choices(["a", "b", "cd", " ", "x" * 30, "ü" * 25], k=rng.randrange(80)))) for i in range(40)]
    want = edited(rows)
    got = found(spark, rows)
    assert len(got) == len(rows)
    for r in got:
        own, changed, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (told(anchored(own)), told(anchored(changed)))
        assert r.near_edited == pytest.approx(likeness(anchored(own), anchored(changed)))
        assert r.near_edited == pytest.approx(likeness(read(r.fingerprint), read(r.edited_fingerprint)))
        assert r.near_next == pytest.approx(likeness(anchored(own), anchored(following)))


def test_likeness_orders_texts(spark):
    a, b = prose(400, 7), " ".join(f"other{i}" for i in range(500))
    one, two, three = sorted(found(spark, [(1, a), (2, b), (3, a)]), key=lambda r: r.doc_id)
    assert one.fingerprint == three.fingerprint and three.near_next == 1.0
    assert one.near_next == 0.0 and 0.2 < one.near_edited < 0.6


def test_places_count(spark):
    words = [f"v{i}" for i in range(600)]
    swapped = " ".join(words[300:] + words[:300])
    inserted = " ".join(words[:200] + ["new", "words", "here"] + words[200:])
    one, two, _ = sorted(found(spark, [(1, " ".join(words)), (2, swapped), (3, swapped)]), key=lambda r: r.doc_id)
    assert one.near_next < 0.4 and two.near_next == 1.0
    one, _ = sorted(found(spark, [(1, " ".join(words)), (2, inserted)]), key=lambda r: r.doc_id)
    assert one.near_next > 0.95


def test_texts_without_blanks(spark):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefghij", k=800))
    changed = long[:400] + "Z" + long[401:]
    other = "".join(rng.choices("abcdefghij", k=800))
    one, two, _ = sorted(found(spark, [(1, long), (2, changed), (3, other)]), key=lambda r: r.doc_id)
    assert one.near_next > 0.9 and two.near_next < 0.05


def test_very_long_texts(spark):
    rng = random.Random(5)
    words = [str(rng.randrange(10**6)) for _ in range(150_000)]
    one, two = sorted(found(spark, [(1, " ".join(words)), (2, "x" * 300_000)]), key=lambda r: r.doc_id)
    assert one.n_chars == len(" ".join(words)) and one.fingerprint == told(anchored(" ".join(words)))
    assert two.near_next == 0.0 and len(set(read(two.fingerprint))) <= 2


def test_small_tables_and_repeats(spark):
    assert found(spark, []) == []
    only = found(spark, [(1, "a b c d e f")])
    assert len(only) == 1 and only[0].near_next == 1.0
    again = found(spark, [(1, "a b c d"), (1, "a b c d"), (1, "x"), (2, None), (2, None)])
    assert len(again) == 5 and len({tuple(r) for r in again}) == 3


def test_closed_syncmers_depend_on_the_kmer_alone(spark):
    words = prose(200).split()
    rows = [(" ".join(words),), ("before " + " ".join(words),), (" ".join(words[50:120]),)]
    whole, shifted, part = (set(r.a) - {None} for r in fp.anchors(spark.createDataFrame(rows, "text string"), "text", "a").collect())
    assert whole <= shifted and part <= whole and part


def test_no_python_in_the_plan(spark):
    df = fp.compared(spark.createDataFrame([(1, "a b", 1, "x", 2)], SCHEMA))
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
