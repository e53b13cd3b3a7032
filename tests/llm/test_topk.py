import math
import random

import pytest

from cohortloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, id string, v int, score long"


def brute(rows, k):
    sound = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in sound:
        if q % 5 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q)
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def found(spark, rows, k):
    df = spark.createDataFrame([(i, v, "x", 1, 1) for i, v in rows], SCHEMA)
    return {tuple(r) for r in topk.top_k(df, df.filter("vec_id % 5 = 0"), k).collect()}


@pytest.mark.parametrize("n, width", [(400, 12), (7, 3), (60, 1)])
def test_against_brute_force(spark, monkeypatch, n, width):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rng = random.Random(n)
    rows = [(i, [rng.randrange(-128, 128) / 64 for _ in range(width)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(30)] if n > 50 else []
    rows += [(1000, None), (1001, [None] * width), (1002, [float("nan")] * width), (1005, [float("inf")] * width), (None, [0.5] * width)]
    assert found(spark, rows, 5) == brute(rows, 5)


def test_odd_tables(spark):
    assert found(spark, [], 3) == set()
    assert found(spark, [(0, [1.0])], 3) == set()
    far = [(i, [-1.0 - i, -2.0]) for i in range(1, 12)] + [(0, [3.0, 1.0]), (5, [])]
    rows = [r for r in far if r[1]]
    assert found(spark, rows, 4) == brute(rows, 4)
    large = [(i, [2.0**21 + i, 2.0**21 - 3 * i]) for i in range(8)]
    assert found(spark, large, 3) == brute(large, 3)


def test_repeated_queries_ask_with_their_least_vector(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-64, 64) / 64 for _ in range(3)]) for i in range(40)]
    rows += [(10, [rng.randrange(-64, 64) / 64 for _ in range(3)]) for _ in range(6)]
    asked = min([math.floor(64 * x) for x in v] for i, v in rows if i == 10)
    scored = sorted((-sum(x * math.floor(64 * y) for x, y in zip(asked, v)), i) for i, v in rows if i != 10)
    for _ in range(2):
        rng.shuffle(rows)
        got = sorted(r[1:] for r in found(spark, rows, 4) if r[0] == 10)
        assert got == [(n, i, -s) for n, (s, i) in enumerate(scored[:4], 1)]


def test_pairs_of_blocks_meet_in_every_partition(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rng = random.Random(11)
    rows = [(i, [rng.randrange(-128, 128) / 64 for _ in range(8)]) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, 5) == brute(rows, 5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
