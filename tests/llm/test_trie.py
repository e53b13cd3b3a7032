"""List ranking and the conversation trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import listrank, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("n, block", [(1, 5), (40, 1000), (700, 60)])
def test_sums_along_a_list(spark, shuffled, n, block):
    rng = random.Random(n)
    order = [3 * i + 1 for i in range(n)]
    if shuffled:  # hardly any neighbours in one range: coins have to shorten the list
        rng.shuffle(order)
    weight = {e: rng.randrange(100) for e in order}
    rows = [(e, f, 1, weight[e]) for e, f in zip(order, [*order[1:], None])]
    rng.shuffle(rows)
    links = spark.createDataFrame(rows, "element bigint, next bigint, one bigint, w bigint").repartition(3)
    found = {r["element"]: (r["one"], r["w"]) for r in listrank.list_ranks(links, ["one", "w"], block).collect()}
    expected, total = {}, 0
    for i, e in enumerate(order):
        expected[e] = (i, total)
        total += weight[e]
    assert found == expected


def test_cycle_is_an_error(spark):
    links = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1)], "element bigint, next bigint, w bigint")
    with pytest.raises(Exception, match="cycle"):
        listrank.list_ranks(links, ["w"]).collect()


def test_no_elements(spark):
    assert listrank.list_ranks(spark.createDataFrame([], "element bigint, next bigint, w bigint"), ["w"]).collect() == []


def brute_force(rows):
    """Nodes of the trie of rebuilt conversations by dictionaries and a walk."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])
        built = (*base[:h], *turns[h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        parts = [below(k) for k in children[p]]
        return sum(x for x, _ in parts) + (not parts), saved + sum(y for _, y in parts)

    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *below(p),
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


def found(spark, rows):
    docs = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(3)
    # Columns that bear the operator's own names are ignored.
    docs = docs.withColumns({n: F.lit("x") for n in ("conv", "p", "part", "at", "place", "d1", "depth", "node", "element", "next")})
    df = trie.rebuilt_trie(docs)
    nodes = df.collect()
    assert sorted(r["rank"] for r in nodes) == sorted({r["rank"] for r in nodes})
    return sorted(tuple(r[c] for c in COLUMNS) for r in nodes)


@pytest.mark.parametrize("small", [False, True])
def test_nodes(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(trie, "RANGE", 20)
        monkeypatch.setattr(trie, "CHUNK", 6)
        monkeypatch.setattr(listrank.list_ranks, "__defaults__", (25,))
    rng = random.Random(7)
    rows = []
    for c in rng.sample(range(-30, 300), 120):
        n = rng.choice([1, 2, 3, 9, 12])
        turns = [(c, rng.choice([None, i, i, i]), rng.choice(["user", "bot", None]), rng.choice(["a", "b", "ä€", "", None])) for i in range(n)]
        rows += turns
    rows += [(c, i, "user", "same") for c in range(400, 460) for i in range(3)]  # one sequence many times
    rows += rows[:20] + [(None, 1, "user", "lost"), (None, None, None, None)]
    rng.shuffle(rows)
    assert found(spark, rows) == brute_force(rows)


def test_long_conversation_with_equal_turns(spark, monkeypatch):
    monkeypatch.setattr(trie, "RANGE", 50)
    rows = [(5, None, "user", "again")] * 300 + [(5, i, "user", "x" * (i % 3)) for i in range(200)] + [(7, 1, "user", "again"), (10, 3, None, "y" * 100_000)]
    assert found(spark, rows) == brute_force(rows)


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 == 3)
    rows = [(c, 1, "user", "a"), (c, 2, "user", "b")]
    assert found(spark, rows) == brute_force(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []
