"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import steps, texts_of
from cohortloom.llm.labelled import (
    binned,
    features_of,
    learning_rows,
    learning_texts,
    quantile_edges,
    scored,
    sigmoid,
    verdicts,
)

#: Rows whose CRC-32 has this remainder are never learned from: (modulus, remainder).
HELD = (3, 1)
#: Most labelled rows that a model is fitted on.
SAMPLE = 40_000
#: Words that a task remembers; it forgets all and goes on beyond that.
REMEMBERED = 200_000
#: Words of insult that count without having been learned.
KNOWN = frozenset("idiot moron stupid loser scum trash worthless pathetic disgusting clown imbecile dumb".split())
SECOND_PERSON = frozenset(
    "you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
)
STEMS = (4, 5, 6)
# Signs that stand for letters.
_LEET = str.maketrans({"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"})
_EDGE = ".,;:!?\"'()[]{}«»¿¡-*#%&$"
_INNER = re.compile(r"[\W_]+")
_AGAIN = re.compile(r"(.)\1{2,}")
_MARKS = re.compile(r"[!?]{2,}")

FEATURES = [
    "log_words", "known_rate", "known_count", "known_kinds", "learned_rate", "learned_count", "learned_kinds",
    "learned_best", "learned_sum", "near_you", "you_rate", "capital_words", "capitals", "shouts", "questions",
    "mark_runs", "masked_rate", "spelled_rate", "stretched_rate", "masked_known", "peak",
]


def grams(word: str) -> list[str]:
    """What a word can match in the lexicon: itself and its stems."""
    return [f"={word}", *[word[:n] for n in STEMS if len(word) > n]]


def _facts(word: str, lexicon: dict[str, float]) -> tuple[float | None, int, int, int]:
    """Value of a word (NULL where it is no insult), whether it is masked or stretched, and whether
    what is behind that is a known insult."""
    best = max((lexicon.get(g, 0.0) for g in grams(word)), default=0.0)
    value = best if best or word in KNOWN else None
    if len(word) == 1:
        return value, 0, 0, 0
    plain = word.isalpha()
    if not plain and any(map(str.isalpha, word)):
        turned = _INNER.sub("", word.translate(_LEET))
        return value, 1, 0, int(turned in KNOWN or lexicon.get(f"={turned}", 0.0) > 0)
    if plain and (m := _AGAIN.sub(r"\1", word)) != word:
        return value, 0, 1, int(m in KNOWN)
    return value, 0, 0, 0


def _row(text: str, lexicon: dict[str, float], seen: dict[str, tuple] | None = None) -> list[float]:
    """Features of a text; ``seen`` remembers what is known of a word."""
    seen = {} if seen is None else seen
    raw = text.split()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    words = [w.strip(_EDGE).lower() for w in raw]
    value: dict[str, float] = {}
    kinds = set(words)
    masked = spelled = stretched = masked_known = 0
    for w in kinds:
        facts = seen.get(w)
        if facts is None:
            facts = seen[w] = _facts(w, lexicon)
        if facts[0] is not None:
            value[w] = facts[0]
        masked += facts[1]
        stretched += facts[2]
        masked_known += facts[3]
    hits = [i for i, w in enumerate(words) if w in value]
    known = [words[i] for i in hits if words[i] in KNOWN]
    learned = [words[i] for i in hits if value[words[i]] > 0]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if you and hits:
        at = np.array(you)
        place = np.searchsorted(at, hits)
        left = np.abs(at[np.maximum(place - 1, 0)] - hits)
        right = np.abs(at[np.minimum(place, len(at) - 1)] - hits)
        near = int((np.minimum(left, right) <= 5).sum())
    single = [len(w) == 1 and w.isalpha() for w in words]
    if any(single):
        run = ""
        for i, one in enumerate([*single, False]):
            if one:
                run += words[i]
            else:
                spelled += len(run) > 3
                masked_known += len(run) > 3 and any(k in run for k in KNOWN)
                run = ""
    peak = 0
    if hits:
        at = np.array(hits)
        peak = int((np.searchsorted(at, at + 20, side="right") - np.arange(len(at))).max())
    sums = sum(value[w] for w in learned)
    letters = sum(map(len, words)) or 1
    return [
        math.log1p(n), len(known) / n, math.log1p(len(known)), len(set(known)), len(learned) / n,
        math.log1p(len(learned)), len(set(learned)), max((value[w] for w in learned), default=0.0), math.log1p(sums),
        near / (len(hits) or 1), len(you) / n, sum(w.isupper() and len(w) > 1 for w in raw) / n,
        sum(map(str.isupper, text)) / letters, text.count("!") / n, text.count("?") / n,
        len(_MARKS.findall(text)) / n, masked / len(kinds), spelled / n, stretched / len(kinds), masked_known, peak,
    ]


def extractor(lexicon: dict[str, float]):
    """Features of whole UTF-8 texts with a learned lexicon."""
    seen: dict[str, tuple] = {}

    def extract(texts: list[bytes]) -> np.ndarray:
        if len(seen) > REMEMBERED:
            seen.clear()
        rows = [_row(t.decode("utf-8", "replace"), lexicon, seen) for t in texts]
        return np.array(rows, np.float64).reshape(len(texts), len(FEATURES))

    return extract


def learned_lexicon(texts: DataFrame) -> dict[str, float]:
    """Words and stems with their log odds, from the labelled texts: all that a toxic document
    holds at least ten times as often as another, and that enough toxic documents hold. Their
    number is bounded by that of the labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(tally[0].keys() | tally[1].keys())
            columns = [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in tally]]
            for c in tally:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["gram", "clean", "toxic"])

        for batch in steps(batches):
            for text, label in zip(texts_of(batch), batch.column("label").to_pylist()):
                words = {w.strip(_EDGE).lower() for w in text.decode("utf-8", "replace").split()}
                tally[label].update({g for w in words if w for g in grams(w)})
            if len(tally[0]) + len(tally[1]) > 300_000:
                yield out()
        yield out()

    total = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    clean, toxic = total.get(0, 0), total.get(1, 0)
    if not clean or not toxic:
        return {}
    counted = texts.mapInArrow(count, "gram string, clean bigint, toxic bigint").groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log(((F.col("toxic") + 0.1) / (toxic + 1)) / ((F.col("clean") + 0.1) / (clean + 1)))
    enough = max(3, toxic // 250)
    found = (
        counted.filter(F.col("toxic") >= enough)
        .withColumn("odds", odds)
        .filter(F.col("odds") >= math.log(10))
    )
    return {r["gram"]: r["odds"] for r in found.select("gram", "odds").collect()}


@dataclass
class Trees:
    """Boosted trees of fixed depth: for each, the features and bins compared, and leaf values."""

    bias: float
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        at = binned(x, self.edges)
        z = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(math.log2(len(leaf)))):
                node = 2 * node + 1 + (at[rows, feature[node]] > cut[node])
            z += leaf[node - len(feature)]
        return z


def fit_trees(x: np.ndarray, y: np.ndarray, *, rounds: int = 80, rate: float = 0.15, depth: int = 3, bins: int = 32) -> Trees:
    """Second-order boosting of the log loss; each tree is grown level by level from histograms."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    edges = quantile_edges(x, bins) if len(x) else [np.empty(0)] * x.shape[1]
    # Most rows may hold no insult at all: where a feature starts is a place to cut.
    edges = [np.unique(np.append(e, 0.0)) for e in edges]
    at = binned(x, edges) if len(x) else np.empty(x.shape, np.int64)
    width, most = x.shape[1], max(len(e) for e in edges) + 1
    z = np.full(len(y), bias)
    features, cuts, values = [], [], []
    for _ in range(rounds if 0 < y.sum() < len(y) else 0):
        p = sigmoid(z)
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, most)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            a, b = np.empty((width, n, most)), np.empty((width, n, most))
            for f in range(width):
                cell = (node - first) * most + at[:, f]
                a[f] = np.bincount(cell, g, n * most).reshape(n, most)
                b[f] = np.bincount(cell, h, n * most).reshape(n, most)
            left_a, left_b = np.cumsum(a, axis=2), np.cumsum(b, axis=2)
            all_a, all_b = left_a[:, :, -1:], left_b[:, :, -1:]
            gain = left_a**2 / (left_b + 1) + (all_a - left_a) ** 2 / (all_b - left_b + 1) - all_a**2 / (all_b + 1)
            gain[(left_b < 0.3) | (all_b - left_b < 0.3)] = 0
            flat = gain.transpose(1, 0, 2).reshape(n, -1)
            best = flat.argmax(axis=1)
            some = flat[np.arange(n), best] > 1e-9
            feature[first : first + n] = np.where(some, best // most, 0)
            cut[first : first + n] = np.where(some, best % most, most)
            node = 2 * node + 1 + (at[np.arange(len(y)), feature[node]] > cut[node])
        own = node - inner
        leaf = rate * np.bincount(own, g, leaves) / (np.bincount(own, h, leaves) + 1)
        z += leaf[own]
        features.append(feature)
        cuts.append(cut)
        values.append(leaf)
    return Trees(bias, edges, np.array(features).reshape(-1, inner), np.array(cuts).reshape(-1, inner), np.array(values).reshape(-1, leaves))


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits and rising shares of label 1, by pooling neighbours that fall; ends are smoothed."""
    order = np.argsort(z, kind="stable")
    pools: list[list[float]] = []
    for score, label in zip(z[order].tolist(), y[order].tolist()):
        pools.append([label, 1.0, score, score])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], last]
    places, shares = [], []
    for s, n, first, last in pools:
        places += [first, last + 1e-9]
        shares += [(s + 0.5) / (n + 1)] * 2
    return np.array(places), np.maximum.accumulate(np.array(shares))


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Trees
    places: np.ndarray
    shares: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        z = self.trees.logits(extractor(self.lexicon)(texts))
        return np.interp(z, self.places, self.shares) if len(self.places) else sigmoid(z)


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> ToxicityModel:
    """Lexicon, trees and calibration from at most ``bound`` labelled rows that are not held out.

    The calibration sees logits of a third of these rows, by a hash of their text, from a lexicon
    and trees that were learned from the other two thirds.
    """
    texts = learning_texts(docs, learning_rows(labels, "toxic", HELD, bound))
    lexicon = learned_lexicon(texts)
    trees = fit_trees(*features_of(texts, extractor(lexicon), len(FEATURES)))
    apart = F.pmod(F.xxhash64("text"), F.lit(3)) == 0
    others = texts.filter(~apart)
    before = learned_lexicon(others)
    x, y = features_of(texts.filter(apart), extractor(before), len(FEATURES))
    if not 0 < y.sum() < len(y):
        return ToxicityModel(lexicon, trees, np.empty(0), np.empty(0))
    z = fit_trees(*features_of(others, extractor(before), len(FEATURES))).logits(x)
    return ToxicityModel(lexicon, trees, *isotonic(z, y))


def classify(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row.

    NULL texts count as empty; repeated rows and NULL keys give a row each (a NULL key is held
    out); columns other than the key and the text are not read. Equal texts have equal scores.
    """
    return verdicts(scored(docs, learn(docs, labels, bound).score), HELD)
