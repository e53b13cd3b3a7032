"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame

from cohortloom.llm.labelled import (
    PREDICT_AT,
    binned,
    features_of,
    kept_rows,
    learning_rows,
    learning_texts,
    quantile_edges,
    scored,
    sigmoid,
    verdicts,
)

#: Rows whose CRC-32 has this remainder are never learned from: (modulus, remainder).
HELD = (4, 2)
#: Most labelled rows that a model is fitted on.
SAMPLE = 20_000

UPPER, DIGIT, BLANK, STOP, SHOUT, BAR, SYMBOL, HIGH = range(1, 9)
_CLASS = np.zeros(256, np.uint8)
for _chars, _kind in (
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
    (b"0123456789", DIGIT),
    (b" \t\r\n\x0b\x0c", BLANK),
    (b".,;:?'\"()-", STOP),
    (b"!", SHOUT),
    (b"|", BAR),
    (b"#$%&*+/<=>@[\\]^_`{}~", SYMBOL),
):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _kind
_CLASS[128:] = HIGH

#: Bytes and words of the windows whose extremes are features.
WINDOW, WORDS = 400, 60
FEATURES = [
    "log_bytes", "log_words", "upper", "digit", "blank", "stop", "shout", "bar", "symbol", "high",
    "upper_window", "shout_window", "bar_window", "symbol_window",
    "distinct", "top_word", "same_as_last", "longest_run", "distinct_fives", "distinct_window",
    "word_length", "longest_word", "lines", "distinct_lines", "words_per_stop", "marked_words",
]


def _starts(n: int, width: int) -> np.ndarray:
    """First places of windows that overlap by half; the last one ends with the text."""
    return np.append(np.arange(0, n - width, width // 2), n - width)


def _row(text: bytes) -> list[float]:
    n = len(text)
    words = text.split()
    m = len(words)
    if not m:
        return [float(np.log1p(n))] + [0.0] * (len(FEATURES) - 1)
    kinds = _CLASS[np.frombuffer(text, np.uint8)]
    share = np.bincount(kinds, minlength=9) / n
    peaks = [float(share[k]) for k in (UPPER, SHOUT, BAR, SYMBOL)]
    if n > WINDOW:
        at = _starts(n, WINDOW)
        for i, k in enumerate((UPPER, SHOUT, BAR, SYMBOL)):
            up_to = np.concatenate(([0], np.cumsum(kinds == k)))
            peaks[i] = float((up_to[at + WINDOW] - up_to[at]).max() / WINDOW)
    h = np.fromiter(map(hash, words), np.int64, m)  # only ever compared within this text
    counts = np.unique(h, return_counts=True)[1]
    same = h[1:] == h[:-1]
    breaks = np.flatnonzero(np.concatenate(([True], ~same, [True])))
    fives = 1.0
    if m >= 10:
        with np.errstate(over="ignore"):
            mixed = h[:-4] * 3 + h[1:-3] * 5 + h[2:-2] * 7 + h[3:-1] * 11 + h[4:] * 13
        fives = len(np.unique(mixed)) / len(mixed)
    least = len(counts) / m
    if m > WORDS:
        rows = np.sort(np.lib.stride_tricks.sliding_window_view(h, WORDS)[_starts(m, WORDS)], axis=1)
        least = float(((rows[:, 1:] != rows[:, :-1]).sum(axis=1) + 1).min() / WORDS)
    lengths = np.fromiter(map(len, words), np.int64, m)
    lines = text.split(b"\n")
    ends = np.frombuffer(text, np.uint8)[np.flatnonzero((kinds[:-1] != BLANK) & (kinds[1:] == BLANK))]
    marked = np.isin(_CLASS[ends], (SHOUT, BAR, SYMBOL)).mean() if len(ends) else 0.0
    return [
        float(np.log1p(n)), float(np.log1p(m)), *share[1:].tolist(), *peaks,
        len(counts) / m, float(counts.max() / m), float(same.mean()) if m > 1 else 0.0,
        float(np.log1p(np.diff(breaks).max())), fives, least,
        float(lengths.mean()), float(np.log1p(lengths.max())), float(np.log1p(len(lines))),
        len(set(lines)) / len(lines), m / (1 + text.count(b".")), float(marked),
    ]


def extract(texts: list[bytes]) -> np.ndarray:
    """A row of ``FEATURES`` for each whole UTF-8 text."""
    return np.array([_row(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class AdditiveModel:
    """Bias, a lookup table for each feature, and one for each chosen pair of features."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        at = binned(x, self.edges)
        for i, t in enumerate(self.tables):
            z += t[at[:, i]]
        at = binned(x, self.coarse)
        for (i, j), t in zip(self.pairs, self.pair_tables):
            z += t[at[:, i], at[:, j]]
        return z

    def score(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.logits(extract(texts)))


def _cut(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int]:
    """Best gain and place of a cut of bins with gradient and curvature sums."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(a):
        return 0.0, 0
    c, d = g.sum() - a, h.sum() - b
    gain = a * a / (b + 1) + c * c / (d + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(b < least) | (d < least)] = 0
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _shallow(g: np.ndarray, h: np.ndarray, least: float, leaves: int = 4) -> np.ndarray:
    """Values by bin of a tree with few leaves on one feature, grown best cut first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*_cut(g[s:e], h[s:e], least), s, e) for s, e in parts]
        gain, k, s, e = max(found)
        if gain <= 1e-9:
            break
        parts.remove((s, e))
        parts += [(s, s + k), (s + k, e)]
    out = np.zeros(len(g))
    for s, e in parts:
        out[s:e] = g[s:e].sum() / (h[s:e].sum() + 1)
    return out


def _crossed(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """Values and gain of a tree of depth two on a pair: a cut of the first, then one on each side."""
    best, gain = np.zeros(g.shape), 0.0
    whole = g.sum() ** 2 / (h.sum() + 1)
    for k in range(1, g.shape[0]):
        out, own = np.zeros(g.shape), -whole
        for side in (slice(None, k), slice(k, None)):
            a, b = g[side].sum(axis=0), h[side].sum(axis=0)
            _, at = _cut(a, b, least)
            for part in (slice(None, at), slice(at, None)):
                p, q = a[part].sum(), b[part].sum()
                out[side, part] = p / (q + 1)
                own += p * p / (q + 1)
        if own > gain:
            best, gain = out, own
    return best, gain


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 120, rate: float = 0.15, bins: int = 48, pairs: int = 8) -> AdditiveModel:
    """Cyclic boosting: each round updates the table of every feature in turn, then pairs likewise.

    Without rows, or with one label only, the model is the smoothed share of that label.
    """
    width = len(FEATURES)
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        none = [np.empty(0)] * width
        return AdditiveModel(bias, none, [np.zeros(1)] * width, none, [], [])
    edges, coarse = quantile_edges(x, bins), quantile_edges(x, 8)
    least = max(1.0, len(y) / 2000)
    z, tables = np.full(len(y), bias), [np.zeros(len(e) + 1) for e in edges]
    at = binned(x, edges)
    for _ in range(rounds):
        for i, t in enumerate(tables):
            p = sigmoid(z)
            g = np.bincount(at[:, i], y - p, len(t))
            h = np.bincount(at[:, i], p * (1 - p), len(t))
            step = rate * _shallow(g, h, least * 0.05)
            t += step
            z += step[at[:, i]]
    at = binned(x, coarse)

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p, shape = sigmoid(z), (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = at[:, i] * shape[1] + at[:, j]
        n = shape[0] * shape[1]
        return np.bincount(cell, y - p, n).reshape(shape), np.bincount(cell, p * (1 - p), n).reshape(shape)

    gains = sorted(((_crossed(*sums(i, j), least * 0.05)[1], i, j) for i, j in combinations(range(width), 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in gains[:pairs] if gain > 0]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]
    for _ in range(rounds // 4):
        for (i, j), t in zip(chosen, pair_tables):
            step = rate * _crossed(*sums(i, j), least * 0.05)[0]
            t += step
            z += step[at[:, i], at[:, j]]
    return AdditiveModel(bias, edges, tables, coarse, chosen, pair_tables)


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> AdditiveModel:
    """Fit on the texts of at most ``bound`` labelled rows that are not held out."""
    texts = learning_texts(docs, learning_rows(labels, "quality", HELD, bound))
    return fit(*features_of(texts, extract, len(FEATURES)))


def classify(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row.

    NULL texts count as empty; repeated rows and NULL keys give a row each (a NULL key is held
    out); columns other than the key and the text are not read. Equal texts have equal scores.
    """
    return verdicts(scored(docs, learn(docs, labels, bound).score), HELD)


def keep_good(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are predicted good, columns as they are."""
    return kept_rows(docs, learn(docs, labels, bound).score, PREDICT_AT)
