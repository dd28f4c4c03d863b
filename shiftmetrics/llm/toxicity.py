"""Toxicity by weak supervision.

Many voters look at a text and say toxic, clean or nothing: shards of a mined
lexicon of words and word beginnings, how densely that lexicon is hit, fixed
lexicons, and patterns.  A generative label model estimates,
from how the voters agree with each other, how each votes on toxic and on
clean texts (expectation maximisation over the unseen label) and how strongly
pairs of voters are correlated beyond the label; correlated voters are counted
down accordingly.  Its posterior labels train a linear classifier over lexicon
entries and bins of their number and density; it alone scores texts.  (What the
fixed lexicons and patterns say is no feature of it: held out, that ranks worse.)

Fitting uses at most ``SAMPLE_PER_CLASS`` labelled training rows of each class
(``common.labelled_sample``): the lexicon is mined from their labels, the
prior and the last scaling of the scores come from them.  Scoring reads every
whole text in the tasks that hold it; nothing is shuffled.

Defined results: a null or empty text is scored by the bias alone; repeated
rows get equal scores; without labelled rows of both classes the fixed lexicons
alone vote, and the score of a text is that of their posterior.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shiftmetrics.llm.common import py_fold

SAMPLE_PER_CLASS = 1500
THRESHOLD = 0.7
#: Different surroundings in the sample's toxic rows that make an entry, and shards of the mined lexicon (a voter each).
LEAST_PLACES, LEXICON_SHARDS = 8, 8
#: Lengths of the word beginnings that may become entries (noted with a star).
BEGINNINGS = range(4, 9)
#: Limits of the bins of distinct words hit, and of the share of a text's words that are hit.
NUMBERS, DENSITIES = (1, 2, 3, 5, 8, 13), (1 / 1600, 1 / 800, 1 / 400, 1 / 200, 1 / 100, 1 / 50, 1 / 25)
#: Words whose entry a Python worker remembers.
CACHE_WORDS = 100_000

WORD = re.compile(r"[^\W\d_]+")

# Small hand-written lexicons, one voter each.
LEXICONS = {
    "insult": "idiot idiots moron morons imbecile stupid dumb fool fools loser losers clown jerk dimwit",
    "contempt": "worthless pathetic disgusting trash garbage scum filth vermin useless ugly repulsive vile",
    "hostile": "hate despise kill die destroy shut",
    "german": "idiot dumm dummkopf trottel abschaum ekelhaft wertlos versager müll erbärmlich",
    "spanish": "idiota estúpido imbécil basura escoria asqueroso inútil patético perdedor payaso",
    "french": "idiot stupide imbécile ordure déchet dégoûtant inutile pathétique perdant crétin",
}
PATTERNS = {
    "address": re.compile(r"\b(?:you|you're|your)\b(?:\W+\w+){0,3}?\W+(?:idiot|moron|loser|trash|scum|stupid|pathetic|worthless|disgusting|clown)\b", re.I),
    "shout": re.compile(r"\b(?:shut up|get lost|go away|drop dead)\b", re.I),
}


def entries_of(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


class Lexicon:
    """Mined entries; no entry begins another, so a word hits one at most."""

    def __init__(self, entries: list[str]):
        self.entries = frozenset(entries)
        self._memo: dict[str, str | None] = {}

    def __reduce__(self):
        return Lexicon, (sorted(self.entries),)

    def entry(self, word: str) -> str | None:
        memo = self._memo
        if word not in memo:
            if len(memo) >= CACHE_WORDS:
                memo.clear()
            memo[word] = next((e for e in entries_of(word) if e in self.entries), None)
        return memo[word]

    def look(self, text: str) -> "Look":
        words = WORD.findall(text.lower())
        distinct = set(words)
        hits = {w: e for w in distinct if (e := self.entry(w)) is not None}
        return Look(text, distinct, hits, len(hits) / len(words) if words else 0.0)


class Look(NamedTuple):
    """What a text shows: its words, those that hit the lexicon, and their share of all words."""

    text: str
    words: set[str]
    hits: dict[str, str]
    density: float

    def features(self) -> set[str]:
        """Names of the classifier's features that are present."""
        return {*self.hits.values(), *(f"number {n}" for n in NUMBERS if len(self.hits) >= n),
                *(f"density {i}" for i, d in enumerate(DENSITIES) if self.density >= d)}

    def fixed(self) -> set[str]:
        """Names of the fixed lexicons and patterns that the text hits (no entry holds a blank)."""
        return {*(f"lexicon {name}" for name, lexicon in _LEXICON_SETS.items() if not self.words.isdisjoint(lexicon)),
                *(f"pattern {name}" for name, p in PATTERNS.items() if p.search(self.text))}


def voters() -> list[str]:
    return [*(f"shard {i}" for i in range(LEXICON_SHARDS)), *(f"density {i}" for i in range(len(DENSITIES))),
            *LEXICONS, *PATTERNS, "no hit"]


def votes_of(look: Look) -> list[int]:
    """1 toxic, -1 clean, 0 none, of each of ``voters``."""
    shards = {zlib.crc32(e.encode()) % LEXICON_SHARDS for e in look.hits.values()}
    votes = [int(i in shards) for i in range(LEXICON_SHARDS)]
    votes += [1 if look.density >= d else -1 for d in DENSITIES]
    fixed = look.fixed()
    votes += [int(f"lexicon {name}" in fixed) for name in LEXICONS]
    votes += [int(f"pattern {name}" in fixed) for name in PATTERNS]
    return [*votes, 0 if look.hits else -1]


_LEXICON_SETS = {name: frozenset(x.split()) for name, x in LEXICONS.items()}


def hash_of(*words: str) -> int:
    return zlib.crc32("\0".join(words).encode("utf-8", "surrogatepass"))


def mine(sample: list[tuple[str, int]]) -> Lexicon:
    """Entries that toxic rows use far more often than clean rows, by rate among all words."""
    # Counted by distinct neighbours: what only copies of a few texts repeat is no entry.
    least = LEAST_PLACES
    often = Counter()
    for text, y in sample:
        if y:
            for w, n in Counter(WORD.findall(text.lower())).items():
                for e in entries_of(w):
                    often[e] += n
    often = {e for e, n in often.items() if n >= least}
    total, uses, places = Counter(), {0: Counter(), 1: Counter()}, {}
    for text, y in sample:
        words = WORD.findall(text.lower())
        total[y] += len(words)
        for w, n in Counter(words).items():
            for e in often.intersection(entries_of(w)):
                uses[y][e] += min(n, 3)
        if y:
            for before, w, after in zip(["", *words], words, [*words[1:], ""]):
                for e in often.intersection(entries_of(w)):
                    places.setdefault(e, set()).add(hash_of(before, after))
    worth = {}
    for e, where in places.items():
        if len(where) >= least:
            rate = np.log((uses[1][e] + 0.5) / (total[1] + 1)) - np.log((uses[0][e] + 0.5) / (total[0] + 1))
            if rate > np.log(8):
                worth[e] = float(rate * np.sqrt(len(where)))
    chosen: list[str] = []
    for e in sorted(worth, key=lambda e: (-worth[e], -len(e), e)):
        stem = e.rstrip("*")
        if not any(stem.startswith(c.rstrip("*")) or c.startswith(stem) for c in chosen):
            chosen.append(e)
    return Lexicon(chosen)


@dataclass
class LabelModel:
    """P(vote | label) of each voter, a weight against double counting, and the prior."""

    log_p: np.ndarray                          # [voter, label, vote + 1]
    weight: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        j = np.arange(votes.shape[1])
        ratio = self.log_p[j, 1, votes + 1] - self.log_p[j, 0, votes + 1]
        return _sigmoid(ratio @ self.weight + np.log(self.prior / (1 - self.prior)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_label_model(votes: np.ndarray, prior: float, start: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation maximisation from ``start`` (a first guess of P(toxic) of each row)."""
    n, m = votes.shape
    onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    q, weight = start.astype(float), np.ones(m)
    model = None
    for _ in range(rounds):
        log_p = np.empty((m, 2, 3))
        for y, share in ((0, 1 - q), (1, q)):
            counts = np.einsum("i,imv->mv", share, onehot) + 0.1
            log_p[:, y] = np.log(counts / counts.sum(axis=1, keepdims=True))
        # Correlation of what the label leaves unexplained; a voter that repeats others weighs less.
        p_one, p_no = np.exp(log_p[:, :, 2]), np.exp(log_p[:, :, 0])
        expected = np.outer(1 - q, p_one[:, 0] - p_no[:, 0]) + np.outer(q, p_one[:, 1] - p_no[:, 1])
        rest = votes - expected
        scale = np.sqrt((rest ** 2).mean(axis=0)) + 1e-6
        corr = np.clip((rest / scale).T @ (rest / scale) / n, 0, 1)
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + np.where(corr > 0.1, corr, 0).sum(axis=1))
        model = LabelModel(log_p, weight, prior)
        new = model.posterior(votes)
        if np.abs(new - q).max() < 1e-4:
            break
        q = new
    return model


@dataclass
class Classifier:
    lexicon: Lexicon
    weights: dict[str, float]
    bias: float

    def margin(self, features: set[str]) -> float:
        return self.bias + math.fsum(self.weights.get(x, 0.0) for x in features)

    def score(self, text: str | None) -> float:
        return float(_sigmoid(np.float64(self.margin(self.lexicon.look(text or "").features()))))


def fit_linear(lexicon: Lexicon, rows: list[set[str]], target: np.ndarray, rounds: int = 400, l2: float = 0.5) -> Classifier:
    """Logistic regression on the features' presence with soft targets, by Adam."""
    at = {f: i for i, f in enumerate(sorted(set().union(*rows)))}
    n = len(rows)
    x = np.zeros((n, len(at)), np.float32)
    for i, features in enumerate(rows):
        x[i, [at[f] for f in features]] = 1
    theta = np.zeros(len(at) + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        err = _sigmoid(x @ theta[:-1] + theta[-1]) - target
        grad = np.append(x.T @ err + l2 * theta[:-1], err.sum()) / n
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Classifier(lexicon, {f: float(theta[i]) for f, i in at.items()}, float(theta[-1]))


def fit(sample: list[tuple[str, int]]) -> Classifier:
    """The classifier from labelled rows (text, 0/1)."""
    y = np.array([y for _, y in sample])
    if len(set(y.tolist())) < 2:
        hits = sorted(_LEXICON_SETS["insult"] | _LEXICON_SETS["contempt"])
        return Classifier(Lexicon(hits), dict.fromkeys(hits, 2.0), -3.0)
    lexicon = mine(sample)
    looks = [lexicon.look(t) for t, _ in sample]
    votes = np.array([votes_of(x) for x in looks])
    # The first guess of the label: the share of the most telling density, and the fixed lexicons.
    start = np.clip(0.05 + 0.9 * (votes[:, :-1] == 1).mean(axis=1) * 2, 0.05, 0.95)
    model = fit_label_model(votes, float(np.clip(y.mean(), 0.02, 0.98)), start)
    features = [x.features() for x in looks]
    linear = fit_linear(lexicon, features, model.posterior(votes))
    # The scale and offset that fit the labels best, so that a score is a probability.
    a, b = _scale(np.array([linear.margin(f) for f in features]), y)
    return Classifier(lexicon, {f: a * w for f, w in linear.weights.items()}, a * linear.bias + b)


def _scale(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the labels' log odds in ``margin``: Newton's method with halved steps."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(w: np.ndarray) -> float:
        z = w[0] * margin + w[1]
        return float((np.logaddexp(0, z) - target * z).sum() + (w[0] - 1) ** 2)

    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(w[0] * margin + w[1])
        r = p * (1 - p) + 1e-6
        grad = np.array([((p - target) * margin).sum() + 2 * (w[0] - 1), (p - target).sum()])
        hess = np.array([[(r * margin ** 2).sum() + 2, (r * margin).sum()], [(r * margin).sum(), r.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def score(docs: DataFrame, model: Classifier, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, score, predicted) of every row."""
    key_type = docs.schema[key].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [model.score(t) for t in batch.column(1).to_pylist()]
            held = [py_fold(k, 3) == 1 for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(held, pa.bool_()), pa.array(s, pa.float64()),
                 pa.array([int(x >= THRESHOLD) for x in s], pa.int32())], [key, "held_out", "score", "predicted"])

    return docs.select(key, text_col).mapInArrow(
        scored, f"`{key}` {key_type}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays under the threshold."""
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(t) < THRESHOLD for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
