"""Quality: a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad from features of its own and of the lines
beside it, and from the labels beside it; forward-backward gives each line's
probability of being bad.  Their mean, weighted by line length, and their
maximum give the document's quality.

Labels exist for documents only.  Training starts from each line having its
document's label, then relabels the lines of bad documents by the model's own
marginals (at least one line stays bad) and fits again.  Fitting uses at most
``SAMPLE_PER_CLASS`` labelled training rows of each class
(``common.labelled_sample``); scoring reads every whole text in the tasks that
hold it, and nothing is shuffled.

Defined results: a null or empty text has no lines and gets the share of good
documents in the sample as its score; without labelled rows of both classes
every score is 0.5; repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shiftmetrics.llm.common import py_fold

SAMPLE_PER_CLASS = 1500
BINS = 6
_L2, _RATE, _STEPS = 1.0, 0.15, 80

_UPPER, _LOWER, _DIGIT = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_PLAIN = b".,;:'\"?!()-"
_SYMBOL = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in _PLAIN)
_SPACE = b" \t\r\x0b\x0c"

FEATURES = ("log bytes", "log words", "upper", "digits", "symbols", "symbols a word", "plain marks a word",
            "exclamations a word", "distinct words", "words like the one before", "bytes a word", "seen before")


def line_features(text: str) -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and byte lengths of a text's lines (lines of blanks are left out)."""
    rows, sizes, seen = [], [], set()
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        if not words:
            continue
        n, nw = len(line), len(words)
        upper = n - len(line.translate(None, _UPPER))
        lower = n - len(line.translate(None, _LOWER))
        digits = n - len(line.translate(None, _DIGIT))
        symbols = n - len(line.translate(None, _SYMBOL))
        plain = n - len(line.translate(None, _PLAIN))
        same = sum(map(eq, words, islice(words, 1, None)))
        rows.append((np.log1p(n), np.log1p(nw), upper / (upper + lower + 1), digits / n, symbols / n, symbols / nw,
                     plain / nw, line.count(b"!") / nw, len(set(words)) / nw, same / nw, n / nw, float(line in seen)))
        sizes.append(n)
        seen.add(line)
    return rows, sizes


@dataclass
class Chains:
    """Lines of several documents, one document after another."""

    bins: np.ndarray                           # [line, feature]
    size: np.ndarray                           # bytes of a line
    count: np.ndarray                          # lines of a document

    def __post_init__(self):
        self.first = np.concatenate([[0], np.cumsum(self.count)[:-1]]).astype(np.int64)
        at = np.arange(len(self.bins))
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.is_first = at == self.first[self.doc] if len(at) else np.zeros(0, bool)
        self.is_last = at == (self.first + self.count - 1)[self.doc] if len(at) else np.zeros(0, bool)


@dataclass
class Model:
    edges: np.ndarray                          # [feature, BINS - 1] limits of the bins
    own: np.ndarray                            # [feature, bin] weights for "bad"
    before: np.ndarray
    after: np.ndarray
    start: np.ndarray                          # [label]
    step: np.ndarray                           # [label, next label]
    final: np.ndarray                          # bias, weights of the mean and maximum of the marginals
    prior: float                               # share of good documents

    def chains(self, texts: list[str | None]) -> Chains:
        rows, sizes, count = [], [], []
        for t in texts:
            r, s = line_features(t or "")
            rows += r
            sizes += s
            count.append(len(r))
        x = np.array(rows, float).reshape(-1, len(FEATURES))
        bins = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)
        return Chains(bins, np.array(sizes, float), np.array(count, np.int64))

    def unary(self, c: Chains) -> np.ndarray:
        f = np.arange(len(FEATURES))
        total = self.own[f, c.bins].sum(axis=1)
        total[1:] += np.where(c.is_first[1:], 0, self.before[f, c.bins[:-1]].sum(axis=1))
        total[:-1] += np.where(c.is_last[:-1], 0, self.after[f, c.bins[1:]].sum(axis=1))
        return total

    def marginals(self, c: Chains) -> tuple[np.ndarray, np.ndarray]:
        """P(bad) of each line; expected transitions [label, next label] over all lines."""
        u = np.zeros((len(c.bins), 2))
        u[:, 1] = self.unary(c)
        alpha, beta = np.empty_like(u), np.zeros_like(u)
        order = np.argsort(-c.count, kind="stable")
        first, count = c.first[order], c.count[order]
        longest = int(count[0]) if len(count) else 0
        alive = np.searchsorted(-count, -np.arange(longest), side="left")
        for t in range(longest):
            i = first[:alive[t]] + t
            if t == 0:
                alpha[i] = self.start + u[i]
            else:
                p = alpha[i - 1]
                alpha[i] = np.logaddexp(p[:, :1] + self.step[0], p[:, 1:] + self.step[1]) + u[i]
        for t in range(longest - 2, -1, -1):
            i = first[:alive[t + 1]] + t
            ahead = u[i + 1] + beta[i + 1]
            beta[i] = np.logaddexp(self.step[:, 0] + ahead[:, :1], self.step[:, 1] + ahead[:, 1:])
        last = (c.first + c.count - 1)[c.doc]
        log_z = np.logaddexp(alpha[last, 0], alpha[last, 1]) if len(u) else np.zeros(0)
        bad = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - log_z, 0))
        inner = np.flatnonzero(~c.is_first)
        pairs = np.array([[np.exp(alpha[inner - 1, a] + self.step[a, b] + u[inner, b] + beta[inner, b] - log_z[inner]).sum()
                           for b in (0, 1)] for a in (0, 1)])
        return bad, pairs

    def features(self, c: Chains, bad: np.ndarray) -> np.ndarray:
        """[document, (1, logit of the length-weighted mean, maximum)]"""
        n = len(c.count)
        mean = np.bincount(c.doc, bad * c.size, n) / np.maximum(np.bincount(c.doc, c.size, n), 1)
        most = np.zeros(n)
        np.maximum.at(most, c.doc, bad)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.stack([np.ones(n), np.log(mean / (1 - mean)), most], axis=1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        c = self.chains(texts)
        bad, _ = self.marginals(c)
        return np.where(c.count == 0, self.prior, _sigmoid(self.features(c, bad) @ self.final))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(sample: list[tuple[str, int]], rounds: int = 3) -> Model:
    """The model from labelled rows (text, 1 good / 0 bad)."""
    y = np.array([label for _, label in sample])
    shape = (len(FEATURES), BINS)
    model = Model(np.zeros((len(FEATURES), BINS - 1)), np.zeros(shape), np.zeros(shape), np.zeros(shape),
                  np.zeros(2), np.zeros((2, 2)), np.zeros(3), 0.5)
    if len(set(y.tolist())) < 2:
        return model
    model.prior = float(y.mean())
    x = np.array([r for t, _ in sample for r in line_features(t)[0]], float).reshape(-1, len(FEATURES))
    if not len(x):
        return model
    # Limits: quantiles of what exceeds the most common value, so that rare features get bins too.
    for f in range(len(FEATURES)):
        values, times = np.unique(x[:, f], return_counts=True)
        rare = x[x[:, f] != values[times.argmax()], f] if times.max() > len(x) / 2 else x[:, f]
        if len(rare):
            model.edges[f] = np.quantile(rare, np.linspace(0, 1, BINS + 1)[1:-1] if rare is x[:, f] else np.linspace(0, 0.9, BINS - 1))
        else:
            model.edges[f] = np.inf
    c = model.chains([t for t, _ in sample])
    bad_doc = (1 - y)[c.doc].astype(float)
    target = bad_doc.copy()
    for _ in range(rounds):
        _fit_lines(model, c, target)
        bad, _ = model.marginals(c)
        worst = np.zeros(len(c.count))
        np.maximum.at(worst, c.doc, bad)
        target = ((bad_doc == 1) & ((bad > 0.5) | (bad >= worst[c.doc]))).astype(float)
    bad, _ = model.marginals(c)
    some = c.count > 0
    model.final = _logistic(model.features(c, bad)[some], y[some])
    return model


def _fit_lines(model: Model, c: Chains, target: np.ndarray) -> None:
    """Maximum likelihood of the line labels ``target`` (1 bad), by Adam."""
    n, k = len(FEATURES), BINS
    cell = np.arange(n) * k + c.bins                                  # [line, feature] -> flat weight
    has_before, has_after = np.flatnonzero(~c.is_first), np.flatnonzero(~c.is_last)

    def sums(w: np.ndarray) -> np.ndarray:
        """Feature totals of line weights: own, before, after."""
        parts = ((cell, w), (cell[has_before - 1], w[has_before]), (cell[has_after + 1], w[has_after]))
        return np.concatenate([np.bincount(i.ravel(), np.repeat(v, n), n * k) for i, v in parts])

    y = target.astype(int)
    seen_pairs = np.array([[((y[has_before - 1] == a) & (y[has_before] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    head = c.is_first
    theta = np.concatenate([model.own.ravel(), model.before.ravel(), model.after.ravel(), model.start, model.step.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, _STEPS + 1):
        bad, pairs = model.marginals(c)
        start = np.array([((1 - target) - (1 - bad))[head].sum(), (target - bad)[head].sum()])
        grad = np.concatenate([sums(target - bad), start, (seen_pairs - pairs).ravel()]) - _L2 * theta
        grad /= max(1, len(target))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + _RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        own, before, after, model.start, step = np.split(theta, np.cumsum([n * k, n * k, n * k, 2]))
        model.own, model.before, model.after = (w.reshape(n, k) for w in (own, before, after))
        model.step = step.reshape(2, 2)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = _sigmoid(x @ w)
        g = x.T @ (p - y) + 0.05 * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Texts whose lines are laid out at once.
_ROWS = 512


def score(docs: DataFrame, model: Model, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, score, predicted) of every row."""
    key_type = docs.schema[key].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                s = model.scores(batch.column(1).to_pylist())
                held = [py_fold(k, 3) == 1 for k in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(held, pa.bool_()), pa.array(s, pa.float64()),
                     pa.array((s >= 0.5).astype(np.int32), pa.int32())], [key, "held_out", "score", "predicted"])

    return docs.select(key, text_col).mapInArrow(
        scored, f"`{key}` {key_type}, held_out boolean, score double, predicted int")
