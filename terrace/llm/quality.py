"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import LOWERED, WordHasher
from .samples import fold, labelled_sample

WORDS = WordHasher(b"\x09\x0a\x0b\x0c\x0d\x20")


def _class(test) -> np.ndarray:
    return np.array([test(chr(b)) if b < 128 else False for b in range(256)], bool)


UPPER = _class(str.isupper)
LOWER = _class(str.islower) | (np.arange(256) >= 128)
DIGIT = _class(str.isdigit)
BLANK = _class(str.isspace)
MARK = _class(lambda c: c in ".,;:?'\"()-")
ODD = _class(lambda c: c.isprintable() and not c.isalnum() and c not in " .,;:?'\"()-")
BAR = _class(lambda c: c in "|{}<>=/\\")
STOP = _class(lambda c: c in ".?")
OWN = 13
FEATURES = 1 + OWN + 2 * 6 + 2


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of a text's lines; an empty text is one empty line.

    Own features: shares of byte classes, word lengths, repetition of words within
    the line and of the line within the text. Neighbour features: the difference to
    the line before and after in six of them, and whether there is one. Shares and
    logarithms keep every value between 0 and about 3.
    """
    data = np.frombuffer(text, np.uint8)
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [len(data)]])
    length = ends - starts
    size = np.maximum(length, 1)

    def share(kind: np.ndarray) -> np.ndarray:
        totals = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        return (totals[ends] - totals[starts]) / size

    blank = np.concatenate([[True], BLANK[data]])
    word_starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    line_of = np.searchsorted(ends, word_starts, side="left")
    words = np.bincount(line_of, minlength=len(starts))
    hashes = WORDS(text)
    order = np.lexsort((hashes, line_of))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][new], minlength=len(starts))
    seen_in_text = np.unique(hashes, return_inverse=True, return_counts=True)
    repeats = np.bincount(line_of, weights=(seen_in_text[2][seen_in_text[1]] > 1), minlength=len(starts)) if len(hashes) else np.zeros(len(starts))
    sums = np.bincount(line_of, weights=(hashes >> np.uint64(40)).astype(float), minlength=len(starts))
    _, which, times = np.unique(sums, return_inverse=True, return_counts=True)
    many = np.maximum(words, 1)
    visible = 1 - share(BLANK)
    own = np.stack(
        [
            share(UPPER),
            share(LOWER),
            share(DIGIT) * 3,
            share(MARK) * 3,
            share(ODD) * 3,
            share(BAR) * 5,
            share(STOP) * 5,
            np.log1p(length) / 4,
            np.log1p(words) / 3,
            np.minimum(visible * size / many, 30) / 10,
            1 - distinct / many,
            repeats / many,
            (times[which] > 1) & (words > 0),
        ],
        axis=1,
    ).astype(float)
    beside = own[:, [0, 1, 4, 5, 9, 12]]
    n = len(own)
    before, after = np.zeros((n, 6)), np.zeros((n, 6))
    before[1:], after[:-1] = beside[:-1], beside[1:]
    inner = np.ones((n, 2))
    inner[0, 0] = inner[-1, 1] = 0
    return np.concatenate([np.ones((n, 1)), own, before, after, inner], axis=1), length


@dataclass
class LineField:
    """A field with two labels: ``unary`` scores good against bad, ``pair`` the label pairs."""

    unary: np.ndarray
    pair: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """P(good) of every line, by one pass forward and one backward."""
        score = np.clip(features @ self.unary, -30, 30)
        step = np.exp(self.pair)
        a00, a01, a10, a11 = step.ravel().tolist()
        good = np.exp(score / 2).tolist()
        n = len(good)
        forward = [0.0] * n
        p, q = 0.5, 0.5
        for i, g in enumerate(good):
            x, y = (p, q) if i == 0 else (p * a00 + q * a10, p * a01 + q * a11)
            x, y = x / g, y * g
            total = x + y
            p, q = x / total, y / total
            forward[i] = q
        out = [0.0] * n
        p, q = 1.0, 1.0
        for i in range(n - 1, -1, -1):
            f = forward[i]
            x, y = (1 - f) * p, f * q
            out[i] = y / (x + y)
            g = good[i]
            x, y = p / g, q * g
            p, q = a00 * x + a01 * y, a10 * x + a11 * y
            total = p + q
            p, q = p / total, q / total
        return np.array(out)

    def share_good(self, text: bytes) -> float:
        features, length = line_features(text)
        weight = length + 1.0
        return float(self.marginals(features) @ weight / weight.sum())

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + np.exp(-np.clip(self.slope * (self.share_good(text) - 0.5) + self.shift, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Newton steps for weighted logistic regression; the first column is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        change = np.linalg.solve(curve, gradient)
        w -= change
        if np.abs(change).max() < 1e-6:
            break
    return w


def _field_fit(chains: list[np.ndarray], labels: list[np.ndarray], unary: np.ndarray, rounds: int = 60) -> LineField:
    """Maximum conditional likelihood by Adam; chains of like length go through the recursions together."""
    pair = np.array([[0.5, -0.5], [-0.5, 0.5]])
    by_length = sorted(range(len(chains)), key=lambda i: len(chains[i]))
    blocks = []
    for s in range(0, len(by_length), 256):
        part = by_length[s : s + 256]
        top = len(chains[part[-1]])
        x = np.zeros((len(part), top, FEATURES))
        y = np.zeros((len(part), top), int)
        mask = np.zeros((len(part), top), bool)
        for row, i in enumerate(part):
            n = len(chains[i])
            x[row, :n], y[row, :n], mask[row, :n] = chains[i], labels[i], True
        blocks.append((x, y, mask))
    lines = sum(map(len, chains))
    theta = np.concatenate([unary, pair.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        gradient = np.zeros_like(theta)
        for x, y, mask in blocks:
            gradient += _gradient(theta, x, y, mask)
        gradient = gradient / lines - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return LineField(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def _gradient(theta: np.ndarray, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Observed less expected feature sums of padded chains."""
    rows, top, _ = x.shape
    score = np.clip(x @ theta[:FEATURES], -30, 30)
    local = np.exp(np.stack([-score / 2, score / 2], axis=2))
    step = np.exp(theta[FEATURES:].reshape(2, 2))
    forward = np.zeros((rows, top, 2))
    backward = np.ones((rows, top, 2))
    forward[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
    for i in range(1, top):
        f = (forward[:, i - 1] @ step) * local[:, i]
        forward[:, i] = f / f.sum(1, keepdims=True)
    for i in range(top - 2, -1, -1):
        b = (backward[:, i + 1] * local[:, i + 1]) @ step.T
        b /= b.sum(1, keepdims=True)
        backward[:, i] = np.where(mask[:, i + 1, None], b, 1.0)
    marginal = forward * backward
    marginal /= marginal.sum(2, keepdims=True)
    unary = ((y - marginal[:, :, 1]) * mask)[:, :, None] * x
    gradient = np.zeros_like(theta)
    gradient[:FEATURES] = unary.sum((0, 1))
    if top > 1:
        both = mask[:, 1:]
        joint = forward[:, :-1, :, None] * step * (local * backward)[:, 1:, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        pair = -(joint * both[:, :, None, None]).sum((0, 1))
        np.add.at(pair, (y[:, :-1][both], y[:, 1:][both]), 1.0)
        gradient[FEATURES:] = pair.ravel()
    return gradient


def fit_lines(texts: list[bytes], labels: list[int], rounds: int = 3, lines: int = 400) -> LineField:
    """Learn the field from documents' labels.

    Lines have no labels of their own. All lines of good documents are good; lines of
    bad documents start as bad, and each round a logistic model of the lines releases
    those of them that look good, but never a document's worst. The field is fitted to
    the last labels of all lines, long texts in consecutive blocks of ``lines`` lines so
    that padding stays small, and a logistic curve maps the good share of documents to probabilities.
    No texts give the constant 0.5, one class gives that class.
    """
    if len(set(labels)) < 2:
        return LineField(np.zeros(FEATURES), np.zeros((2, 2)), constant=float(labels[0]) if labels else 0.5)
    chains = [line_features(t)[0] for t in texts]
    truth = np.array(labels)
    x = np.concatenate(chains)
    owner = np.repeat(np.arange(len(chains)), list(map(len, chains)))
    cuts = np.cumsum([0, *map(len, chains)])
    weight = 1.0 / np.sqrt(np.diff(cuts))[owner]
    y = truth[owner].copy()
    for _ in range(rounds):
        w = _logistic(x, y.astype(float), weight, 1.0)
        value = x @ w
        y = truth[owner].copy()
        for i in np.flatnonzero(truth == 0):
            own = value[cuts[i] : cuts[i + 1]]
            y[cuts[i] : cuts[i + 1]] = (own > 1.0) & (own > own.min())
    blocks = [(s, min(s + lines, b)) for a, b in zip(cuts, cuts[1:]) for s in range(a, b, lines)]
    field = _field_fit([x[a:b] for a, b in blocks], [y[a:b] for a, b in blocks], _logistic(x, y.astype(float), weight, 1.0))
    share = np.array([field.share_good(t) for t in texts])
    curve = _logistic(np.stack([np.ones(len(share)), share - 0.5], axis=1), truth.astype(float), np.ones(len(share)), 0.1)
    field.shift, field.slope = float(curve[0]), float(curve[1])
    return field


def fit_quality(
    docs: DataFrame, labels: DataFrame, keep: Column, limit: int = 4000, id_column: str = "doc_id", text_column: str = "text"
) -> LineField:
    """Fit on at most ``limit`` labelled documents that ``keep`` admits, in order of a hash of their ids."""
    sample = labelled_sample(docs, labels, "quality", keep, limit, id_column, text_column)
    rows = sorted((r["id"], r["label"], r["text"]) for r in sample.collect())
    return fit_lines([t.encode() for _, _, t in rows], [y for _, y, _ in rows])


def quality_scores(docs: DataFrame, field: LineField, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column`` and ``score`` of every row's whole text, each from its text alone; null text counts as empty."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                values = pa.array([field.score(t) for t in batch.column(1).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), values], ["id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_column)


def quality_column(field: LineField, text: Column) -> Column:
    """The score as a column, for filters that keep whole rows."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([field.score(t or b"") for t in texts], dtype="float64")

    return score(F.coalesce(text, F.lit("")).cast("binary"))


def training_rows(folds: int = 5, held_out: int = 0, id_column: str = "doc_id") -> Column:
    return fold(F.col(id_column), folds) != held_out
