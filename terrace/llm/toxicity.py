"""Toxicity from a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import WordHasher
from .samples import fold, labelled_sample

# Words are runs of ASCII letters, digits and all non-ASCII characters.
TERMS = WordHasher(bytes(b for b in range(128) if not chr(b).isalnum()))
BITS = 20


def hashed_terms(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct hashed terms of a text, how often each occurs, and the number of words."""
    words = TERMS(text)
    terms, counts = np.unique((words >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    return terms, counts, len(words)


@dataclass
class SparseRows:
    """Rows of which only the inputs that differ from 0 are held: ``columns`` and ``values`` from ``starts`` on."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, x: np.ndarray) -> SparseRows:
        row, column = np.nonzero(x)
        return cls(np.searchsorted(row, np.arange(len(x))), column, x[row, column], x.shape[1])

    def take(self, places: np.ndarray) -> SparseRows:
        ends = np.append(self.starts[1:], len(self.columns))
        held = [slice(a, b) for a, b in zip(self.starts[places], ends[places])]
        none = [np.empty(0, np.int64)]
        sizes = np.array([h.stop - h.start for h in held], np.int64)
        parts = (np.concatenate([a[h] for h in held] or none) for a in (self.columns, self.values))
        return SparseRows(np.cumsum(sizes) - sizes, *parts, self.width)

    def __post_init__(self):
        sizes = np.diff(np.append(self.starts, len(self.columns)))
        self.filled = np.flatnonzero(sizes)
        self.order = np.argsort(self.columns, kind="stable")
        self.by_column = np.repeat(np.arange(len(sizes)), sizes)[self.order], self.values[self.order]
        self.present, self.first = np.unique(self.columns[self.order], return_index=True)

    def times(self, matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The rows, with ``values`` as their inputs, times ``matrix``, one column after the other."""
        out = np.zeros((len(self.starts), matrix.shape[1]))
        for k, c in enumerate(np.ascontiguousarray(matrix.T)):
            out[self.filled, k] = np.add.reduceat(values * c[self.columns], self.starts[self.filled])
        return out

    def sums(self, per_row: np.ndarray, squared: bool = False) -> np.ndarray:
        """Over each column, the sum of its (squared) values times the numbers of their rows."""
        out = np.zeros((self.width, per_row.shape[1]))
        owner, values = self.by_column
        if len(owner):
            values = values**2 if squared else values
            for k, c in enumerate(np.ascontiguousarray(per_row.T)):
                out[self.present, k] = np.add.reduceat(values * c[owner], self.first)
        return out


@dataclass
class FactorMachine:
    """``bias + w.x + pairs of x weighted by dot products of their factors``, through a logistic curve.

    The inputs are all hashed terms of the training texts and, last, the length.
    """

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def inputs(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of a text's inputs: 1 + log(count) of each known term, and how long the text is."""
        terms, counts, n = hashed_terms(text)
        at = np.searchsorted(self.terms, terms)
        same = at < len(self.terms)
        same[same] = self.terms[at[same]] == terms[same]
        return np.append(at[same], len(self.weights) - 1), np.append(1 + np.log(counts[same]), np.log1p(n) / 5)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._raw(x @ self.weights, x @ self.factors, x**2 @ (self.factors**2).sum(1))

    def _raw(self, linear: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> np.ndarray:
        return self.bias + linear + ((sums**2).sum(-1) - squares) / 2

    def score(self, text: bytes) -> float:
        at, x = self.inputs(text)
        factors = self.factors[at]
        raw = self._raw(x @ self.weights[at], x @ factors, x**2 @ (factors**2).sum(1))
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def fit_machine(
    terms: np.ndarray,
    x: np.ndarray | SparseRows,
    y: np.ndarray,
    size: int = 4,
    rounds: int = 160,
    seed: int = 5,
    trust: np.ndarray | None = None,
    weight_penalty: float = 1e-4,
    factor_penalty: float = 5e-2,
) -> FactorMachine:
    """Adam on the penalised log-loss of all sample rows; without both classes the score is constant.

    The steps of inputs that fewer than about ten rows speak for are damped. ``trust``,
    over 0 to 1, slows and shrinks single weights, never the factors of pairs. The first
    half of the rounds fits weights only.
    """
    rows = x if isinstance(x, SparseRows) else SparseRows.of(x)
    width = rows.width
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        return FactorMachine(terms, 30.0 * (2 * share - 1), np.zeros(width), np.zeros((width, size)))
    rng = np.random.default_rng(seed)
    trust = np.ones(width) if trust is None else trust
    model = FactorMachine(terms, float(np.log(share / (1 - share))), np.zeros(width), rng.normal(0, 0.005, (width, size)))
    m, v = np.zeros(1 + width * (1 + size)), np.zeros(1 + width * (1 + size))
    squares = rows.values**2
    for t in range(1, rounds + 1):
        both = rows.times(np.column_stack([model.weights, model.factors]), rows.values)
        sums = both[:, 1:]
        raw = model._raw(both[:, 0], sums, rows.times((model.factors**2).sum(1)[:, None], squares)[:, 0])
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / len(y)
        back = rows.sums(np.column_stack([error, error[:, None] * sums]))
        g_weights = back[:, 0] * trust + weight_penalty * model.weights / trust
        g_factors = back[:, 1:] - model.factors * rows.sums(error[:, None], squared=True) + factor_penalty * model.factors
        g = np.concatenate([[error.sum()], g_weights, g_factors.ravel()])
        if t <= rounds // 2:  # weights first: the pairs explain what they leave
            g[1 + width :] = 0
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 10 / len(y))
        model.bias -= float(step[0])
        model.weights = model.weights - step[1 : 1 + width] * trust
        model.factors = model.factors - step[1 + width :].reshape(width, size)
    return model


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    limit: int = 8000,
    z: float = 4.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> FactorMachine:
    """Fit on at most ``limit`` labelled documents that ``keep`` admits, in order of a hash of their ids.

    All their hashed terms are inputs, with a weight and factors each. The weight of a
    term whose document count among toxic ones lies fewer than ``z`` deviations off what
    its frequency gives is shrunk the more, the fewer they are; its factors are not, so
    terms that are neutral alone can be toxic in pairs. The sample's distinct terms with
    their counts, but no texts, reach the driver.

    The defaults of ``z`` and of ``fit_machine`` come from folds inside the training
    rows (``toxicity_settings``). Null and empty texts are texts without terms; null
    ids and labels are not sampled, of rows that repeat an id one is; other columns are
    ignored; an empty table gives a constant score.
    """
    terms, x, y = training_data(docs, labels, keep, limit, id_column, text_column)
    return fit_machine(terms, x, y, trust=trusted(x, y, z))


def training_data(
    docs: DataFrame, labels: DataFrame, keep: Column, limit: int, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[np.ndarray, SparseRows, np.ndarray]:
    """The sample's distinct terms, its rows over them (last, the length) and its labels, ordered by id."""
    sample = labelled_sample(docs, labels, "toxic", keep, limit, id_column, text_column)
    kind = sample.schema["id"].dataType.simpleString()

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found, counts, n = hashed_terms(batch.column(2)[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([found.astype(np.int32)]), pa.array([counts.astype(np.int32)]), pa.array([n], pa.int64())],
                    ["id", "label", "terms", "counts", "n"],
                )

    rows = sample.select("id", "label", F.col("text").cast("binary").alias("text"))
    data = rows.mapInArrow(terms_of, f"id {kind}, label int, terms array<int>, counts array<int>, n long").toArrow()
    ids, truth = data["id"].to_pylist(), data["label"].to_pylist()
    data = data.take(pa.array(sorted(range(len(ids)), key=lambda i: (ids[i], truth[i])), pa.int64()))  # the same order in every run
    found, counts = ([r.values.to_numpy() for r in data[c]] for c in ("terms", "counts"))
    y, n = data["label"].to_numpy().astype(float), data["n"].to_numpy()
    terms = np.unique(np.concatenate([np.empty(0, np.int32), *found]))
    sizes = np.array([len(f) + 1 for f in found], np.int64)
    columns = [np.append(np.searchsorted(terms, f), len(terms)) for f in found]
    values = [np.append(1 + np.log(c), np.log1p(k) / 5) for c, k in zip(counts, n)]
    none = [np.empty(0, np.int64)]
    x = SparseRows(np.cumsum(sizes) - sizes, np.concatenate(columns or none), np.concatenate(values or none), len(terms) + 1)
    return terms, x, y


def trusted(x: SparseRows, y: np.ndarray, z: float) -> np.ndarray:
    """Of each input 1 if its rows' labels lie ``z`` deviations off their share, else the square of what part of it they lie off, 0.02 at least."""
    total, share = len(y), y.mean() if len(y) else 0.0
    if not 0 < share < 1 or z <= 0:
        return np.ones(x.width)
    n = np.bincount(x.columns, minlength=x.width)
    hits = np.bincount(x.columns[x.order], weights=y[x.by_column[0]], minlength=x.width)
    off = np.maximum(np.abs(hits - n * share) - 1, 0) / np.sqrt(np.maximum(n, 1) * share * (1 - share) * (1 - n / (total + 1)))
    out = np.clip((off / z) ** 2, 0.02, 1)
    out[-1] = 1
    return out


def toxicity_scores(docs: DataFrame, model: FactorMachine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column`` and ``score`` of every row's whole text, each from its text alone; null text counts as empty."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                values = pa.array([model.score(t) for t in batch.column(1).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), values], ["id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_column)


def training_rows(folds: int = 4, held_out: int = 2, id_column: str = "doc_id") -> Column:
    return fold(F.col(id_column), folds) != held_out
