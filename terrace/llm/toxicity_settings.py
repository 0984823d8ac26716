"""Settings of the toxicity fit, compared by folds inside its training rows.

``python -m terrace.llm.toxicity_settings FOLDER`` prints the comparison. Held-out rows
of the query are never read for it: ``training_rows`` leaves them out of the sample.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table
from .toxicity import fit_machine, training_data, training_rows, trusted

# (rounds, weight_penalty, factor_penalty, z)
GRID = tuple(product((160,), (1e-4, 1e-3), (5e-3, 1.5e-2, 5e-2), (0.0, 2.0, 4.0)))


def area(score: np.ndarray, y: np.ndarray) -> float:
    """The share of pairs of both classes that the score orders rightly, ties half."""
    rank = pd.Series(score).rank().to_numpy()
    positive = y.sum()
    return float((rank[y == 1].sum() - positive * (positive + 1) / 2) / max(positive * (len(y) - positive), 1))


def compare_settings(
    docs: DataFrame, labels: DataFrame, keep: Column, grid: Sequence[tuple] = GRID, folds: int = 3, limit: int = 8000
) -> DataFrame:
    """One row per setting: log-loss, area under the curve and errors at 0.3, over all folds of the sample.

    Each pair of setting and fold is a task of its own, which fits on the other folds
    of the sample (at most ``limit`` rows) and scores this one.
    """
    terms, x, y = training_data(docs, labels, keep, limit)
    part = np.random.default_rng(1).permutation(len(y)) % folds

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for job in batch["id"]:
                place, fold = divmod(int(job), folds)
                rounds, weight_penalty, factor_penalty, z = grid[place]
                train, test = np.flatnonzero(part != fold), np.flatnonzero(part == fold)
                rows, truth = x.take(train), y[train]
                trust = trusted(rows, truth, z)
                options = dict(rounds=rounds, trust=trust, weight_penalty=weight_penalty, factor_penalty=factor_penalty)
                model = fit_machine(terms, rows, truth, **options)
                left = x.take(test)
                both = left.times(np.column_stack([model.weights, model.factors]), left.values)
                squares = left.times((model.factors**2).sum(1)[:, None], left.values**2)[:, 0]
                score = 1 / (1 + np.exp(-np.clip(model._raw(both[:, 0], both[:, 1:], squares), -30, 30)))
                loss = -np.mean(np.log(np.where(y[test] == 1, score, 1 - score) + 1e-12))
                errors = int(((score >= 0.3) != (y[test] == 1)).sum())
                row = [rounds, weight_penalty, factor_penalty, z, loss, area(score, y[test]), errors]
                yield pd.DataFrame([row], columns=["rounds", "weight_penalty", "factor_penalty", "z", "loss", "area", "errors"])

    jobs = docs.sparkSession.range(0, len(grid) * folds, 1, len(grid) * folds)
    kinds = "rounds long, weight_penalty double, factor_penalty double, z double, loss double, area double, errors long"
    judged = jobs.mapInPandas(judge, kinds).groupBy("rounds", "weight_penalty", "factor_penalty", "z")
    means = judged.agg(F.avg("loss").alias("loss"), F.avg("area").alias("area"), F.sum("errors").alias("errors"))
    return means.orderBy("loss", "rounds", "weight_penalty", "factor_penalty", "z")


if __name__ == "__main__":
    from ..session import local_session

    session = local_session()
    found = compare_settings(table(session, sys.argv[1], "documents"), table(session, sys.argv[1], "labels"), training_rows(4, 2))
    print(found.toPandas().to_string())
