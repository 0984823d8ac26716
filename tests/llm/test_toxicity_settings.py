import numpy as np
import pytest

from terrace.llm import toxicity, toxicity_settings
from terrace.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_area_counts_ordered_pairs():
    assert toxicity_settings.area(np.array([0.1, 0.4, 0.4, 0.9]), np.array([0, 0, 1, 1])) == 0.875


def test_settings_are_judged_on_training_rows_only(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    keep = toxicity.training_rows(4, 2)
    grid = [(2, 1e-4, 5e-2, 4.0), (20, 1e-4, 5e-2, 4.0)]
    rows = toxicity_settings.compare_settings(docs, labels, keep, grid, folds=2).collect()
    assert [r["rounds"] for r in rows] == [20, 2]  # the better fit first
    changed = labels.withColumn("toxic", (keep.cast("int") * labels["toxic"]))  # held-out labels all 0
    again = toxicity_settings.compare_settings(docs, changed, keep, grid, folds=2).collect()
    assert [(r["area"], r["errors"]) for r in again] == [(r["area"], r["errors"]) for r in rows]


def test_taken_rows_are_those_of_the_matrix():
    x = np.array([[1.0, 0, 2], [0, 0, 0], [0, 3, 0], [4, 5, 6]])
    part = toxicity.SparseRows.of(x).take(np.array([3, 1, 0]))
    eye = np.eye(3)
    assert part.times(eye, part.values) == pytest.approx(x[[3, 1, 0]])
