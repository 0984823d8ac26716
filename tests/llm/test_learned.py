"""Toxicity and quality models: held-out accuracy, constants without labels, awkward rows."""

import zlib

import numpy as np
import pytest
from cases import awkward, awkward_rows, empty, in_order
from pyspark.sql import functions as F

from terrace.llm import quality, queries, samples, toxicity

FOLDER = "/root/testdata/sf0.01"


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])


@pytest.mark.parametrize("name,label,least", [("op6_toxicity", "toxic", 0.75), ("op8_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    found = queries.QUERIES[name](spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("score", label, "predicted").collect()
    assert auc([(r[0], r[1]) for r in rows]) >= least
    assert np.mean([r[2] == r[1] for r in rows]) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.collect())


def test_folds(spark):
    rows = [(k,) for k in [*range(50), -3, None]]
    got = spark.createDataFrame(rows, "doc_id long").select("doc_id", samples.fold(F.col("doc_id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 for r in got)


def test_sample_takes_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"copy {k % 7}") for k in range(300)] + [(2, "b"), (3, None)], "doc_id long, text string")
    known = labels(spark, [(1, 1, 0), (2, 0, 0), (3, 1, 0)])
    got = [samples.labelled_sample(d, known, "quality", F.lit(True), 10).collect() for d in (docs, docs.repartition(7))]
    assert sorted(r["id"] for r in got[0]) == [1, 2, 3]
    assert sorted(got[0]) == sorted(got[1])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("rows,quality_score,toxic_score", [([], 0.5, 0.5), ([(1, 1, 1), (3, 1, 1)], 1.0, 1.0), ([(1, 0, 0), (None, 1, 1), (7, None, None)], 0.0, 0.0)])
def test_constants_without_both_classes(spark, rows, quality_score, toxic_score):
    docs, known = awkward(spark), labels(spark, rows)
    field = quality.fit_quality(docs, known, F.lit(True))
    machine = toxicity.fit_toxicity(docs, known, F.lit(True))
    for scores, want in ((quality.quality_scores(docs, field), quality_score), (toxicity.toxicity_scores(docs, machine), toxic_score)):
        got = scores.collect()
        assert len(got) == len(awkward_rows())
        assert all(abs(r["score"] - want) < 1e-9 for r in got)


def test_scores_of_awkward_rows(spark):
    docs, known = awkward(spark), labels(spark, [(1, 1, 0), (3, 0, 1), (9, 1, 0), (13, 0, 1), (5, 1, 0), (99, 1, 1)])
    field = quality.fit_quality(docs, known, F.lit(True))
    machine = toxicity.fit_toxicity(docs, known, F.lit(True), z=0.0)
    for scores in (quality.quality_scores(docs, field), toxicity.toxicity_scores(docs, machine)):
        got = scores.collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, *_ in awkward_rows())
        assert all(0 <= r["score"] <= 1 for r in got)
        by_id = [r["score"] for r in got if r["doc_id"] == 2]
        assert by_id[0] == by_id[1]
    column = docs.select("doc_id", quality.quality_column(field, F.col("text")).alias("score"))
    assert in_order(map(tuple, column.collect())) == in_order(map(tuple, quality.quality_scores(docs, field).collect()))
    assert quality.quality_scores(empty(spark), field).count() == toxicity.toxicity_scores(empty(spark), machine).count() == 0


def test_pairs_need_both_terms():
    """Toxic only where two terms meet: no additive weights can tell."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 2, (2000, 2)).astype(float), np.zeros((2000, 1))], axis=1)
    y = x[:, 0] * x[:, 1]
    machine = toxicity.fit_machine(np.array([3, 5]), x, y, rounds=800)
    p = 1 / (1 + np.exp(-machine.raw(np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0], [1, 1, 0]], float))))
    assert (p[:3] < 0.2).all() and p[3] > 0.8
    sums = sum(machine.factors[i] @ machine.factors[j] * x[:, i] * x[:, j] for i in range(3) for j in range(i))
    assert np.allclose(machine.raw(x), machine.bias + x @ machine.weights + sums)


def test_pairs_of_neutral_terms_through_the_fit(spark):
    """Toxic where both or none of two words stand: each word alone is neutral and no screen by itself would take it."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(1600):
        one, two = k % 2, k // 2 % 2
        rows.append((k, " ".join([*(f"w{i}" for i in rng.integers(0, 300, 12)), *["alpha"] * one, *["beta"] * two]), int(one == two)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    machine = toxicity.fit_toxicity(docs, labels(spark, [(k, 1, y) for k, _, y in rows]), F.col("doc_id") < 1200)
    assert len(machine.terms) >= 295
    scores = toxicity.toxicity_scores(docs.where("doc_id >= 1200"), machine).collect()
    assert np.mean([(r["score"] >= 0.5) == rows[r["doc_id"]][2] for r in scores]) >= 0.95


def test_lines_after_the_first_block_train_the_field():
    """Bad documents differ from good ones only after line 400."""
    line, junk = b"A plain line of words, as others are.", b"|| == {} <> ## 000 // || == {}"
    good = b"\n".join([line] * 440)
    bad = b"\n".join([line] * 410 + [junk] * 30)
    field = quality.fit_lines([good, bad] * 4, [1, 0] * 4)
    assert field.score(good) > 0.5 > field.score(bad)
    p = field.marginals(quality.line_features(bad)[0])
    assert p[412:].mean() < 0.1 < p[:400].mean()


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    field = quality.LineField(rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2)))
    features = rng.normal(size=(5, quality.FEATURES)) / 3
    score = features @ field.unary
    weights = np.zeros((5, 2))
    for code in range(32):
        y = [code >> k & 1 for k in range(5)]
        w = np.exp(sum(score[k] * (y[k] - 0.5) for k in range(5)) + sum(field.pair[a, b] for a, b in zip(y, y[1:])))
        for k in range(5):
            weights[k, y[k]] += w
    assert np.allclose(field.marginals(features), weights[:, 1] / weights.sum(1))


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3, 4, quality.FEATURES)) / 3
    y = rng.integers(0, 2, (3, 4))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)
    theta = rng.normal(size=quality.FEATURES + 4) / 3

    def value(theta):
        total = 0.0
        for row in range(3):
            n = int(mask[row].sum())
            score, pair = x[row, :n] @ theta[: quality.FEATURES], theta[quality.FEATURES :].reshape(2, 2)
            logs = []
            for code in range(1 << n):
                z = [code >> k & 1 for k in range(n)]
                logs.append(sum(score[k] * (z[k] - 0.5) for k in range(n)) + sum(pair[a, b] for a, b in zip(z, z[1:])))
            z = y[row, :n].tolist()
            total += logs[sum(b << k for k, b in enumerate(z))] - np.log(np.exp(logs).sum())
        return total

    got = quality._gradient(theta, x, y, mask)
    for k in (0, 3, quality.FEATURES, quality.FEATURES + 1, quality.FEATURES + 2, quality.FEATURES + 3):
        step = np.zeros_like(theta)
        step[k] = 1e-5
        assert abs((value(theta + step) - value(theta - step)) / 2e-5 - got[k]) < 1e-5
