"""Linear models fitted in the span of the rows, against MLlib's and against minima by other means."""
import random

import numpy as np
import pytest
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import classify, linear, search
from tessera.plans import models


def rows_of(spark, n=90, classes=2, seed=3, width=25):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = i % classes
        at = sorted(rng.sample(range(width), 6))
        x = [rng.random() + (0.6 if j % classes == y else 0) for j in at]
        rows.append((i, float(y if rng.random() < 0.8 else rng.randrange(classes)), Vectors.sparse(width, at, x)))
    rows.append((n, 0.0, Vectors.sparse(width, [], [])))
    return spark.createDataFrame(rows, ["id", "label_idx", "features"])


def dense(df):
    got = df.orderBy("id").collect()
    return np.array([r.features.toArray() for r in got]), np.array([r.label_idx for r in got])


@pytest.mark.parametrize("classes", [2, 4])
def test_logistic_coefficients_equal_mllib_at_its_minimum(spark, classes):
    df = rows_of(spark, classes=classes).repartition(3).cache()
    model = classify.fit_linear(df, ["logreg"], classes)["logreg"]
    exact = classify.classifier("logreg", n_rows=df.count(), tol=1e-9).fit(df)
    np.testing.assert_allclose(model.coefficientMatrix.toArray(), exact.coefficientMatrix.toArray(), atol=2e-4)
    np.testing.assert_allclose(model.interceptVector.toArray(), exact.interceptVector.toArray(), atol=2e-4)
    a, b = (m.transform(df).select("id", "prediction").orderBy("id").collect() for m in (model, exact))
    assert a == b


def test_hinge_is_within_its_gap_and_below_mllib(spark, tmp_path):
    df = rows_of(spark, 60)
    x, label = dense(df)
    y = np.where(label == 1, 1, -1)
    model = classify.fit_linear(df, ["svm"], 2)["svm"]
    model.write().save(str(tmp_path / "svm"))
    machine = model.models[1]
    other = classify.classifier("svm", n_rows=len(y), binary=True, max_iter=100, tol=1e-9).fit(df)

    def value(m):
        w = m.coefficients.toArray()
        return np.maximum(0, 1 - y * (x @ w + m.intercept)).mean() + w @ w / (2 * len(y))
    assert value(machine) <= value(other) * (1 + linear.GAP)
    loaded = OneVsRestModel.load(str(tmp_path / "svm"))
    a, b = (m.transform(df).select("id", "prediction").orderBy("id").collect() for m in (model, loaded))
    assert a == b and {r.prediction for r in a} == {0.0, 1.0}


def test_blocks_of_columns_give_the_gram_product(spark, monkeypatch):
    """More partitions than sums are collected from, small blocks, counts and weights."""
    monkeypatch.setattr(linear, "BLOCK", 5)
    monkeypatch.setattr(linear, "PARTITION", 4)
    rng = random.Random(0)
    docs = [(i * 3, [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 9))]) for i in range(30)]
    df = spark.createDataFrame(docs, "_id long, t array<string>")
    columns = df.select("_id", F.explode("t").alias("term")).groupBy("term").agg(F.collect_list("_id").alias("ids")).select("ids")
    x = np.array([[t.count(c) for c in "abcdefgh"] for _, t in docs], float)
    used = [j for j in range(8) if x[:, j].any()]

    def weigh(start, rows):
        df = np.diff(np.append(start, len(rows))).astype(float)
        return np.array([1 / df, np.ones(len(df))]).T
    made = linear.Columns(columns, np.array([i for i, _ in docs]), sum(len(t) for _, t in docs), weigh)
    assert made.parts > 16
    a = np.random.default_rng(1).normal(size=(3, 30))
    for k, (weighting, got) in enumerate(zip([0, 1, 0], made.gram(a, [0, 1, 0]), strict=True)):
        w = x[:, used] / (x[:, used] > 0).sum(0) if weighting == 0 else x[:, used]
        norm = np.sqrt((w ** 2).sum(1, keepdims=True))
        w = np.divide(w, norm, out=np.zeros_like(w), where=norm > 0)
        np.testing.assert_allclose(got, w @ w.T @ a[k], atol=1e-9)


def test_a_fold_of_one_class_and_rows_without_terms(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 7 == 0], ["w"] * (i % 3), i % 2) for i in range(14)],
                                 "doc_id long, label string, tokens array<string>, fold int")
    some = [search.Candidate("logreg"), search.Candidate("svm"), search.Candidate("logreg", (1, 2), 50)]
    got = dict(search.cross_validate(docs.where("label = 'a' OR fold = 0"), some))
    assert sorted(got) == [0, 1, 2] and all(0 <= v <= 1 for v in got.values())


def test_whole_grids_are_searched(spark, monkeypatch):
    """no setting of a grid is left out by default, and 20 settings are drawn."""
    asked = []
    monkeypatch.setattr(models, "_searched", lambda spark, sf, candidates, task="quality": asked.append(list(candidates)))
    models.grid_search(spark, "")
    models.random_search(spark, "")
    models.svm_grid(spark, "")
    assert asked[0] == models.LR_GRID and asked[2] == models.SVM_GRID
    assert len(asked[1]) == len(set(asked[1])) == 20 and set(asked[1]) <= set(models.LR_SPACE)
