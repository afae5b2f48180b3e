"""Pairwise probabilities of linear SVMs."""
import math
import random

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import svm


def test_coupling_recovers_consistent_pairs():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(9), 50)
    r = p[:, :, None] / (p[:, :, None] + p[:, None, :])
    np.testing.assert_allclose(svm.couple(r), p, atol=1e-6)
    odd = rng.random((20, 4, 4))
    odd = np.triu(odd, 1) + np.tril(1 - np.swapaxes(odd, 1, 2), -1)
    np.testing.assert_allclose(svm.couple(odd).sum(1), 1)
    assert svm.couple(np.zeros((0, 3, 3))).shape == (0, 3)


def test_left_out_margins_give_better_probabilities(spark):
    """Many features and noisy labels: machines separate their own rows, so their margins mislead."""
    rng = random.Random(4)

    def rows(n):
        for i in range(n):
            y = rng.randrange(3)
            x = [rng.gauss(1.2 if k % 3 == y else 0, 1.0) for k in range(6)] + [rng.gauss(0, 1) for _ in range(60)]
            yield i, float(rng.randrange(3) if rng.random() < 0.2 else y), i % 4, Vectors.dense(x)
    schema = ["id", "label_idx", "fold", "features"]
    train, test = spark.createDataFrame(list(rows(150)), schema), spark.createDataFrame(list(rows(150)), schema)
    model = svm.fit_pairwise(train, 3, c=10.0, k=4)
    naive = svm.Pairwise(3, [])
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    for a, b, machine, _, _ in model.machines:  # the same machines, calibrated on their own rows
        own = train.where(F.col("label_idx").isin(float(a), float(b))).withColumn("y", (F.col("label_idx") == float(b)).cast("double"))
        scored = svm.with_margin(machine, own, "margin")
        lr = LogisticRegression(featuresCol="m", labelCol="y").fit(VectorAssembler(inputCols=["margin"], outputCol="m").transform(scored))
        naive.machines.append((a, b, machine, float(lr.coefficients[0]), float(lr.intercept)))

    def log_loss(m):
        got = svm.probabilities(test, m).collect()
        assert all(abs(sum(r.probability) - 1) < 1e-9 for r in got) and len(got) == 150
        return -sum(math.log(max(r.probability[int(r.label_idx)], 1e-12)) for r in got) / len(got)
    assert log_loss(model) < log_loss(naive)
