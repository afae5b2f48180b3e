"""Class probabilities of linear support vector machines (M3), for any number of classes.

For every pair of classes a machine is fitted on their rows; its margins on rows that a fold left
out, not those of its own training rows, give the pair's probability by a one-feature
logistic regression. The pairwise probabilities r[i, j] are coupled: p minimises
``Σ_i Σ_j≠i (r[j, i] p[i] - r[i, j] p[j])²`` with ``Σ p = 1``, a linear system of the number of classes.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from .search import FOLDS, ROWS_PER_PARTITION


@dataclass
class Pairwise:
    """``machines`` holds (first class, second class, fitted machine, slope, offset): the second class
    has the probability ``1 / (1 + exp(-(slope * margin + offset)))`` against the first."""
    n_classes: int
    machines: list[tuple[int, int, object, float, float]]


def with_margin(model, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the machine's margin as column ``name``."""
    from pyspark.ml.functions import vector_to_array
    raw, guess = f"{name}_raw", f"{name}_guess"
    scored = model.copy().setRawPredictionCol(raw).setPredictionCol(guess).transform(rows)
    return scored.withColumn(name, vector_to_array(raw)[1]).drop(raw, guess)


def fit_pairwise(train: DataFrame, n_classes: int, c: float = 1.0, k: int = FOLDS) -> Pairwise:
    """Fit on ``train`` (features, label_idx, fold): one machine and one logistic regression a pair. The machines
    of all pairs and folds are fitted together (``linear.fit``), which also gives the left-out margins."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    spark, machines = train.sparkSession, []
    x = linear.Rows(train, "label_idx", "fold")
    label, fold = x.about["label_idx"].to_numpy(), x.about["fold"].to_numpy()
    fits = []
    for a, b in combinations(range(n_classes), 2):
        pair, target = (label == a) | (label == b), np.where(label == b, 1.0, -1.0)
        reg = 1.0 / (c * max(1, int(pair.sum())))
        fits.append((a, b, pair, target, [linear.Problem("hinge", target, pair & (fold != f), reg) for f in [*range(k), None]]))
    linear.fit(x, [p for *_, problems in fits for p in problems])
    for a, b, pair, target, (*parts, whole) in fits:
        margin = np.select([fold == f for f in range(k)], [p.margins[0] + p.offset[0] for p in parts], np.nan)
        left_out = pd.DataFrame({"label_idx": (target[pair] + 1) / 2, "margin": margin[pair]}).dropna()
        one = VectorAssembler(inputCols=["margin"], outputCol="m").transform(spark.createDataFrame(left_out, "label_idx double, margin double"))
        platt = LogisticRegression(featuresCol="m", labelCol="label_idx").fit(one.coalesce(max(1, len(left_out) // (20 * ROWS_PER_PARTITION))))
        machine = linear.svm_model(x.coefficients(whole.a, x.width)[0], whole.offset[0], spark)
        machines.append((a, b, machine, float(platt.coefficients[0]), float(platt.intercept)))
    x.close()
    return Pairwise(n_classes, machines)


def couple(r: np.ndarray) -> np.ndarray:
    """Class probabilities of each row from ``r[row, i, j]``, the probability of i against j."""
    n = r.shape[1]
    r = np.clip(r, 1e-7, 1 - 1e-7)
    q = -np.swapaxes(r, 1, 2) * r
    at = np.arange(n)
    squares = np.swapaxes(r, 1, 2) ** 2
    q[:, at, at] = squares.sum(2) - squares[:, at, at]
    system = np.zeros((len(r), n + 1, n + 1))
    system[:, :n, :n], system[:, :n, n], system[:, n, :n] = q, 1, 1
    right = np.zeros((len(r), n + 1, 1))
    right[:, n] = 1
    p = np.clip(np.linalg.solve(system, right)[:, :n, 0], 0, None) if len(r) else np.zeros((0, n))
    return p / p.sum(1, keepdims=True)


def probabilities(rows: DataFrame, model: Pairwise) -> DataFrame:
    """``rows`` (with ``features``) with ``probability``, an array in the order of the classes."""
    out, margins = rows, [f"_m{k}" for k in range(len(model.machines))]
    for name, (_, _, machine, _, _) in zip(margins, model.machines, strict=True):
        out = with_margin(machine, out, name)

    pairs, n = [(a, b, slope, offset) for a, b, _, slope, offset in model.machines], model.n_classes

    @F.pandas_udf("array<double>")
    def coupled(*columns: pd.Series) -> pd.Series:
        r = np.full((len(columns[0]), n, n), 0.5)
        for m, (a, b, slope, offset) in zip(columns, pairs, strict=True):
            p = 1 / (1 + np.exp(-np.clip(slope * m.to_numpy() + offset, -500, 500)))
            r[:, b, a], r[:, a, b] = p, 1 - p
        return pd.Series(list(couple(r)))

    return out.withColumn("probability", coupled(*margins)).drop(*margins)
