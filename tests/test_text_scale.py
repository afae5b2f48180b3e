"""N-gram counts and term weights: results as by definition, no n-gram a row."""
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import tfidf
from tessera.plans import text as plans


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gram_counts_make_no_row_a_gram(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, []), (3, None), (4, ["x"]), (4, ["x"]), (None, ["y"])], "doc_id long, t array<string>")
    got = plans._gram_counts(docs, {1: lambda t: t, 2: lambda t: plans._ngrams(t, 2)}, "n_")
    assert plan(got).count("Generate") == 1
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 4, 3, 4), (2, 0, 0, 0), (3, 0, 0, 0), (4, 2, 0, 1), (4, 2, 0, 1), (None, 0, 0, 0)], key=str)


@pytest.mark.parametrize("most", [0, 100])
def test_weights_with_and_without_broadcast(spark, most):
    docs = spark.createDataFrame([(1, "cat dog"), (2, "cat"), (3, ""), (None, "cat")], "doc long, text string").repartition("doc")
    counts = tfidf.term_counts(docs, "doc", X.word_tokens("text"))
    got = {(r.doc, r.term): r.weight for r in tfidf.tfidf(counts, n_docs=F.lit(4), broadcast_terms=most).collect()}
    a, b = math.log(5 / 4) + 1, math.log(5 / 2) + 1
    assert got == pytest.approx({(1, "cat"): a / math.hypot(a, b), (1, "dog"): b / math.hypot(a, b), (2, "cat"): 1.0})
