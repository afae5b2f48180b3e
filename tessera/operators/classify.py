"""Text classifiers: closed-form multinomial naive Bayes on long-form counts, and
MLlib pipelines (TF-IDF + logistic regression / naive Bayes / linear SVM).

The closed-form model is a handful of grouped aggregates and joins, so it is
checkable against SQL; the MLlib jobs are used where iterative fitting is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize


def fit_naive_bayes(train_counts: DataFrame, train_docs: DataFrame, alpha: float = 1.0) -> dict:
    """M2 fit. ``train_counts``: ``(doc, label, term, tf)``; ``train_docs``: ``(doc, label)``.

    Returns small frames: class priors ``(label, log_prior, base)`` where
    ``base = log(alpha / (total_c + alpha |V|))`` is the log-probability of a
    term never seen with the class, and the sparse ``(label, term, gain)`` with
    ``gain = log(count + alpha) - log(alpha)`` for seen (class, term) pairs.
    """
    docs = train_docs.select("doc", "label")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    ct = materialize(train_counts.groupBy("label", "term").agg(F.sum("tf").alias("count")), "nb-counts")  # read three times
    vocab = ct.select(F.count_distinct("term")).scalar()
    tot = ct.groupBy("label").agg(F.sum("count").alias("total"))
    prior = docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_c"))
    classes = (prior.join(tot, "label", "left").fillna(0, ["total"])
               .select("label", F.log(F.col("n_c") / n_docs).alias("log_prior"),
                       F.log(F.lit(alpha) / (F.col("total") + F.lit(alpha) * vocab)).alias("base")))
    gain = ct.select("label", "term", (F.log(F.col("count") + F.lit(alpha)) - F.log(F.lit(alpha))).alias("gain"))
    vocab_terms = ct.select("term").distinct()
    return {"classes": classes, "gain": gain, "vocab": vocab_terms}


def predict_naive_bayes(model: dict, counts: DataFrame, docs: DataFrame) -> DataFrame:
    """M2 scoring: joint log-likelihood per (doc, class), argmax and softmax.

    ``counts``: ``(doc, term, tf)``; ``docs``: every doc to score (docs without
    known terms get the prior). Each document is paired with every class by
    exploding the class list (a scalar subquery), not by a cross join.
    Returns ``(doc, label, jll, prob, pred, pred_rank)``: one row per class.
    """
    known = counts.join(model["vocab"], "term", "left_semi")
    n_in = known.groupBy("doc").agg(F.sum("tf").alias("n_in"))
    class_list = model["classes"].select(F.sort_array(F.collect_list("label"))).scalar()
    pairs = (docs.select("doc").distinct().join(n_in, "doc", "left").fillna(0, ["n_in"])
             .select("doc", "n_in", F.explode(class_list).alias("label"))
             .join(model["classes"], "label"))
    adj = (known.join(model["gain"], "term")
           .groupBy("doc", "label").agg(F.sum(F.col("tf") * F.col("gain")).alias("adj")))
    jll = (pairs.join(adj, ["doc", "label"], "left")
           .select("doc", "label", (F.col("log_prior") + F.col("n_in") * F.col("base")
                                    + F.coalesce(F.col("adj"), F.lit(0.0))).alias("jll")))
    return add_softmax(jll, "doc", "label", "jll")


def add_softmax(df: DataFrame, key: str, label: str, score: str) -> DataFrame:
    """Per-key softmax of ``score`` → ``prob``; ``pred`` = argmax (first label on ties)."""
    from pyspark.sql import Window
    w = Window.partitionBy(key)
    mx = F.max(score).over(w)
    e = F.exp(F.col(score) - mx)
    out = df.withColumn("_e", e).withColumn("prob", F.col("_e") / F.sum("_e").over(w)).drop("_e")
    first = w.orderBy(F.desc(score), F.asc(label))
    return (out.withColumn("pred_rank", F.row_number().over(first).cast("bigint"))
            .withColumn("pred", F.first(label).over(first)))


def doc_term_counts(docs: DataFrame, doc: str, tokens: Column, label: str | None = None) -> DataFrame:
    keys = [F.col(doc).alias("doc")] + ([F.col(label).alias("label")] if label else [])
    cols = ["doc"] + (["label"] if label else [])
    return (docs.select(*keys, F.explode(tokens).alias("term"))
            .groupBy(*cols, "term").agg(F.count(F.lit(1)).alias("tf")))


# ------------------------------------------------------------------ MLlib jobs

#: CountVectorizer's largest vocabulary: no term is left out unless a caller asks for a cap.
ALL_TERMS = (1 << 31) - 1


def shifted_idf(input_col: str = "tf", output_col: str = "tfidf"):
    """An estimator of term weights ``tf * (idf + 1)``.

    Spark's ``IDF`` computes ``ln((n + 1) / (df + 1))`` without the ``+ 1`` of the smoothed
    formula (a term in every document would get weight 0), so its fitted vector, plus
    one, becomes an ``ElementwiseProduct``. As an estimator it can stand in a pipeline
    under ``CrossValidator``, and its fitted stage is saved like any other.
    """
    from pyspark import keyword_only
    from pyspark.ml import Estimator
    from pyspark.ml.feature import IDF, ElementwiseProduct
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.param.shared import HasInputCol, HasOutputCol

    class ShiftedIDF(Estimator, HasInputCol, HasOutputCol):
        @keyword_only
        def __init__(self, *, inputCol=None, outputCol=None):
            super().__init__()
            self._set(**self._input_kwargs)

        def _fit(self, df):
            idf = IDF(inputCol=self.getInputCol(), outputCol="_idf").fit(df).idf
            return ElementwiseProduct(scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol=self.getInputCol(),
                                      outputCol=self.getOutputCol())

    return ShiftedIDF(inputCol=input_col, outputCol=output_col)


#: The original's limit for logistic regression; fits end earlier, when the loss no longer falls by
#: ``TOLERANCE``. The hinge loss of the SVM hardly meets a tolerance, so its limit is what it takes.
MAX_ITER, SVM_ITER, TOLERANCE = 1000, 100, 1e-4


def classifier(kind: str, n_rows: int | None = None, c: float = 1.0, alpha: float = 1.0, penalty: str = "l2",
               solver: str = "lbfgs", max_iter: int | None = None, tol: float = TOLERANCE, seed: int = 42, binary: bool = False):
    """M1/M2/M4/M5 estimators on ``features``/``label_idx``.

    Logistic regression and linear SVM map ``C`` to ``regParam = 1 / (C n)``
    without standardisation: a penalty ``||w||^2 / 2C`` (or ``|w| / C`` for ``l1``) over a
    summed loss. ``solver="liblinear"`` fits one class against the rest, as that solver does;
    with ``binary`` labels that is one model, not two.
    """
    from pyspark.ml.classification import (LinearSVC, LogisticRegression, NaiveBayes, OneVsRest,
                                           RandomForestClassifier)
    reg = 1.0 / (c * n_rows) if n_rows else 0.0
    if kind == "logreg":
        lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter or MAX_ITER, tol=tol, regParam=reg,
                                elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False)
        return lr if binary or solver == "lbfgs" else OneVsRest(classifier=lr, featuresCol="features", labelCol="label_idx")
    if kind == "nb":
        return NaiveBayes(featuresCol="features", labelCol="label_idx", smoothing=alpha, modelType="multinomial")
    if kind == "svm":
        svm = LinearSVC(featuresCol="features", labelCol="label_idx", maxIter=max_iter or SVM_ITER, tol=tol, regParam=reg,
                        standardization=False)
        return svm if binary else OneVsRest(classifier=svm, featuresCol="features", labelCol="label_idx", parallelism=4)
    if kind == "forest":
        return RandomForestClassifier(featuresCol="features", labelCol="label_idx", numTrees=200,
                                      maxDepth=30, featureSubsetStrategy="sqrt", seed=seed)
    raise ValueError(f"unknown classifier {kind}")


def fit_linear(rows: DataFrame, kinds: list[str], n_labels: int) -> dict:
    """The models that ``classifier`` would fit on ``rows`` (label_idx, features) of two labels or more for "logreg" and
    "svm": the same losses and penalties, fitted together by ``linear.fit``."""
    import numpy as np
    from pyspark.ml.classification import OneVsRestModel

    from . import linear
    if not kinds:
        return {}
    x, spark = linear.Rows(rows, "label_idx"), rows.sparkSession
    label = x.about["label_idx"].to_numpy()
    every, reg = np.ones(len(label), bool), 1.0 / max(1, len(label))
    against = lambda loss, k: linear.Problem(loss, np.where(label == k, 1.0, -1.0), every, reg)
    fits = {}
    if "logreg" in kinds:
        fits["logreg"] = [against("logistic", 1) if n_labels == 2 else linear.Problem("softmax", label.astype(int), every, reg, n_labels)]
    if "svm" in kinds:
        fits["svm"] = [against("hinge", k) for k in range(n_labels)]
    linear.fit(x, [p for ps in fits.values() for p in ps])
    found = {}
    for kind, problems in fits.items():
        if kind == "logreg":
            found[kind] = linear.logistic_model(x.coefficients(problems[0].a, x.width), problems[0].offset, spark)
        else:
            machines = [linear.svm_model(x.coefficients(p.a, x.width)[0], p.offset[0], spark) for p in problems]
            found[kind] = OneVsRestModel(models=machines)._set(featuresCol="features", labelCol="label_idx",
                                                               classifier=classifier("svm", n_rows=len(label), binary=True))
    x.close()
    return found


def analyzer(text_col: str, tokens_col: str = "tokens", kind: str = "word", ngrams: tuple[int, int] = (1, 1),
             stop_words: list[str] | None = None):
    """A stage that makes a text's terms: lower-cased words, without ``stop_words``, or characters
    (white-space runs become one space), as n-grams of a range of lengths. It is an SQL
    statement, so it is saved and loaded with its pipeline and needs no Python."""
    from pyspark.ml.feature import SQLTransformer
    low = f"lower(coalesce({text_col}, ''))"
    if kind == "char":
        base = f"regexp_replace({low}, '{X.RE_WS_RUN.replace(chr(92), chr(92) * 2)}', ' ')"
        grams = X.char_ngrams_sql_expr("x", *ngrams)
    else:
        base = f"regexp_extract_all({low}, '{X.RE_WORD2.replace(chr(92), chr(92) * 2)}', 0)"
        if stop_words:
            quoted = ", ".join("'" + w.replace("'", chr(92) + "'") + "'" for w in stop_words)
            base = f"filter({base}, w -> w NOT IN ({quoted}))"
        grams = X.ngrams_sql_expr("x", *ngrams)
    return SQLTransformer(statement=f"SELECT *, transform(array({base}), x -> {grams})[0] AS {tokens_col} FROM __THIS__")


def text_pipeline(kind: str, tokens_col: str = "tokens", label_col: str = "label", n_rows: int | None = None,
                  vocab_size: int = ALL_TERMS, min_df: float = 1.0, max_df: float | None = None, text_col: str | None = None,
                  analyze: str = "word", ngrams: tuple[int, int] = (1, 1), stop_words: list[str] | None = None, **kw):
    """M6: StringIndexer → (analyzer) → CountVectorizer → ×(idf + 1) → L2 Normalizer → classifier.

    A plain ``Pipeline`` so it can go into ``CrossValidator``. With ``text_col`` the terms are made
    from the text by a stage of the pipeline (X3–X5), otherwise ``tokens_col`` holds them.
    ``max_df`` is a fraction; leave it unset for 1.0, since Spark reads values >= 1 as counts.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizer, Normalizer, StringIndexer
    idx = StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="alphabetAsc")
    cv = CountVectorizer(inputCol=tokens_col, outputCol="tf", vocabSize=vocab_size, minDF=min_df)
    if max_df is not None:
        cv.setMaxDF(max_df)
    norm = Normalizer(inputCol="tfidf", outputCol="features", p=2.0)
    est = classifier(kind, n_rows=n_rows, **kw)
    made = [analyzer(text_col, tokens_col, analyze, ngrams, stop_words)] if text_col else []
    return Pipeline(stages=[idx, *made, cv, shifted_idf(), norm, est])


def with_labels(model, predictions: DataFrame) -> DataFrame:
    """Map predicted indices back to label strings."""
    from pyspark.ml.feature import IndexToString
    labels = model.stages[0].labels
    return IndexToString(inputCol="prediction", outputCol="pred_label", labels=labels).transform(predictions)


def binary_terms(model, n: int = 20) -> list[tuple[str, int, str, float]]:
    """(side, rank, term, coefficient) of the ``n`` terms that speak most for and against the second
    label of a fitted binary text pipeline; ties go by term."""
    import numpy as np
    vocabulary = next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))
    coefficient = np.asarray(model.stages[-1].coefficients.toArray())
    out = []
    for side, sign in (("top", -1.0), ("bottom", 1.0)):
        # the n-th value is found without a sort; all that tie with it are ordered by term
        k = min(n, len(coefficient))
        edge = np.partition(sign * coefficient, k - 1)[k - 1] if k else 0.0
        some = sorted(np.flatnonzero(sign * coefficient <= edge).tolist(), key=lambda j: (sign * coefficient[j], vocabulary[j]))[:n]
        out += [(side, r + 1, vocabulary[j], float(coefficient[j])) for r, j in enumerate(some)]
    return out
