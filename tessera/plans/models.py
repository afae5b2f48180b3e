"""Iterative model jobs (MLlib and DataFrame iterations). Their fits are not
SQL-expressible, so these queries carry no oracle and are checked by row counts
and by invariant tests."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import AB_GROUPS
from ..functions.scalar import md5_bucket, pick_by_index
from ..functions.scalar import round_half_away as rnd
from ..operators import classify, factor, profile, recommend, search, splits, svm
from ..session import materialize
from ..sources.tables import Tables, catalog, interactions, ratings
from . import register
from .evaluation import LANG_SRC, QUALITY_SRC, TEST_FRACTION, _source, nb_predictions, nb_sql
from .ratings import _split


# ------------------------------------------------------------- classifiers

def _labelled(spark, sf, task: str = "lang"):
    """Tokens and split, written once: every stage of a fit and every scoring reads them."""
    src = _source(spark, sf, task).select("doc_id", "label", X.word_tokens("text").alias("tokens"))
    return materialize(splits.stratified_split(src, "label", "doc_id", TEST_FRACTION), "labelled")


def _fit(train, *kinds: str):
    """A fitted pipeline for each kind of classifier; the stages before it are fitted once and the
    features written once. Linear models are fitted together (``linear.fit``), the others by MLlib."""
    from pyspark.ml import Pipeline, PipelineModel
    prepare = Pipeline(stages=classify.text_pipeline(kinds[0]).getStages()[:-1]).fit(train)
    rows = materialize(prepare.transform(train).select("label_idx", "features").withColumn("_id", F.monotonically_increasing_id()), "features")
    n_labels = len(prepare.stages[0].labels)
    found = classify.fit_linear(rows, [k for k in kinds if k in ("logreg", "svm")], n_labels) if n_labels > 1 else {}
    if set(kinds) - set(found):
        rows, n = search.few_partitions(rows)
        rows = rows.persist()
        found |= {k: classify.classifier(k, n_rows=n).fit(rows) for k in kinds if k not in found}
        rows.unpersist()
    return [PipelineModel([*prepare.stages, found[k]]) for k in kinds]


def _evaluate(model, test):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    pred = model.transform(test)
    acc = MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy").evaluate(pred)
    f1 = MulticlassClassificationEvaluator(labelCol="label_idx", metricName="weightedFMeasure").evaluate(pred)
    return acc, f1


def best_of(rows: list[tuple[str, float]]) -> int:
    """The number of the first candidate with the highest value."""
    return max(range(len(rows)), key=lambda i: (rows[i][1], -i))


@register("classifier_comparison")
def classifier_comparison(spark, sf, save_to: str | None = None):
    """Fit logistic regression, naive Bayes and a linear SVM on the same split;
    report accuracy and weighted F1. The first best model wins, and is saved to ``save_to``."""
    data = _labelled(spark, sf)
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    kinds = ("logreg", "nb", "svm")
    models = _fit(train, *kinds)
    rows = [(kind, *map(float, _evaluate(model, test))) for kind, model in zip(kinds, models, strict=True)]
    best = best_of([(r[0], r[1]) for r in rows])
    if save_to:
        models[best].write().overwrite().save(save_to)
    df = spark.createDataFrame([(*r, i == best) for i, r in enumerate(rows)], "model string, accuracy double, weighted_f1 double, best boolean")
    return df.select("model", rnd("accuracy", 6).alias("accuracy"), rnd("weighted_f1", 6).alias("weighted_f1"), "best")


def _training(spark, sf, task: str):
    """(doc_id, label, tokens, fold) of the training part of a task."""
    data = _labelled(spark, sf, task).where(~F.col("is_test")).drop("is_test")
    return materialize(search.assign_folds(materialize(data, "search-data")), "search-train")


# FIXED VALUES: the grids that are searched
LR_GRID = [search.Candidate("logreg", grams, 1, max_df, (("c", c), ("solver", solver)))
           for max_df in (0.85, 1.0) for grams in ((1, 1), (1, 2)) for c in (0.1, 1.0, 10.0) for solver in ("liblinear", "lbfgs")]
LR_SPACE = [search.Candidate("logreg", grams, min_df, max_df, (("c", c), ("penalty", penalty), ("solver", "liblinear")))
            for max_df in (0.75, 0.85, 0.9, 1.0) for min_df in (1, 2, 3) for grams in ((1, 1), (1, 2), (1, 3))
            for c in (0.001, 0.01, 0.1, 1.0, 10.0, 100.0) for penalty in ("l1", "l2")]
SVM_GRID = [search.Candidate("svm", grams, params=(("c", c),)) for grams in ((1, 1), (1, 2)) for c in (0.01, 0.1, 1.0, 10.0)]
NB_ALPHAS, NB_GRAMS = [0.1, 0.5, 1.0, 2.0], ((1, 1), (1, 2))


def _searched(spark, sf, candidates, task: str = "quality"):
    found = search.cross_validate(_training(spark, sf, task), candidates)
    best = best_of([(str(i), a) for i, a in found])
    rows = [(i, candidates[i].describe(), float(a), j == best) for j, (i, a) in enumerate(found)]
    df = spark.createDataFrame(rows, "candidate long, params string, mean_accuracy double, best boolean")
    return df.select("candidate", "params", rnd("mean_accuracy", 6).alias("mean_accuracy"), "best")


@register("grid_search")
def grid_search(spark, sf, candidates: list[search.Candidate] | None = None):
    """M8: settings of vectoriser and logistic regression, 5 stratified folds; by default all of ``LR_GRID``."""
    return _searched(spark, sf, candidates or LR_GRID)


@register("random_search")
def random_search(spark, sf, draws: int = 20, seed: int = 42):
    """M9: seeded draws without replacement from ``LR_SPACE``, 5 stratified folds; 20 by default."""
    return _searched(spark, sf, random.Random(seed).sample(LR_SPACE, draws))


@register("svm_grid")
def svm_grid(spark, sf, candidates: list[search.Candidate] | None = None):
    """M8 for the linear SVM, 5 stratified folds; by default all of ``SVM_GRID``."""
    return _searched(spark, sf, candidates or SVM_GRID)


def _fold_sql(src: str) -> str:
    return f"""
lab AS ({src}),
docs AS (SELECT doc_id, label, text, (row_number() OVER (PARTITION BY label ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS fold
         FROM lab),
folds AS (SELECT unnest(range(5)) AS m),
tok AS (SELECT doc_id, {X.word_tokens_sql('text')} AS t FROM docs)"""


def _grams_cte(hi: int) -> str:
    grams = " || ".join("t" if n == 1 else f"list_transform(range(1, len(t) - {n - 2}), lambda i: array_to_string(t[i:i + {n - 1}], ' '))"
                        for n in range(1, hi + 1))
    return f"""
tf AS (SELECT doc_id, label, fold, term, count(*) AS tf FROM (SELECT doc_id, unnest({grams}) AS term FROM tok) JOIN docs USING (doc_id)
       GROUP BY ALL)"""


def _cv_score_sql(x: str, s: str, alphas: list[float]) -> str:
    """Folds' accuracies from ``x`` (doc_id, m, term, x) of test documents and ``s`` (m, label, term, s)."""
    return f"""
v AS (SELECT m, count(DISTINCT term) AS v FROM {s} GROUP BY m),
tot AS (SELECT m, label, sum(s) AS total FROM {s} GROUP BY m, label),
pri AS (SELECT m, label, ln(count(*) / any_value((SELECT count(*) FROM docs) - own)) AS log_prior FROM docs d
        JOIN (SELECT m, count(*) AS own FROM folds JOIN docs ON fold = m GROUP BY m) f ON d.fold <> f.m GROUP BY m, label),
xs AS (SELECT doc_id, sum(x) AS x_sum FROM {x} GROUP BY doc_id),
al AS (SELECT unnest({alphas}) AS alpha),
adj AS (SELECT x.doc_id, s.label, al.alpha, sum(x.x * (ln(s.s + al.alpha) - ln(al.alpha))) AS adj
        FROM {x} x JOIN {s} s USING (m, term) CROSS JOIN al GROUP BY ALL),
jll AS (SELECT d.doc_id, d.fold, d.label AS truth, p.label, al.alpha, round(log_prior
          + coalesce(x_sum, 0) * (ln(al.alpha) - ln(coalesce(total, 0) + al.alpha * v)) + coalesce(adj, 0.0), 6) AS jll
        FROM docs d JOIN pri p ON p.m = d.fold JOIN v ON v.m = d.fold CROSS JOIN al LEFT JOIN tot ON tot.m = p.m AND tot.label = p.label
        LEFT JOIN xs USING (doc_id) LEFT JOIN adj ON adj.doc_id = d.doc_id AND adj.label = p.label AND adj.alpha = al.alpha),
hit AS (SELECT doc_id, fold, alpha, arg_min(label, (-jll, label)) = any_value(truth) AS hit FROM jll GROUP BY ALL),
acc AS (SELECT alpha, fold, avg(hit::INT) AS accuracy FROM hit GROUP BY alpha, fold)"""


@register("cv_naive_bayes", f"""
WITH {_fold_sql(LANG_SRC)}, {_grams_cte(1)},
own AS (SELECT label, term, fold, sum(tf) AS c FROM tf GROUP BY ALL),
st AS (SELECT m, label, term, sum(c) AS s FROM own JOIN folds ON fold <> m GROUP BY ALL),
x AS (SELECT doc_id, fold AS m, term, tf AS x FROM tf WHERE (fold, term) IN (SELECT (m, term) FROM st)),
{_cv_score_sql('x', 'st', NB_ALPHAS)}
SELECT alpha, fold, round(accuracy, 6) AS accuracy FROM acc""")
def cv_naive_bayes(spark, sf):
    """Five-fold scores of naive Bayes on term counts, each fold's model being total minus fold."""
    src = _source(spark, sf, "lang").select("doc_id", "label", X.word_tokens("text").alias("tokens"))
    docs = search.assign_folds(materialize(src, "cv-docs")).withColumnRenamed("doc_id", "doc")
    counts = materialize(search.postings(docs, F.col("tokens")), "cv-postings")
    out = search.cv_naive_bayes(counts, materialize(docs.select("doc", "label", "fold"), "cv-labels"), NB_ALPHAS)
    return out.select("alpha", F.col("fold").cast("bigint").alias("fold"), rnd("accuracy", 6).alias("accuracy"))


def _nb_grid_part(hi: int) -> str:
    return f"""
SELECT * FROM (WITH {_grams_cte(hi)},
df AS (SELECT m, term, count(*) AS df FROM tf JOIN folds ON fold <> m GROUP BY m, term),
nd AS (SELECT m, count(*) AS n FROM docs JOIN folds ON fold <> m GROUP BY m),
w0 AS (SELECT doc_id, label, fold, m, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM tf JOIN df USING (term) JOIN nd USING (m)),
w AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, m)) AS x FROM w0),
st AS (SELECT m, label, term, sum(x) AS s FROM w WHERE fold <> m GROUP BY ALL),
x AS (SELECT doc_id, m, term, x FROM w WHERE fold = m),
{_cv_score_sql('x', 'st', NB_ALPHAS)}
SELECT '1-{hi}' AS ngrams, alpha, avg(accuracy) AS a FROM acc GROUP BY alpha)"""


@register("nb_grid", f"""
WITH {_fold_sql(QUALITY_SRC)},
every AS ({" UNION ALL ".join(_nb_grid_part(hi) for _, hi in NB_GRAMS)})
SELECT ngrams, alpha, round(a, 6) AS mean_accuracy, row_number() OVER (ORDER BY round(a, 6) DESC, ngrams, alpha) AS rank FROM every""")
def nb_grid(spark, sf):
    """M8 for naive Bayes: n-gram ranges × smoothings, document frequencies per training fold."""
    src = _source(spark, sf, "quality").select("doc_id", "label", X.word_tokens("text").alias("tokens"))
    docs = materialize(search.assign_folds(materialize(src, "grid-docs")).withColumnRenamed("doc_id", "doc"), "grid-folds")
    labels, parts = docs.select("doc", "label", "fold"), []
    for lo, hi in NB_GRAMS:
        counts = materialize(search.postings(docs, F.col("tokens"), lo, hi), "grid-postings")
        part = search.cv_tfidf_naive_bayes(counts, labels, NB_ALPHAS)
        parts.append(part.groupBy("alpha").agg(rnd(F.avg("accuracy"), 6).alias("mean_accuracy"))
                     .select(F.lit(f"{lo}-{hi}").alias("ngrams"), "alpha", "mean_accuracy"))
    every = materialize(parts[0].unionByName(parts[1]), "grid-scores")
    rank = F.row_number().over(Window.orderBy(F.desc("mean_accuracy"), "ngrams", "alpha"))  # one row a candidate
    return every.withColumn("rank", rank.cast("bigint"))


@register("batch_predictions")
def batch_predictions(spark, sf):
    """Label and confidence % (max class probability × 100) for every input row."""
    from pyspark.ml.functions import vector_to_array
    data = _labelled(spark, sf)
    model, = _fit(data.where(~F.col("is_test")), "logreg")
    pred = classify.with_labels(model, model.transform(data))
    return pred.select("doc_id", F.col("pred_label").alias("prediction"),
                       rnd(F.array_max(vector_to_array("probability")) * 100, 4).alias("confidence"))


@register("class_probabilities", f"""
WITH {nb_sql(LANG_SRC, "")}
SELECT doc_id, label, round(prob, 6) AS probability FROM probs""")
def class_probabilities(spark, sf):
    """Every class of every input row with its naive-Bayes probability, one row each."""
    return nb_predictions(spark, sf, every_row=True).select("doc_id", "label", rnd("prob", 6).alias("probability"))


@register("top_terms_per_class")
def top_terms_per_class(spark, sf, k: int = 10):
    """The k terms with the largest coefficients per class of a logistic model."""
    data = _labelled(spark, sf)
    model, = _fit(data.where(~F.col("is_test")), "logreg")
    vocab = model.stages[1].vocabulary
    labels = model.stages[0].labels
    coef = model.stages[-1].coefficientMatrix.toArray()
    if coef.shape[0] == 1:   # binary: class 0 ranks by the negated row
        coef = [-coef[0], coef[0]]
    rows = []
    for label, weights in zip(labels, coef):  # the model's own vectors: only k terms a class leave them
        first = sorted(np.argsort(-weights, kind="stable")[:k].tolist(), key=lambda j: (-weights[j], vocab[j]))
        rows += [(label, rank + 1, vocab[j], float(weights[j])) for rank, j in enumerate(first)]
    df = spark.createDataFrame(rows, "label string, rank long, term string, coefficient double")
    return df.select("label", "rank", "term", rnd("coefficient", 6).alias("coefficient"))


@register("binary_terms")
def binary_terms_q(spark, sf, n: int = 20):
    """The 20 terms with the largest and the smallest coefficients of a binary logistic model."""
    data = _labelled(spark, sf, "quality")
    model, = _fit(data.where(~F.col("is_test")), "logreg")
    df = spark.createDataFrame(classify.binary_terms(model, n), "side string, rank long, term string, coefficient double")
    return df.select("side", "rank", "term", rnd("coefficient", 6).alias("coefficient"))


@register("svm_platt")
def svm_platt(spark, sf, task: str = "quality"):
    """M3: probabilities of a linear SVM, fitted on margins of rows that each fold left out."""
    from pyspark.ml import Pipeline
    data = _labelled(spark, sf, task)
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    prepare = Pipeline(stages=classify.text_pipeline("svm", n_rows=1).getStages()[:-1]).fit(train)
    folded = search.assign_folds(prepare.transform(train).select("doc_id", "label", "label_idx", "features"))
    model = svm.fit_pairwise(folded, len(prepare.stages[0].labels))
    out = svm.probabilities(prepare.transform(test).select("doc_id", "features"), model)
    best = F.array_position("probability", F.array_max("probability")).cast("int") - 1
    return out.select("doc_id", best.alias("prediction"), rnd(F.get(F.col("probability"), F.lit(1)), 6).alias("p_positive"))


@register("random_forest")
def random_forest(spark, sf):
    """M5: 200-tree random forest (depth 30, sqrt features) on the quality task."""
    data = _labelled(spark, sf, "quality")
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    model, = _fit(train, "forest")
    acc, f1 = _evaluate(model, test)
    return spark.createDataFrame([("random_forest", float(acc), float(f1))],
                                 "model string, accuracy double, weighted_f1 double")


# ------------------------------------------------------------- recommenders

@register("als_predict")
def als_predict(spark, sf):
    """Biases + ALS on residuals, scored on the held-out rating rows (clipped 1..5)."""
    r = materialize(_split(ratings(Tables(spark, sf).orders, Tables(spark, sf).lineitem)).drop("ts"), "als-ratings")
    train, test = r.where(~F.col("is_test")), r.where(F.col("is_test"))
    predict = factor.als_on_residuals(train.select("user_id", "item_id", "rating"))
    return predict(test.select("rid", "user_id", "item_id", "rating")).select(
        "rid", "user_id", "item_id", "rating", rnd("est", 6).alias("est"))


def _engine(spark, sf, inter, ref=None, iterations: int = 10):
    t = Tables(spark, sf)
    cat = catalog(t.part)
    prof = materialize(profile.user_item_scores(inter, ref=ref, catalog=cat).select("user_id", "item_id", "score"), "engine-profile")
    n_users = prof.select(F.count_distinct("user_id")).first()[0]
    n_items = cat.count()
    w, h = factor.nmf(prof.select("user_id", "item_id", F.col("score").alias("x")),
                      n_users, n_items, k=8, iterations=iterations)
    return cat, prof, w, h


@register("nmf_factors")
def nmf_factors(spark, sf):
    """User and item factor rows of the decayed-engagement matrix."""
    _, _, w, h = _engine(spark, sf, interactions(Tables(spark, sf).events))
    return (w.select(F.lit("user").alias("side"), "id", "f")
            .unionByName(h.select(F.lit("item").alias("side"), "id", "f"))
            .select("side", "id", F.transform("f", lambda v: rnd(v, 6)).alias("factors")))


def hybrid_feed(spark, sf, inter, strategy: str, alpha: float, n: int = 5, ref=None, users=None, engine=None):
    """R9 for one strategy; ``engine`` = (catalogue, profile, W, H) can be shared across calls."""
    cat, prof, w, h = engine or _engine(spark, sf, inter, ref)
    users = materialize((inter if users is None else users).select("user_id").distinct(), "feed-users")
    seen, items = prof.select("user_id", "item_id"), cat.select("item_id")
    if strategy not in ("content", "collaborative", "hybrid"):
        raise ValueError(f"Unknown strategy: {strategy}")
    if strategy != "content":
        latent = factor.latent_scores(w.join(users.withColumnRenamed("user_id", "id"), "id", "left_semi"), h)
        latent = materialize(latent, "feed-latent")  # read several times
    if strategy == "collaborative":
        return recommend.blend_feed([(latent, 1.0)], items, seen, users, n)
    features = materialize(recommend.content_features(cat), "feed-features")
    set_items, sets = recommend.feature_sets(features)
    scores = recommend.set_scores(prof, features, sets)
    if strategy == "content":
        return recommend.rank_sets(scores, set_items, items, seen, users, n)
    return recommend.blend_sets(scores, set_items, latent, alpha, items, seen, users, n)


@register("feed_hybrid")
def feed_hybrid(spark, sf):
    """``0.5·norm(content) + 0.5·norm(NMF scores)`` top-5 feed per user."""
    inter = interactions(Tables(spark, sf).events)
    return hybrid_feed(spark, sf, inter, "hybrid", 0.5).select(
        "user_id", "item_id", rnd("value", 4).alias("score"), "rank")


@register("ab_eval")
def ab_eval(spark, sf, n: int = 5):
    """Offline A/B test — each user's group picks the strategy; precision =
    hits / n, recall = hits / distinct held-out items; mean per group."""
    inter = interactions(Tables(spark, sf).events)
    train, test = splits.time_split(inter, 0.2)
    ref = profile.reference_time(train)
    relevant = test.select("user_id", "item_id").distinct()
    names = [g for g, _, _ in AB_GROUPS]
    users = (train.select("user_id").distinct().join(relevant.select("user_id").distinct(), "user_id")
             .withColumn("group_name", pick_by_index(names, md5_bucket("user_id", len(names)))))
    engine = _engine(spark, sf, train, ref)
    per_group = []
    for g, strategy, alpha in AB_GROUPS:
        ug = users.where(F.col("group_name") == g).select("user_id")
        feed = hybrid_feed(spark, sf, train, strategy, alpha, n=n, ref=ref, users=ug, engine=engine)
        per_group.append(feed.select("user_id", "item_id").withColumn("strategy", F.lit(strategy)))
    feeds = per_group[0]
    for f in per_group[1:]:
        feeds = feeds.unionByName(f)
    hits = feeds.join(relevant, ["user_id", "item_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))
    n_rel = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    strat = {g: s for g, s, _ in AB_GROUPS}
    per_user = (users.join(n_rel, "user_id").join(hits, "user_id", "left").fillna(0, ["hits"])
                .withColumn("strategy", F.create_map(*[F.lit(x) for kv in strat.items() for x in kv])[F.col("group_name")]))
    return (per_user.groupBy("group_name", "strategy")
            .agg(F.count(F.lit(1)).alias("n_users"),
                 rnd(F.avg(F.col("hits") / F.lit(float(n))), 6).alias("avg_precision_at_k"),
                 rnd(F.avg(F.col("hits") / F.col("n_relevant")), 6).alias("avg_recall_at_k")))
