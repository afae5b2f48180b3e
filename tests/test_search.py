"""Folds, k-fold scores against refits from scratch, and the analyzer stage of saved pipelines."""
import math
import random
from collections import Counter

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.functions.text import ngrams
from tessera.operators import classify, search
from tessera.plans import models
from tessera.sources import files


def corpus(spark, n=60, seed=1):
    rng = random.Random(seed)
    words = {"a": ["sun", "sea", "sand", "the"], "b": ["snow", "ice", "the", "sea"], "c": ["the", "tree", "leaf"]}
    rows = [(i, lab, [rng.choice(words[lab]) for _ in range(rng.randrange(0, 7))] + ([f"rare{i}"] if i % 9 == 0 else []))
            for i in range(n) for lab in [rng.choice("aabc")]]
    return rows, spark.createDataFrame(rows, "doc_id long, label string, tokens array<string>")


def grams(tokens, hi):
    return [" ".join(tokens[i:i + n]) for n in range(1, hi + 1) for i in range(len(tokens) - n + 1)]


def refit(rows, alphas, hi, tfidf):
    """Every fold's model trained from scratch on the other folds."""
    out = {}
    for f in range(5):
        train, test = [r for r in rows if r[3] != f], [r for r in rows if r[3] == f]
        df = Counter(t for r in train for t in set(grams(r[2], hi)))
        idf = {t: math.log((1 + len(train)) / (1 + d)) + 1 if tfidf else 1.0 for t, d in df.items()}

        def row(tokens):
            w = {t: c * idf[t] for t, c in Counter(grams(tokens, hi)).items() if t in idf}
            norm = math.sqrt(sum(v * v for v in w.values())) if tfidf else 1.0
            return {t: v / norm for t, v in w.items()}
        prior, stats = Counter(r[1] for r in train), {}
        for r in train:
            for t, v in row(r[2]).items():
                stats.setdefault(r[1], Counter())[t] += v
        for a in alphas:
            hit = 0
            for r in test:
                x, best = row(r[2]), None
                for lab in sorted(prior):
                    own = stats.get(lab, Counter())
                    total = sum(own.values()) + a * len(df)
                    s = round(math.log(prior[lab] / len(train)) + sum(v * math.log((own[t] + a) / total) for t, v in x.items()), 6)
                    if best is None or s > best[0]:
                        best = s, lab
                hit += best[1] == r[1]
            out[a, f] = round(hit / len(test), 9)
    return out


def test_folds_are_stratified(spark):
    _, df = corpus(spark)
    sizes = {}
    for r in search.assign_folds(df.repartition(5)).groupBy("label", "fold").count().collect():
        sizes.setdefault(r.label, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 and len(v) == 5 for v in sizes.values())


def test_fold_scores_equal_refits(spark):
    _, df = corpus(spark)
    docs = search.assign_folds(df).withColumnRenamed("doc_id", "doc").cache()
    rows = [(r.doc, r.label, r.tokens, r.fold) for r in docs.collect()]
    labels, alphas = docs.select("doc", "label", "fold"), [0.1, 1.0]
    for hi in (1, 2):
        counts = search.postings(docs, F.col("tokens"), 1, hi)
        for tfidf, score in ((False, search.cv_naive_bayes), (True, search.cv_tfidf_naive_bayes)):
            got = {(r.alpha, r.fold): round(r.accuracy, 9) for r in score(counts, labels, alphas).collect()}
            assert got == refit(rows, alphas, hi, tfidf)


def test_linear_candidates_and_idf_of_the_fold(spark):
    _, df = corpus(spark, 40)
    docs = search.assign_folds(df.where("label <> 'c'"))
    some = [search.Candidate("svm", params=(("c", 1.0),)), search.Candidate("logreg", (1, 2), 1, 0.9, (("c", 10.0), ("penalty", "l1"))),
            search.Candidate("nb", (1, 1), 2, 1.0, (("alpha", 0.5),))]
    found = dict(search.cross_validate(docs, some))
    assert sorted(found) == [0, 1, 2] and all(0.5 < a <= 1 for a in found.values())
    own, sizes = {0: __import__("numpy").array([2.0, 0, 1]), 1: __import__("numpy").array([1.0, 1, 0])}, {0: 3, 1: 2}
    weights, n = search._weights(own, sizes, 0, search.Candidate("nb"))
    assert n == 2 and weights[2] == 0 and abs(weights[0] - (math.log(3 / 2) + 1)) < 1e-12
    assert models.best_of([("a", 0.5), ("b", 0.9), ("c", 0.9)]) == 1
    assert len(models.LR_GRID) == 24 and len(models.LR_SPACE) == 432 and len(models.SVM_GRID) == 8


def test_character_model_is_saved_with_its_analyzer(spark, tmp_path):
    """A 2- to 4-gram character model through load_or_train: the loaded pipeline takes raw texts."""
    rows = [(t, lab) for lab, ts in {"en": ["the house and the sea", "this and that", "where is  the\thill"],
                                     "de": ["das Haus und das Meer", "dies und das", "wo ist der Berg"]}.items() for t in ts * 3]
    df = spark.createDataFrame(rows, "text string, label string")
    path = str(tmp_path / "model")
    made = []

    def train():
        made.append(1)
        return classify.text_pipeline("nb", n_rows=len(rows), text_col="text", analyze="char", ngrams=(2, 4)).fit(df)
    for _ in range(2):
        model = files.load_or_train(spark, path, train)
        test = spark.createDataFrame([("the hill",), ("das Meer",), (None,), ("",)], "text string")
        got = [r.pred_label for r in classify.with_labels(model, model.transform(test)).collect()]
        assert got[:2] == ["en", "de"] and len(got) == 4
    assert made == [1] and isinstance(model, PipelineModel)
    assert {"th", "the", "the "} <= set(model.stages[2].vocabulary) and max(map(len, model.stages[2].vocabulary)) == 4


def test_word_analyzer_with_stop_words_and_ngrams(spark):
    df = spark.createDataFrame([("The cat sat on the mat",), (None,), ("x",)], "text string")
    stage = classify.analyzer("text", ngrams=(1, 2), stop_words=["the", "on", "don't"])
    assert [r.tokens for r in stage.transform(df).collect()] == [["cat", "sat", "mat", "cat sat", "sat mat"], [], []]
    t = spark.createDataFrame([(["a", "b", "c"],), ([],), (["a"],)], "t array<string>")
    assert [r[0] for r in t.select(ngrams(F.col("t"), 2, 3)).collect()] == [["a b", "b c", "a b c"], [], []]


def test_binary_terms(spark):
    rows = [("good fine sun", "1"), ("good nice sun", "1"), ("bad poor sun", "0"), ("bad sad sun", "0")] * 4
    model = classify.text_pipeline("logreg", n_rows=16, text_col="text").fit(spark.createDataFrame(rows, "text string, label string"))
    got = classify.binary_terms(model, 2)
    assert [g[:3] for g in got if g[1] == 1] == [("top", 1, "good"), ("bottom", 1, "bad")] and len(got) == 4
