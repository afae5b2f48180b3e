"""Classification evaluation queries on deterministic naive-Bayes predictions.

Two tasks from the test tables: language (4 classes, ``documents.lang``) and
quality (binary, ``documents ⋈ labels``). Both use a stratified md5-ordered
75/25 split and the closed-form multinomial naive Bayes, so every metric below
is checkable in SQL.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import POSITIVE_LABEL_NAMES
from ..functions.scalar import round_half_away as rnd
from ..operators import classify, splits
from ..operators.ranking import running_sums
from ..session import materialize
from ..sources.tables import Tables
from . import register

TEST_FRACTION = 0.25
LANG_SRC = "SELECT doc_id, text, lang AS label FROM documents"
QUALITY_SRC = ("SELECT d.doc_id, d.text, CAST(l.quality AS VARCHAR) AS label "
               "FROM documents d JOIN labels l USING (doc_id)")


def nb_sql(src: str, scored: str = "WHERE is_test") -> str:
    """CTEs: split, cls, probs(doc_id, truth, label, prob), pred(doc_id, truth, pred, prob)."""
    return f"""
src AS ({src}),
sp AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
              count(*) OVER (PARTITION BY label) AS n FROM src),
split AS (SELECT doc_id, label, rn <= ceil(n * {TEST_FRACTION}) AS is_test FROM sp),
tc AS (SELECT doc_id, term, count(*) AS tf FROM (
         SELECT doc_id, unnest({X.word_tokens_sql('text')}) AS term FROM src) GROUP BY doc_id, term),
train AS (SELECT tc.doc_id, s.label, tc.term, tc.tf FROM tc JOIN split s USING (doc_id) WHERE NOT s.is_test),
ct AS (SELECT label, term, sum(tf) AS cnt FROM train GROUP BY label, term),
vsz AS (SELECT count(DISTINCT term) AS v FROM train),
tot AS (SELECT label, sum(cnt) AS total FROM ct GROUP BY label),
pri AS (SELECT label, count(*) AS n_c FROM split WHERE NOT is_test GROUP BY label),
cls AS (SELECT p.label, ln(p.n_c / (SELECT count(*) FROM split WHERE NOT is_test)) AS log_prior,
               ln(1.0 / (coalesce(t.total, 0) + 1.0 * (SELECT v FROM vsz))) AS base
        FROM pri p LEFT JOIN tot t USING (label)),
test AS (SELECT doc_id, label AS truth FROM split {scored}),
known AS (SELECT tc.doc_id, tc.term, tc.tf FROM tc JOIN test USING (doc_id)
          WHERE tc.term IN (SELECT term FROM train)),
nin AS (SELECT doc_id, sum(tf) AS n_in FROM known GROUP BY doc_id),
adj AS (SELECT k.doc_id, ct.label, sum(k.tf * (ln(ct.cnt + 1.0) - ln(1.0))) AS adj
        FROM known k JOIN ct USING (term) GROUP BY k.doc_id, ct.label),
jll AS (SELECT t.doc_id, t.truth, c.label, c.log_prior + coalesce(n.n_in, 0) * c.base + coalesce(a.adj, 0.0) AS jll
        FROM test t CROSS JOIN cls c LEFT JOIN nin n ON n.doc_id = t.doc_id
        LEFT JOIN adj a ON a.doc_id = t.doc_id AND a.label = c.label),
ex AS (SELECT *, exp(jll - max(jll) OVER (PARTITION BY doc_id)) AS e FROM jll),
probs AS (SELECT doc_id, truth, label, jll, e / sum(e) OVER (PARTITION BY doc_id) AS prob,
                 row_number() OVER (PARTITION BY doc_id ORDER BY jll DESC, label ASC) AS pred_rank FROM ex),
pred AS (SELECT doc_id, truth, label AS pred, prob FROM probs WHERE pred_rank = 1)"""


def _source(spark, sf, task: str):
    t = Tables(spark, sf)
    if task == "lang":
        return t.documents.select("doc_id", "text", F.col("lang").alias("label"))
    return (t.documents.select("doc_id", "text")
            .join(t.labels.select("doc_id", F.col("quality").cast("string").alias("label")), "doc_id"))


def nb_predictions(spark, sf, task: str = "lang", every_row: bool = False):
    """Per-class rows ``(doc_id, truth, label, jll, prob, pred, pred_rank)`` for the test split, or for all
    rows. Split and term counts are written once; fit and scoring read them."""
    src = _source(spark, sf, task)
    sp = materialize(splits.stratified_split(src.select("doc_id", "label"), "label", "doc_id", TEST_FRACTION), "nb-split")
    counts = materialize(classify.doc_term_counts(src, "doc_id", X.word_tokens("text")), "nb-terms")
    train_docs = sp.where(~F.col("is_test")).select(F.col("doc_id").alias("doc"), "label")
    scored = sp if every_row else sp.where(F.col("is_test"))
    test_docs = scored.select(F.col("doc_id").alias("doc"), F.col("label").alias("truth"))
    train_counts = counts.join(train_docs, "doc")
    model = classify.fit_naive_bayes(train_counts, train_docs)
    test_counts = counts.join(test_docs.select("doc"), "doc", "left_semi")
    probs = classify.predict_naive_bayes(model, test_counts, test_docs)
    return probs.join(test_docs, "doc").withColumnRenamed("doc", "doc_id")


def _pred(spark, sf, task="lang"):
    p = nb_predictions(spark, sf, task)
    return p.where(F.col("pred_rank") == 1).select("doc_id", "truth", "pred", "prob")


@register("stratified_split", f"""
WITH {nb_sql(LANG_SRC)}
SELECT doc_id, label, is_test FROM split""")
def stratified_split(spark, sf):
    """Per class, the first ceil(25%) rows in md5(seed:id) order are test."""
    src = _source(spark, sf, "lang").select("doc_id", "label")
    return splits.stratified_split(src, "label", "doc_id", TEST_FRACTION).select("doc_id", "label", "is_test")


@register("nb_language_predict", f"""
WITH {nb_sql(LANG_SRC)}
SELECT doc_id, truth, pred, round(prob, 6) AS confidence FROM pred""")
def nb_language_predict(spark, sf):
    """Closed-form multinomial naive Bayes (alpha 1) language predictions."""
    return _pred(spark, sf).select("doc_id", "truth", "pred", rnd("prob", 6).alias("confidence"))


@register("top2_labels", f"""
WITH {nb_sql(LANG_SRC)}
SELECT doc_id, label, pred_rank AS rank, round(prob, 6) AS prob FROM probs WHERE pred_rank <= 2""")
def top2_labels(spark, sf):
    """Two most probable classes per document with their probabilities."""
    p = nb_predictions(spark, sf)
    return p.where(F.col("pred_rank") <= 2).select("doc_id", "label", F.col("pred_rank").alias("rank"),
                                                   rnd("prob", 6).alias("prob"))


@register("accuracy", f"""
WITH {nb_sql(LANG_SRC)}
SELECT round(avg(CASE WHEN pred = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM pred""")
def accuracy(spark, sf):
    """Mean of exact matches."""
    p = _pred(spark, sf)
    return p.agg(rnd(F.avg((F.col("pred") == F.col("truth")).cast("double")), 6).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))


def cells(pred):
    """Counts ``(truth, pred, n)``: at most classes² rows, from which every metric is derived."""
    return pred.groupBy("truth", "pred").agg(F.count(F.lit(1)).alias("n"))


def per_class(pred):
    """Per-class precision/recall/F1/support and hits; classes from both columns."""
    same = F.col("truth") == F.col("pred")
    zero = F.lit(0).cast("bigint")
    parts = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), zero.alias("n_pred"),
                 F.when(same, F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("pred").alias("label"), zero.alias("support"), F.col("n").alias("n_pred"), zero.alias("tp")))
    out = cells(pred).select(F.inline(parts)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "n_pred", "tp")])
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return out.select("label", p.alias("precision"), r.alias("recall"), f1.alias("f1"), "support", "tp")


PER_CLASS_SQL = """
lab AS (SELECT truth AS label FROM pred UNION SELECT pred FROM pred),
pc0 AS (SELECT l.label,
               (SELECT count(*) FROM pred WHERE truth = l.label AND pred = l.label) AS tp,
               (SELECT count(*) FROM pred WHERE pred = l.label) AS n_pred,
               (SELECT count(*) FROM pred WHERE truth = l.label) AS support FROM lab l),
pc AS (SELECT label, CASE WHEN n_pred = 0 THEN 0.0 ELSE tp / n_pred END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, support FROM pc0),
pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
        FROM pc)"""


@register("classification_report", f"""
WITH {nb_sql(LANG_SRC)}, {PER_CLASS_SQL}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pcf
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf""")
def classification_report(spark, sf):
    """Per-class precision/recall/F1/support plus macro and weighted averages.

    Each class adds to its own row and to both averages, in one aggregation.
    """
    kinds = F.array(*[F.struct(name.alias("name"), F.lit(kind).alias("kind")) for name, kind in
                      ((F.col("label"), 0), (F.lit("macro avg"), 1), (F.lit("weighted avg"), 2))])
    rows = per_class(_pred(spark, sf)).select("*", F.inline(kinds))
    w = F.when(F.col("kind") == 2, F.col("support")).otherwise(F.lit(1))
    mean = lambda c: rnd(F.sum(F.col(c) * w) / F.sum(w), 6).alias(c)
    out = rows.groupBy("name", "kind").agg(*[mean(c) for c in ("precision", "recall", "f1")],
                                           F.sum("support").cast("bigint").alias("support"))
    return out.select(F.col("name").alias("label"), "precision", "recall", "f1", "support")


@register("weighted_metrics", f"""
WITH {nb_sql(LANG_SRC)}, {PER_CLASS_SQL}
SELECT round(avg(CASE WHEN p.pred = p.truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       (SELECT round(sum(precision * support) / sum(support), 6) FROM pcf) AS precision,
       (SELECT round(sum(recall * support) / sum(support), 6) FROM pcf) AS recall,
       (SELECT round(sum(f1 * support) / sum(support), 6) FROM pcf) AS f1
FROM pred p""")
def weighted_metrics(spark, sf):
    """Support-weighted precision, recall and F1 with accuracy."""
    n = F.sum("support")
    mean = lambda c: rnd(F.sum(F.col(c) * F.col("support")) / n, 6).alias(c)
    return per_class(_pred(spark, sf)).agg(rnd(F.sum("tp") / n, 6).alias("accuracy"),
                                           *[mean(c) for c in ("precision", "recall", "f1")])


@register("confusion_matrix", f"""
WITH {nb_sql(LANG_SRC)},
lab AS (SELECT truth AS label FROM pred UNION SELECT pred FROM pred)
SELECT a.label AS truth, b.label AS pred,
       (SELECT count(*) FROM pred p WHERE p.truth = a.label AND p.pred = b.label) AS n
FROM lab a CROSS JOIN lab b""")
def confusion_matrix(spark, sf):
    """Counts for every (truth, pred) class pair, zeros included.

    The counts, at most classes² rows, are gathered in one row and laid out as a grid.
    """
    one = cells(_pred(spark, sf)).agg(F.collect_list(F.struct("truth", "pred", "n")).alias("c"))
    labels = F.array_distinct(F.flatten(F.transform("c", lambda x: F.array(x["truth"], x["pred"]))))
    grid = one.select("c", labels.alias("l")).select("c", "l", F.explode("l").alias("truth")).select(
        "c", "truth", F.explode("l").alias("pred"))
    here = F.filter("c", lambda x: (x["truth"] == F.col("truth")) & (x["pred"] == F.col("pred")))
    return grid.select("truth", "pred", F.aggregate(here, F.lit(0).cast("bigint"), lambda a, x: a + x["n"]).alias("n"))


POS_SQL = f"""
pos AS (SELECT coalesce(min(label) FILTER (WHERE lower(label) IN ({', '.join(f"'{x}'" for x in POSITIVE_LABEL_NAMES)})),
                        max(label)) AS pos FROM src)"""


@register("binary_metrics", f"""
WITH {nb_sql(QUALITY_SRC)}, {POS_SQL},
b AS (SELECT CAST(truth = (SELECT pos FROM pos) AS INTEGER) AS y, CAST(pred = (SELECT pos FROM pos) AS INTEGER) AS yhat FROM pred),
c AS (SELECT count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) AS n,
             count(*) FILTER (WHERE y = yhat) AS ok FROM b),
m AS (SELECT ok / n AS accuracy, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM c)
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1
FROM m""")
def binary_metrics(spark, sf):
    """Accuracy and positive-class precision/recall/F1 (0 on zero division)."""
    from .text import positive_class
    src = _source(spark, sf, "quality")
    pos = positive_class(src, "label")
    pred = _pred(spark, sf, "quality")
    return binary_metrics_of(pred.select((F.col("truth") == pos).cast("int").alias("y"),
                                         (F.col("pred") == pos).cast("int").alias("yhat")))


def binary_metrics_of(b):
    c = b.agg(F.count_if((F.col("y") == 1) & (F.col("yhat") == 1)).alias("tp"),
              F.count_if((F.col("y") == 0) & (F.col("yhat") == 1)).alias("fp"),
              F.count_if((F.col("y") == 1) & (F.col("yhat") == 0)).alias("fn"),
              F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == F.col("yhat")).alias("ok"))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    m = c.select((F.col("ok") / F.col("n")).alias("accuracy"), p.alias("precision"), r.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return m.select(rnd("accuracy", 6).alias("accuracy"), rnd("precision", 6).alias("precision"),
                    rnd("recall", 6).alias("recall"), rnd(f1, 6).alias("f1"))


@register("metrics_unpivot", f"""
WITH {nb_sql(QUALITY_SRC)}, {POS_SQL},
b AS (SELECT CAST(truth = (SELECT pos FROM pos) AS INTEGER) AS y, CAST(pred = (SELECT pos FROM pos) AS INTEGER) AS yhat FROM pred),
c AS (SELECT count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) AS n,
             count(*) FILTER (WHERE y = yhat) AS ok FROM b),
m AS (SELECT ok / n AS accuracy, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM c),
m2 AS (SELECT 'naive_bayes' AS model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
              round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1 FROM m)
SELECT model, metric, value FROM m2 UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1))""")
def metrics_unpivot(spark, sf):
    """Metrics table melted to (model, metric, value)."""
    m = binary_metrics(spark, sf).withColumn("model", F.lit("naive_bayes"))
    return m.unpivot(["model"], ["accuracy", "precision", "recall", "f1"], "metric", "value")


# The curve ranks by the log odds of the positive class: unlike the probability they
# don't run into 0 and 1. Nine decimals of it are far below any difference between
# documents and far above the noise of summing in another order.
ROC_SQL = f"""
WITH {nb_sql(QUALITY_SRC)}, {POS_SQL},
o AS (SELECT doc_id, max(jll) FILTER (WHERE label = (SELECT pos FROM pos)) AS a,
             max(jll) FILTER (WHERE label <> (SELECT pos FROM pos)) AS m FROM probs GROUP BY doc_id),
s AS (SELECT p.doc_id, CAST(any_value(p.truth) = (SELECT pos FROM pos) AS INTEGER) AS y, any_value(prob) FILTER (WHERE label = (SELECT pos FROM pos)) AS prob,
             round(any_value(a) - any_value(m) - ln(sum(exp(jll - m)) FILTER (WHERE label <> (SELECT pos FROM pos))), 9) AS score
      FROM probs p JOIN o USING (doc_id) GROUP BY p.doc_id),
g AS (SELECT score, max(prob) AS prob, count(*) FILTER (WHERE y = 1) AS tp, count(*) FILTER (WHERE y = 0) AS fp FROM s GROUP BY score),
totals AS (SELECT sum(tp) AS p, sum(fp) AS n FROM g),
cum AS (SELECT score, prob, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp FROM g),
pts AS (SELECT score, prob, CASE WHEN (SELECT n FROM totals) = 0 THEN 0.0 ELSE cfp / (SELECT n FROM totals) END AS fpr,
               CASE WHEN (SELECT p FROM totals) = 0 THEN 0.0 ELSE ctp / (SELECT p FROM totals) END AS tpr FROM cum)"""


def _roc_counts(spark, sf):
    """(score, prob, tp, fp, ctp, cfp) for every distinct score, counted from the highest."""
    from .text import positive_class
    src = _source(spark, sf, "quality")
    pos = F.col("label") == positive_class(src, "label")
    p = nb_predictions(spark, sf, "quality").withColumn("pos", pos)
    top = F.max(F.when(~F.col("pos"), F.col("jll")))
    own = F.max(F.when(F.col("pos"), F.col("jll")))
    # log of the sum over the other classes, whose number is bounded: their list is one row's
    others = F.collect_list(F.when(~F.col("pos"), F.col("jll")))
    per_doc = p.groupBy("doc_id").agg(
        own.alias("a"), top.alias("m"), others.alias("o"), F.max(F.when(F.col("pos"), F.col("prob"))).alias("prob"),
        F.max(F.when(F.col("pos"), (F.col("truth") == F.col("label")).cast("int"))).alias("y"))
    log_rest = F.col("m") + F.log(F.aggregate("o", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("m"))))
    scored = per_doc.select("y", "prob", rnd(F.col("a") - log_rest, 9).alias("score"))
    g = scored.groupBy("score").agg(F.max("prob").alias("prob"), F.count_if(F.col("y") == 1).alias("tp"),
                                    F.count_if(F.col("y") == 0).alias("fp"))
    return running_sums(g, "score", {"tp": "ctp", "fp": "cfp"})


@register("roc_curve", ROC_SQL + """
SELECT score AS log_odds, round(prob, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM pts""")
def roc_curve(spark, sf):
    """ROC points at every distinct score (descending thresholds)."""
    c = _roc_counts(spark, sf)
    share = lambda k, n: F.coalesce(F.try_divide(F.col(k), F.col(n)), F.lit(0.0))
    return c.select(F.col("score").alias("log_odds"), rnd("prob", 6).alias("threshold"),
                    rnd(share("cfp", "all_fp"), 6).alias("fpr"), rnd(share("ctp", "all_tp"), 6).alias("tpr"))


@register("roc_auc", ROC_SQL + """,
seg AS (SELECT fpr, tpr, lag(fpr, 1, 0.0) OVER (ORDER BY score DESC) AS pf,
               lag(tpr, 1, 0.0) OVER (ORDER BY score DESC) AS pt FROM pts)
SELECT round(sum((fpr - pf) * (tpr + pt) / 2.0), 6) AS auc FROM seg""")
def roc_auc(spark, sf):
    """Trapezoid area under the ROC points, starting from (0, 0): each score adds its
    negatives times the mean of the positives before and up to it."""
    area = F.sum(F.col("fp") * (F.col("ctp") - F.col("tp") / 2)) / F.max(F.col("all_fp") * F.col("all_tp"))
    return _roc_counts(spark, sf).agg(rnd(area, 6).alias("auc"))
