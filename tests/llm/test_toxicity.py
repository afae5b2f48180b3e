import numpy as np

from tessera.llm import toxicity as tox
from tessera.llm.queries import op4_toxicity

from .util import ODD_TEXTS, docs


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    got = op4_toxicity(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    hit = held[held.toxic == 1].predicted.mean()
    false = held[held.toxic == 0].predicted.mean()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert hit > 0.9 and false < 0.02 and got.score.between(0, 1).all()


def test_trees_learn_an_interaction_and_repeat():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    a, b = tox.boost(x, y), tox.boost(x, y)
    assert ((a.raw(x) > 0) == (y > 0)).mean() > 0.97
    np.testing.assert_array_equal(a.raw(x), b.raw(x))


def test_isotonic_is_monotone_and_weighted():
    s = np.array([1, 2, 3, 4, 5, 6.0])
    y = np.array([0, 1, 0, 1, 1, 1.0])
    knots, values = tox.isotonic(s, y, np.array([1, 1, 3, 1, 1, 1.0]))
    assert (np.diff(values) >= 0).all()
    assert np.interp([1, 2.5, 6], knots, values).tolist() == [0, 0.25, 1]


def test_features_see_obfuscation_and_proximity():
    names = {n: k for k, n in enumerate(tox.FEATURES)}
    f = tox.features(["you idiot", "idiot far far far far far far far away you", "1d10t", "stuuupid", "IDIOT!!", ""],
                     tox.Terms({}, {"lowei": 2.0}))
    assert f[0, names["near_any"]] == 1 and f[1, names["near_any"]] == 0
    assert f[2, names["hidden"]] == 1 and f[3, names["hidden"]] == 1
    assert f[4, names["fixed"]] == 1 and f[4, names["all_caps"]] == 1 and f[4, names["exclaims"]] == 2
    assert not f[5].any()
    assert tox.Terms({}, {"lowei": 2.0}).weight("loweichaft") == 2.0 and tox.Terms().weight("x") == 0


def test_edge_cases(spark):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "you idiot"), (3, "x"), (3, "x")]
    df = docs(spark, rows)
    pairs = df.selectExpr("doc_id AS doc", "text")
    nothing = tox.fit(pairs, spark.createDataFrame([], "doc long, label int"))
    assert nothing.trees is None and nothing.score(["a", ""]).tolist() == [0, 0]
    one = tox.fit(pairs, spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc long, label int"))
    assert one.score(["a"]).tolist() == [1.0]
    got = df.select("doc_id", tox.scored(df.text, nothing).alias("score")).collect()
    assert len(got) == len(rows)


def test_clashing_columns_long_texts_and_empty_tables(spark):
    bad, good = "you idiot lowei scum", "the sea and the hill"
    rows = [(k, (bad if k % 2 else good) + f" w{k % 7}") for k in range(60)] + [(1, "other text"), (900, good + " x" * 400_000), (901, None)]
    df = docs(spark, rows).selectExpr("*", "1 AS doc", "2 AS label", "3 AS rank", "4 AS h", "5 AS score")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(1, 0), (1, 1), (900, 0), (777, 1)], "doc long, label int")
    few = tox.fit(df.selectExpr("doc_id AS doc", "text"), labels, rows_per_class=25)
    got = {r.doc_id: r.s for r in df.where("doc_id > 1").select("doc_id", tox.scored(df.text, few).alias("s")).collect()}
    assert len(got) == 60 and all(0 <= s <= 1 for s in got.values())
    assert min(got[k] for k in range(3, 60, 2)) > max(got[k] for k in range(2, 60, 2))
    none = tox.fit(docs(spark, []).selectExpr("doc_id AS doc", "text"), labels)
    assert none.trees is None
    empty = docs(spark, [])
    assert empty.select(tox.scored(empty.text, few)).count() == 0
