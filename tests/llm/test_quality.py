import random
import re

from tessera.llm import quality
from tessera.llm.queries import op5_quality

from .util import ODD_TEXTS, docs, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for k in range(len(w) - 4):
        at.setdefault(tuple(w[k:k + 5]), []).append(k)
    covered = {k + j for own in at.values() if len(own) > 1 for k in own for j in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def check(spark, rows):
    df = docs(spark, rows).selectExpr("*", "1 AS w", "2 AS score", "3 AS kept")
    got = quality.judge(df, spark.createDataFrame([(0,), (None,)], "doc_id long")).collect()
    mine = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in got)
    assert mine == sorted((str(i), *brute(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)


def test_base_columns_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(80):
        w = words(rng, rng.randrange(0, 60), rng.choice([2, 3, 30, 1000]))
        rows.append((i, "".join(x + rng.choice([" ", "  ", "\n", "\t", " #$\n"]) for x in w)))
    check(spark, rows)


def test_edge_cases(spark):
    check(spark, [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a b c"), (4, "a\na"), (4, "a\na"),
                                                             (5, "x y z " * 30_000)])
    assert quality.judge(docs(spark, []), spark.createDataFrame([], "doc_id long")).count() == 0


def test_ratio_prefers_the_target_and_needs_evidence(spark):
    good = [(k, " ".join(f"good{(k + j) % 50}" for j in range(200))) for k in range(60)]
    bad = [(100 + k, " ".join(f"bad{(k + j) % 50}" for j in range(200))) for k in range(60)]
    df = docs(spark, good + bad)
    trusted = df.where("doc_id < 60").select("doc_id")
    # a prior small against the trusted text lets it speak
    got = {r.doc_id: r.score for r in quality.judge(df, trusted, prior=100).collect()}
    assert min(got[k] for k, _ in good) > 0.3 and max(got[k] for k, _ in bad) < -2
    # without a target nothing is rejected by the method
    none = quality.judge(df, trusted.where("false")).collect()
    assert all(r.kept == (not r.base_failed) and abs(r.score) < 1e-9 for r in none)


def test_query_covers_all_documents_and_keeps_good_ones(spark):
    sf = "/root/testdata/sf0.01"
    got = op5_quality(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    good = got.merge(labels[labels.quality == 1], on="doc_id")
    assert good[~good.base_failed].kept.mean() > 0.98


def test_bad_documents_are_rejected_alike_at_two_sizes(spark):
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        got = op5_quality(spark, sf).where("NOT base_failed").select("doc_id", "kept").toPandas()
        labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").toPandas()
        kept = got.merge(labels, on="doc_id").groupby("quality").kept.mean()
        assert kept[0] < 0.05 and kept[1] > 0.98, (sf, kept)
