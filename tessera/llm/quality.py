"""Quality rules: plain counts, then a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed words and word pairs: one of a trusted
target (documents labelled as good), one of the raw corpus (all documents). Counts are
gathered over every document and every text to its end: one pass of partial sums, at most
``buckets`` rows a task. The target's multinomial is smoothed by n-grams spread like the raw
corpus, ``PRIOR_SHARE`` as many as the trusted ones (or ``prior``), so a score means the same
at every size; without trusted texts the ratio is 0 and rejects nothing. A document's score
is the mean log ratio of its n-grams (length-normalised).

The bar comes from all trusted documents that pass the base rules: each is also scored by
ratios without its own fold (one of ``FOLDS`` by hash of the id), as if it weren't labelled,
and the bar is the score that at most ``LOST`` of them stay below. With few trusted texts
these scores are low, so the bar is low and rejects little. No draw is involved.

Everything is Spark SQL expressions. The ``1 + FOLDS`` tables of ``buckets`` log ratios (sizes
fixed by parameters) are a scalar subquery's value; a document's n-grams become rows whose
sum is taken in the same task, so only one row of numbers for each document is shuffled.

Edge cases: null and empty texts have zero words and fail the base rules; a text with fewer
than five words has no window; a text of one word has a score from that word; rows are
independent, so null or repeated ids make no difference to the counts of a row (a null id
is never trusted); empty tables give an empty result; other columns are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import NOT_SPACE, broadcast_if_small, materialize, once, runs, windows, words

BUCKETS = 1 << 15
PRIOR_SHARE = 0.1
FOLDS = 8
LOST = 0.01
STEP = 0.001
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _covered(hashes: str) -> Column:
    """Words in windows found twice or more: the windows' positions in order of hash
    show the repeated ones; between neighbours among these, at most WINDOW words count."""
    h = F.col(hashes)
    by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda k, d: F.get(s, k)["h"] == F.get(s, k + d)["h"]
        keep = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                        lambda k: F.coalesce(same(k, -1), F.lit(False)) | F.coalesce(same(k, 1), F.lit(False)))
        return F.sort_array(F.transform(keep, lambda k: F.get(s, k)["i"]))

    def cover(at: Column) -> Column:
        step = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    found = once(by_hash, lambda s: once(repeated(s), cover))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), found).otherwise(F.lit(0)).cast("long")


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the base columns, from a column ``text``; ``w`` are the words."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    split = docs.select(*keep, text.alias("text"), words(text).alias("w"), lines.alias("lines"))
    counted = split.select(
        *keep, "w", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows(F.col("w"), WINDOW, lambda w: F.xxhash64(*w)).alias("h"))
    return (counted.withColumn("n_repeat_words", _covered("h")).drop("h")
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def _grams(docs: DataFrame, keep: list[str], buckets: int) -> DataFrame:
    """``keep`` and, for every word of the array column ``w``, the buckets ``one`` of the word and
    ``two`` of it and the next (null for the last); a row of nulls where there is no word."""
    hashed = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")
    return docs.select(*keep, F.inline_outer(runs(F.col("w"), 2))).select(
        *keep, F.when(F.col("w0").isNotNull(), hashed("w0")).alias("one"),
        F.when(F.col("w1").isNotNull(), hashed("w0", "w1")).alias("two"))


def log_ratios(docs: DataFrame, buckets: int = BUCKETS, prior: float | None = None) -> list[float]:
    """The log ratio of each bucket against all trusted documents of ``docs`` (fold, text),
    then, fold by fold, against those outside the fold; ``fold`` is null where a document
    isn't trusted. What reaches the driver is one row a bucket."""
    split = docs.select("fold", words(F.col("text")).alias("w"))
    in_fold = [F.count(F.when(F.col("fold") == k, 1)).alias(f"good{k}") for k in range(FOLDS)]
    counts = (_grams(split, ["fold"], buckets)
              .select("fold", F.explode_outer(F.array("one", "two")).alias("bucket")).where("bucket IS NOT NULL")
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("fold").alias("good"), *in_fold)).collect()
    all_raw = sum(r["raw"] for r in counts)
    ratios = [0.0] * ((1 + FOLDS) * buckets)
    for k in range(1 + FOLDS):
        good = [r["good"] - (r[f"good{k - 1}"] if k else 0) for r in counts]
        all_good = sum(good)
        spread = PRIOR_SHARE * all_good if prior is None else prior
        for r, g in zip(counts, good) if all_good else ():
            expected = r["raw"] / all_raw
            ratios[k * buckets + r["bucket"]] = math.log((g + spread * expected) / (all_good + spread) / expected)
    return ratios


def _bar(scored: DataFrame) -> float:
    """The score that at most ``LOST`` of the trusted documents that pass the base rules stay
    below, each scored without its own fold; from counts of scores in steps of ``STEP``,
    so it is the same in every run. Not above 0, where a document is as like the target as
    the corpus; without trusted documents there is no bar."""
    steps = (scored.where("held_out IS NOT NULL AND NOT base_failed")
             .groupBy(F.floor(F.col("held_out") / STEP).alias("step")).count().collect())
    below, allowed = 0, LOST * sum(r["count"] for r in steps)
    for r in sorted(steps, key=lambda r: r["step"]):
        below += r["count"]
        if below > allowed:
            return min(r["step"] * STEP, 0.0)
    return -math.inf


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float | None = None, buckets: int = BUCKETS, prior: float | None = None) -> DataFrame:
    """(id, base columns, base_failed, kept, score) for every row of ``docs``; ``trusted`` has
    the ids of the target's documents in ``id_col``."""
    mark = broadcast_if_small(trusted.select(F.col(id_col).alias("doc")).where("doc IS NOT NULL").distinct()
                              .withColumn("fold", F.pmod(F.xxhash64("doc"), F.lit(FOLDS)).cast("int")))
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(mark, "doc", "left")
    ratios = log_ratios(docs, buckets, prior)
    # a scalar subquery over a file, not a literal: Spark holds its value as one block of doubles, the plan stays short
    table = docs.sparkSession.createDataFrame([(ratios,)], "ratios array<double>")
    by_bucket = materialize(table, "quality-ratios").scalar()
    ratio = lambda b: F.coalesce(F.get(by_bucket, b), F.lit(0.0))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    counted = base_counts(docs, ["doc", "fold"]).withColumn("row", F.monotonically_increasing_id())
    n = F.greatest(2 * F.col("n_words") - 1, F.lit(1))  # words and pairs
    # a task sees all n-grams of a row, so its partial sums are one for each row
    score = F.sum(ratio(F.col("one")) + ratio(F.col("two"))) / F.first(n)
    own = (F.col("fold") + 1) * buckets
    held_out = F.sum(F.when(F.col("fold").isNotNull(), ratio(F.col("one") + own) + ratio(F.col("two") + own)))
    scored = materialize(
        _grams(counted, ["row", "doc", "fold", *base], buckets).groupBy("row", "doc")
        .agg(*[F.first(c).alias(c) for c in base], score.alias("score"), (held_out / F.first(n)).alias("held_out")),
        "quality-scores")
    bar = _bar(scored) if threshold is None else threshold
    return scored.select(F.col("doc").alias(id_col), *base,
                         (~F.col("base_failed") & (F.col("score") >= bar)).alias("kept"), "score")
