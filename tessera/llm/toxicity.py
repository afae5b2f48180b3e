"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed and of a learned lexicon, second-person
words and their proximity to lexicon words, capitals, punctuation, obfuscation (digits
or symbols inside words, letters repeated, lexicon words that show only after undoing
that), length. The learned lexicon has words and word beginnings whose log odds between
toxic and other documents are high, so it covers the languages that the labels cover.

Learning uses a bounded sample of the labelled rows: ``rows_per_class`` rows of each class
with the smallest id hashes. Half of it gives the lexicon, so that the trees, which
learn from three quarters of the other half, see the lexicon as new texts do; the last
quarter fits the isotonic calibration. Lexicon counts and features are computed by Spark;
the driver gets at most ``MAX_TERMS`` terms and one feature row for each sampled document.

Edge cases: null and empty texts have all features 0 and get the score of that point;
without labels of both classes every score is the labels' rate (0 without any); rows are
independent, ids may be null (then never learned from) or repeated; of repeated labels the
largest counts; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._batch import coded, slices, sums
from ._shared import materialize, words

ROWS_PER_CLASS = 6000
MAX_TERMS = 4000
PREFIXES = (4, 5, 6)
NEAR = 6
_WORDS = 20_000  # distinct words whose rows are Python objects at once
# fixed values: a small general lexicon, and second-person words
LEXICON = frozenset("""asshole bastard bitch clown crap damn disgusting dumb freak fuck garbage hate hideous idiot imbecile
jerk kill loser lunatic moron nazi pathetic pig retard scum shit shut slut stupid trash ugly vermin worthless""".split())
SECOND_PERSON = frozenset("""you your yours yourself youre ya u ur du dich dir dein deine ihr euch euer sie tu te toi ton
ta tes vous votre vos tú ti tus usted ustedes vosotros""".split())
# fixed values: characters that stand for letters
_PLAIN = str.maketrans("013457@$!|", "oieastasil")
_EDGE = re.compile(r"^\W+|\W+$")
_INSIDE = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
FEATURES = ("fixed", "learned", "learned_sum", "learned_max", "learned_any", "second", "near", "near_any", "capitals",
            "all_caps", "exclaims", "questions", "symbols", "runs", "mixed", "repeats", "hidden", "words", "length")


@dataclass
class Terms:
    """The learned lexicon: weights of whole words and of word beginnings."""
    whole: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.stems = {t[:PREFIXES[0]] for t in self.starts}  # one look-up passes over most words

    def weight(self, w: str) -> float:
        found = self.whole.get(w)
        if found is not None or w[:PREFIXES[0]] not in self.stems:
            return found or 0.0
        return max(self.starts.get(w[:n], 0.0) for n in PREFIXES)


def _word_row(raw: str, terms: Terms) -> tuple[float, ...]:
    """What one word adds to the text's sums."""
    n = len(raw)
    if raw.isalpha() and raw.islower() and not _REPEAT.search(raw):
        weight = terms.weight(raw)
        return (raw in LEXICON, weight > 0, weight, raw in SECOND_PERSON, 0, 0, 0, 0, 0, 0, 0, 0, 0, n)
    w = raw if raw.isalpha() else _EDGE.sub("", raw)
    low = w.lower()
    alpha = w.isalpha()
    fixed = low in LEXICON
    weight = terms.weight(low)
    hidden = mixed = repeats = False
    if not alpha and w:
        mixed = bool(_INSIDE.search(w))
    if w and not fixed and (mixed or _REPEAT.search(low)):
        repeats = bool(_REPEAT.search(low))
        plain = re.sub(r"[\W\d_]", "", raw.lower().translate(_PLAIN))
        hidden = plain in LEXICON or _REPEAT.sub(r"\1", plain) in LEXICON or re.sub(r"(.)\1+", r"\1", plain) in LEXICON
    upper = 0 if raw.islower() else sum(map(str.isupper, raw))
    marks = 0 if alpha and len(w) == n else n - sum(map(str.isalnum, raw))
    ex, qu = (raw.count("!"), raw.count("?")) if marks else (0, 0)
    return (fixed, weight > 0, weight, low in SECOND_PERSON, upper, upper > 2 and upper == n - marks, ex, qu,
            marks - ex - qu, marks >= 2, mixed, repeats, hidden, n)


def features(texts: list[str], terms: Terms) -> np.ndarray:
    """Feature matrix of some texts, each read to its end."""
    vocabulary, codes, ends = coded(texts, str.split)
    width = len(_word_row("", terms))
    rows = np.zeros((len(vocabulary), width), np.float32)
    for k in range(0, len(vocabulary), _WORDS):
        some = vocabulary[k:k + _WORDS]
        rows[k:k + _WORDS] = [_word_row(w, terms) for w in some]
    out = np.zeros((len(texts), len(FEATURES)))
    count = np.diff(ends, prepend=0)
    per_word = np.maximum(count, 1)
    total = sums(rows[codes], ends) if len(codes) else np.zeros((len(texts), width))
    chars = np.maximum(total[:, 13], 1)
    bad = (rows[:, 1] > 0) | (rows[:, 0] > 0) | (rows[:, 12] > 0)
    hit = bad[codes] if len(codes) else np.zeros(0, bool)
    you = (rows[:, 3] > 0)[codes] if len(codes) else np.zeros(0, bool)
    text_of = np.repeat(np.arange(len(texts)), count)
    at, you_at = np.nonzero(hit)[0], np.nonzero(you)[0]
    close = np.zeros(len(at), bool)
    if len(at) and len(you_at):
        k = np.searchsorted(you_at, at)
        for side in (np.clip(k - 1, 0, len(you_at) - 1), np.clip(k, 0, len(you_at) - 1)):
            other = you_at[side]
            close |= (np.abs(other - at) <= NEAR) & (text_of[other] == text_of[at])
    near = np.bincount(text_of[at], weights=close, minlength=len(texts))[:len(texts)]
    learned_max = np.zeros(len(texts))
    np.maximum.at(learned_max, text_of[at], rows[codes[at], 2] if len(at) else np.zeros(0))
    columns = (total[:, 0] / per_word, total[:, 1] / per_word, total[:, 2] / per_word, learned_max, total[:, 1],
               total[:, 3] / per_word, near / per_word, near, total[:, 4] / chars, total[:, 5] / per_word,
               total[:, 6] / per_word, total[:, 7] / per_word, total[:, 8] / chars, total[:, 9] / per_word,
               total[:, 10] / per_word, total[:, 11] / per_word, total[:, 12] / per_word, np.log1p(count),
               total[:, 13] / per_word)
    for k, c in enumerate(columns):
        out[:, k] = c
    out[count == 0] = 0
    return out


@dataclass
class Boosted:
    """Trees for the log odds: ``trees`` has (feature, cut, value) arrays of complete trees."""
    start: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node - (2 ** self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48,
          ridge: float = 1.0) -> Boosted:
    """Second-order boosting of the logistic loss with histograms over quantile bins."""
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(rate0 / (1 - rate0))), [], depth)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1)
    raw = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2 ** level - 1, 2 ** level
            gain, pick = np.zeros(n), [None] * n
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                slot = (node - first) * (len(c) + 1) + codes[:, k]
                g = np.bincount(slot, grad, n * (len(c) + 1)).reshape(n, -1).cumsum(1)
                h = np.bincount(slot, hess, n * (len(c) + 1)).reshape(n, -1).cumsum(1)
                score = lambda a, b: a * a / (b + ridge)
                up = score(g[:, :-1], h[:, :-1]) + score(g[:, -1:] - g[:, :-1], h[:, -1:] - h[:, :-1]) - score(g[:, -1:], h[:, -1:])
                best = up.argmax(1)
                for i in np.nonzero(up[np.arange(n), best] > gain + 1e-9)[0]:
                    gain[i], pick[i] = up[i, best[i]], (k, c[best[i]])
            for i, chosen in enumerate(pick):
                if chosen:
                    feature[first + i], cut[first + i] = chosen
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - (2 ** depth - 1)
        value = -rate * np.bincount(leaf, grad, 2 ** depth) / (np.bincount(leaf, hess, 2 ** depth) + ridge)
        model.trees.append((feature, cut, value))
        raw += value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (knots, values) of the non-decreasing step fit, for ``np.interp``."""
    xs, inverse = np.unique(score, return_inverse=True)
    weight = np.bincount(inverse, weights)
    mean = np.bincount(inverse, y * weights) / weight
    pools: list[list[float]] = []  # value, weight, first, last
    for i, (m, w) in enumerate(zip(mean, weight, strict=True)):
        pools.append([m, w, i, i])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, _, last = pools.pop()
            m1, w1, first, _ = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, first, last])
    knots = np.array([xs[int(i)] for p in pools for i in p[2:]])
    return knots, np.array([p[0] for p in pools for _ in range(2)])


@dataclass
class Model:
    terms: Terms
    rate: float = 0.0
    trees: Boosted | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.rate)
        return np.clip(np.interp(self.trees.raw(features(texts, self.terms)), *self.knots), 0, 1)


def _terms(sample: DataFrame, least: int = 6, min_log_odds: float = 1.5) -> Terms:
    """The lexicon of (text, label) rows: counts of documents for each word and beginning."""
    low = F.transform(words(F.lower("text")), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    word = F.col("w")
    parts = F.array(F.struct(F.lit(0).alias("n"), word.alias("term")),
                    *[F.when(F.length(word) >= n, F.struct(F.lit(n).alias("n"), F.substring(word, 1, n).alias("term")))
                      for n in PREFIXES])
    keyed = (sample.select("label", F.xxhash64("text").alias("d"), F.array_distinct(low).alias("ws"))
             .select("label", "d", F.explode_outer("ws").alias("w"))
             .where("w <> ''").select("label", "d", F.explode_outer(parts).alias("p")).where("p IS NOT NULL")
             .select("label", "d", "p.n", "p.term").distinct())
    size = sample.agg(F.count(F.when(F.col("label") == 1, 1)).alias("bad"), F.count("*").alias("all")).first()
    bad, good = size["bad"], size["all"] - size["bad"]
    counts = keyed.groupBy("n", "term").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    rows = (counts.where(F.col("bad") >= least).withColumn("odds", odds).where(F.col("odds") >= min_log_odds)
            .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "n", "term").limit(MAX_TERMS).collect())
    return Terms({r["term"]: r["odds"] for r in rows if not r["n"]}, {r["term"]: r["odds"] for r in rows if r["n"]})


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Learn from ``docs`` (doc, text) and ``labels`` (doc, label 0 or 1)."""
    one = materialize(labels.where("doc IS NOT NULL AND label IN (0, 1)").groupBy("doc").agg(F.max("label").alias("label"))
                      .withColumn("h", F.xxhash64(F.col("doc").cast("string"))), "tox-labels")
    totals = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}  # two rows
    # hashes spread evenly: a little more than the wanted share of a class surely holds the rows wanted
    share = {k: min(1.0, (1.2 * rows_per_class + 1000) / n) for k, n in totals.items()}
    below = F.when(F.col("label") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)) * float(1 << 53)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "doc"))
    chosen = (one.where(F.shiftrightunsigned("h", 11) < below).withColumn("rank", rank)
              .where(F.col("rank") <= rows_per_class).select("doc", "label", "rank"))
    texts = docs.select("doc", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc")
    # one row an id: of repeated ids the text that sorts first
    sample = materialize(texts.groupBy("doc").agg(F.min(F.struct("text", "label", "rank")).alias("r")).select("doc", "r.*"),
                         "tox-sample")
    terms = _terms(sample.where("rank % 2 = 0"))
    rest = sample.where("rank % 2 = 1").select("label", F.floor(F.col("rank") / 2).alias("turn"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, some in _with_index(b["text"].tolist()):
                yield pd.DataFrame({"label": b["label"].iloc[k].to_numpy(), "turn": b["turn"].iloc[k].to_numpy(),
                                    "x": list(features(some, terms))})

    rows = rest.mapInPandas(run, "label int, turn long, x array<double>").toPandas()
    taken = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    rate = totals.get(1, 0) / max(sum(totals.values()), 1)
    y = rows["label"].to_numpy(float)
    turn = rows["turn"].to_numpy()
    model = Model(terms, rate)
    learn = turn % 4 != 3
    if len(np.unique(y[learn])) < 2 or len(np.unique(y[~learn])) < 2:
        return model
    x = np.stack(rows["x"].to_numpy())
    order = np.lexsort((*x.T, y, turn))  # rows arrive in any order; the fit doesn't depend on it
    x, y, learn = x[order], y[order], learn[order]
    model.trees = boost(x[learn], y[learn])
    share = np.where(y == 1, totals[1] / taken[1], totals[0] / taken[0])  # undoes the choice by class
    model.knots = isotonic(model.trees.raw(x[~learn]), y[~learn], share[~learn])
    return model


def _with_index(texts: list[str]) -> Iterator[tuple[slice, list[str]]]:
    at = 0
    for some in slices(texts):
        yield slice(at, at + len(some)), some
        at += len(some)


def scored(text: Column, model: Model) -> Column:
    """The calibrated score of a text column."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.concatenate([model.score(some) for some in slices(texts.tolist())] or [np.zeros(0)]))

    return run(text)
