"""Language identification: averaged hashed subword embeddings and a linear softmax.

A word ``w`` (lower-cased, split at white space) contributes itself and the character
n-grams of ``<w>``, hashed into ``buckets``; a text's vector is the mean of all its
subword embeddings, and a linear layer with softmax gives the languages' probabilities.
Embeddings and layer are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows: ``rows_per_language`` rows of each language with the smallest id
hashes, at most ``max_rows``. Prediction reads every text to its end.

Calibration. A quarter of the sample is kept from training. On it the softmax is sharpened
or softened by the temperature of least log loss. Labels may be wrong themselves: the share
of disagreement among the better scored half of these rows is taken for label noise. The
rejection bar is the smallest score at which the accepted rows disagree with their
labels at most ``max_error`` (and two standard errors) more often than that; it is never
so high that more than ``MAX_REJECTED`` of the held rows would go. If all rows pass, the bar
is 0 and only texts without a letter are rejected.

Scale: the sample reaches the driver as counts of hashed subwords, at most as many a row as
there are buckets, never as texts; the model, of a size that parameters fix, goes to the
tasks with the function. No language is ranked whole: ids are counted by language, and only
those whose hash lies below the share that holds some times the rows wanted go on. Tasks code some millions of
characters at a time, so memory follows the longest single text, not the batch.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; a
sample without rows makes every text ``und``; one language alone has score 1; rows are
independent, so ids may be null (then not learned from) or repeated; an empty table gives
an empty result; extra columns are ignored by ``predict`` and kept by ``accept``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._batch import coded, slices, sums
from ._shared import fresh, materialize

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 500
MAX_ROWS = 4000
MAX_ERROR = 0.01
MAX_REJECTED = 0.05
BUCKETS_LOG2 = 16
DIM = 16
NGRAMS = (2, 3)
_WORDS = 20_000  # distinct words whose subwords are in memory at once


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, ends): the hashed n-grams of the words, those of word i up to ``ends[i]``."""
    text = "".join(f"<{w}>" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # characters left in the word
    hashes, owners = [], []
    mix, spread = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(len(points), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        h = h * mix + np.concatenate([points[n - 1:], np.zeros(n - 1, np.uint64)]) + np.uint64(n)
        if n in NGRAMS:
            ok = left >= n
            hashes.append(h[ok])
            owners.append(word[ok])
    # the whole word: the sum of its characters' hashes at their places
    place = (points + np.uint64(1)) * spread ^ ((np.repeat(sizes, sizes) - left).astype(np.uint64) * mix)
    hashes.append(np.add.reduceat(place * spread, np.cumsum(sizes) - sizes) if len(words) else place)
    owners.append(np.arange(len(words)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(hashes)[order] * spread) >> np.uint64(64 - BUCKETS_LOG2)
    return bucket.astype(np.int64), np.cumsum(np.bincount(owner, minlength=len(words)))


def _has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    bar: float = 0.0

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(logits, has a letter) of each text."""
        vocabulary, codes, ends = coded(texts, lambda t: t.lower().split())
        # both steps are linear, so the narrower of embedding and logits is summed over the text
        early = len(self.languages) <= DIM
        table = self.embeddings @ self.layer if early else self.embeddings
        vector = np.zeros((len(vocabulary), table.shape[1] + 2), np.float32)  # sum, number of subwords, has a letter
        for k in range(0, len(vocabulary), _WORDS):
            some = vocabulary[k:k + _WORDS]
            bucket, up_to = _subwords(some)
            vector[k:k + _WORDS, :-2] = sums(table[bucket], up_to)
            vector[k:k + _WORDS, -2] = np.diff(up_to, prepend=0)
            vector[k:k + _WORDS, -1] = np.fromiter(map(_has_letter, some), bool, len(some))
        total = _gathered(vector, codes, ends)
        mean = total[:, :-2] / np.maximum(total[:, -2:-1], 1)
        return (mean if early else mean @ self.layer) + self.bias, total[:, -1] > 0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits - logits.max(1, keepdims=True)) / self.temperature
        e = np.exp(z)
        return e / e.sum(1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(language or ``und``, score) of each text."""
        if not self.languages:
            return np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        logits, known = self.logits(texts)
        p = self.probabilities(logits)
        best = p.argmax(1)
        language = np.where(known, np.array(self.languages, object)[best], UNKNOWN)
        return language, np.where(known, p[np.arange(len(p)), best], 0.0)


def _gathered(values: np.ndarray, codes: np.ndarray, ends: np.ndarray, step: int = 1 << 21) -> np.ndarray:
    """Sums of ``values[codes]`` for each text, some words at a time."""
    out = np.zeros((len(ends), *values.shape[1:]))
    first = 0
    for k in range(0, len(codes), step):
        stop = min(k + step, len(codes))
        last = int(np.searchsorted(ends, stop, "left"))
        part = np.clip(ends[first:last + 1] - k, 0, stop - k)
        out[first:last + 1] += sums(values[codes[k:stop]].astype(np.float64), part)
        first = last
    return out


Row = tuple[np.ndarray, np.ndarray, bool]


def features(text: str) -> Row:
    """(buckets, their shares of the text's subwords, whether the text has a letter)."""
    vocabulary, codes, _ = coded([text], lambda t: t.lower().split())
    some, count, letter = np.zeros(0, np.int64), np.zeros(0), False
    numbers = np.bincount(codes, minlength=len(vocabulary))
    for k in range(0, len(vocabulary), _WORDS):
        words = vocabulary[k:k + _WORDS]
        bucket, up_to = _subwords(words)
        weight = np.repeat(numbers[k:k + _WORDS], np.diff(up_to, prepend=0))
        some, at = np.unique(np.concatenate([some, bucket]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([count, weight]), minlength=len(some))
        letter = letter or any(map(_has_letter, words))
    return some, (count / max(count.sum(), 1)).astype(np.float32), letter


def train(rows: list[Row], langs: list[str], max_error: float = MAX_ERROR, epochs: int = 8, rate: float = 2.0,
          seed: int = 0) -> Model:
    """Fit on three quarters of the rows of ``features``, calibrate on the rest."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    model = Model(languages, rng.normal(0, 0.1, (1 << BUCKETS_LOG2, DIM)).astype(np.float32),
                  np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32))
    if len(languages) < 2:
        return model
    model.layer[:] = rng.normal(0, 0.3, model.layer.shape)
    number = {x: k for k, x in enumerate(languages)}
    target = np.array([number[x] for x in langs])
    held = np.arange(len(rows)) % 4 == 3
    learn = np.nonzero(~held)[0]
    batch = 16
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in range(0, len(learn), batch):
            pick = learn[(order := rng.permutation(len(learn)) if k == 0 else order)[k:k + batch]]
            x = np.array([w @ model.embeddings[f] for f, w, _ in (rows[i] for i in pick)], np.float32)
            p = model.probabilities(x @ model.layer + model.bias)
            p[np.arange(len(pick)), target[pick]] -= 1
            back = p @ model.layer.T
            model.layer -= step / len(pick) * (x.T @ p)
            model.bias -= step / len(pick) * p.sum(0)
            for i, g in zip(pick, back, strict=True):
                f, w, _ = rows[i]
                model.embeddings[f] -= step * w[:, None] * g[None, :]
    return _calibrated(model, [rows[i] for i in np.nonzero(held)[0]], target[held], max_error)


def _calibrated(model: Model, rows: list[Row], target: np.ndarray, max_error: float) -> Model:
    known = np.array([letter for *_, letter in rows], bool)
    if not known.any():
        return model
    vectors = np.array([w @ model.embeddings[f] for f, w, letter in rows if letter])
    logits, target = vectors @ model.layer + model.bias, target[known]
    at = np.arange(len(target))

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.probabilities(logits)[at, target], 1e-12)).mean()

    model.temperature = min(np.geomspace(0.05, 5, 41), key=loss)
    p = model.probabilities(logits)
    score, wrong = p.max(1), p.argmax(1) != target
    order = np.argsort(-score, kind="stable")
    n = np.arange(1, len(order) + 1)
    error = np.cumsum(wrong[order]) / n
    noise = error[len(order) // 2]  # disagreement where the model is surest: wrong labels
    bound = min(noise + max_error, 1.0)
    fine = np.nonzero(error <= bound + 2 * np.sqrt(bound * (1 - bound) / n))[0]
    last = max(fine[-1] if len(fine) else 0, len(order) - 1 - int(MAX_REJECTED * len(order)))
    if last + 1 < len(order):  # the accepted rows end where the error would exceed the bound for good
        model.bar = float(score[order[last]])
    return model


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows_per_language: int = ROWS_PER_LANGUAGE,
           max_rows: int = MAX_ROWS) -> tuple[list[Row], list[str]]:
    """(features, languages) of the sample, in the order of the ids' hashes. Ids and languages
    alone are chosen from; texts are read for the chosen ids and stay in the tasks."""
    named = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    ids = materialize(named.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).distinct()
                      .withColumn("h", F.xxhash64(F.col("id").cast("string"))), "lang-ids")
    size = ids.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    # hashes spread evenly, so some times the wanted share surely holds the rows wanted
    share = F.least(F.lit(1.0), (8 * rows_per_language + 1000) / F.col("n"))
    small = ids.join(F.broadcast(size.orderBy(F.desc("n"), "of").limit(max_rows)), F.col("lang") == F.col("of")).where(
        F.shiftrightunsigned("h", 11) < share * (1 << 53))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    chosen = materialize(small.withColumn("rank", rank).where(F.col("rank") <= rows_per_language)
                         .orderBy("rank", "lang").limit(max_rows).select("id").distinct(), "lang-chosen")
    rows = (named.where(F.col(text_col).isNotNull()).join(F.broadcast(chosen), F.col(id_col) == F.col("id"), "left_semi")
            .select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"),
                    F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(len(b)):
                some, share, letter = features(b["text"].iloc[k])
                yield pd.DataFrame({"lang": [b["lang"].iloc[k]], "h": [b["h"].iloc[k]], "t": [b["t"].iloc[k]],
                                    "some": [some.astype(np.int32)], "share": [share], "letter": [letter]})

    made = rows.mapInPandas(run, "lang string, h long, t long, some array<int>, share array<float>, letter boolean")
    found = materialize(made, "lang-sample").orderBy("h", "t", "lang").limit(max_rows).toPandas()
    return ([(np.asarray(r.some, np.int64), np.asarray(r.share, np.float32), bool(r.letter)) for r in found.itertuples()],
            found["lang"].tolist())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        learn: Column | None = None, **bounds: int) -> Model:
    """Train on the sample of the rows of ``docs`` for which ``learn`` holds (default: all)."""
    docs = docs.select(id_col, text_col, lang_col)
    return train(*sample(docs.where(learn) if learn is not None else docs, id_col, text_col, lang_col, **bounds))


def predicted(text: Column, model: Model) -> Column:
    """struct(lang_pred, score, accepted) of a text column."""
    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [model.predict(some) for some in slices(texts.tolist())]
            language = np.concatenate([p[0] for p in parts]) if parts else np.array([], object)
            score = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
            yield pd.DataFrame({"lang_pred": language, "score": score,
                                "accepted": (language != UNKNOWN) & (score >= model.bar)})

    return run(text)


def accept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``, all columns, without the rows that the model rejects."""
    model, name = fit(docs, id_col, text_col, lang_col), fresh("_lang", docs)
    judged = docs.withColumn(name, predicted(F.col(text_col), model))
    return judged.where(F.col(name)["accepted"]).drop(name)
