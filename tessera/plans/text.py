"""Text cleaning, tokenising and text-statistics queries over ``documents``/``pages``."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import POSITIVE_LABEL_NAMES
from ..functions.scalar import round_half_away as rnd
from ..functions.stem import merged, stem_lists, stem_sql
from ..operators import tfidf
from ..sources.tables import Tables
from . import register


def _docs(spark, sf):
    return Tables(spark, sf).documents


def _clean_query(name: str, tokens: bool):
    if tokens:
        sql = f"SELECT doc_id, array_to_string({X.clean_tokens_sql('text', name)}, ' ') AS clean FROM documents"

        def fn(spark, sf):
            return _docs(spark, sf).select("doc_id", F.array_join(X.clean_tokens("text", name), " ").alias("clean"))
    else:
        sql = f"SELECT doc_id, {X.clean_sql('text', name)} AS clean FROM documents"

        def fn(spark, sf):
            return _docs(spark, sf).select("doc_id", X.clean_text("text", name).alias("clean"))
    fn.__doc__ = f"Cleaner '{name}' over every document."
    register(f"clean_{name}", sql)(fn)


for _name, _tok in (("pipeline", False), ("news", True), ("email", True), ("sentiment", True),
                    ("tuning", True), ("intent", True), ("lang", False), ("chat", True), ("summary", False)):
    _clean_query(_name, _tok)


@register("strip_html", f"SELECT page_id, {X.clean_sql('html', 'strip_html')} AS text FROM pages")
def strip_html(spark, sf):
    """T10 tag stripping on raw web pages."""
    return Tables(spark, sf).pages.select("page_id", X.clean_text("html", "strip_html").alias("text"))


@register("tokenize_alpha", f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {X.tokenize_alpha_sql(X.clean_sql('text', 'pipeline'))} AS t FROM documents)""")
def tokenize_alpha(spark, sf):
    """F1 on T1-cleaned text."""
    t = X.tokenize_alpha(X.clean_text("text", "pipeline"))
    return _docs(spark, sf).select("doc_id", F.size(t).cast("bigint").alias("n_tokens"),
                                   F.array_join(t, " ").alias("tokens"))


_PIPE_SQL = X.lemmatize_sql(X.remove_stop_sql(X.tokenize_alpha_sql(X.clean_sql("text", "pipeline"))), "v")


@register("preprocess_pipeline", f"SELECT doc_id, array_to_string({_PIPE_SQL}, ' ') AS processed FROM documents")
def preprocess_pipeline(spark, sf):
    """T1 → F1 → stop words → verb lemmas, joined with spaces (``process_csv``)."""
    toks = X.lemmatize(X.remove_stop(X.tokenize_alpha(X.clean_text("text", "pipeline"))), "v")
    return _docs(spark, sf).select("doc_id", F.array_join(toks, " ").alias("processed"))


_STOPPED_SQL = X.remove_stop_sql(X.tokenize_alpha_sql(X.clean_sql("text", "pipeline")))


@register("stem_tokens", f"""
WITH t AS (SELECT doc_id, {_STOPPED_SQL} AS ts FROM documents),
tok AS (SELECT doc_id, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM t),
{stem_sql("tok", "token")}
SELECT doc_id, count(*) AS n_tokens, string_agg(stem, ' ' ORDER BY pos) AS stemmed
FROM tok JOIN stems ON word = token GROUP BY doc_id""")
def stem_tokens_q(spark, sf):
    """2.14: T1 → F1 → stop words → Porter stems, joined with spaces in token order."""
    toks = X.remove_stop(X.tokenize_alpha(X.clean_text("text", "pipeline")))
    rows = _docs(spark, sf).select(F.struct("doc_id").alias("key"), "text").repartition("key").select("key", toks.alias("t"))
    each = stem_lists(rows.where(F.size("t") > 0), "key", ["t"]).groupBy("key").agg(F.collect_list("t").alias("t"))
    each = each.select("key.doc_id", merged(F.col("t")).alias("t"))
    return each.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("stemmed"))


@register("sentence_split", f"""
SELECT doc_id, s.idx AS sent_idx, s.sentence FROM (
  SELECT doc_id, unnest(list_transform(ss, lambda x, i: {{'idx': i - 1, 'sentence': x}})) AS s
  FROM (SELECT doc_id, {X.sentence_split_sql(X.clean_sql('text', 'whitespace'))} AS ss FROM documents))""")
def sentence_split(spark, sf):
    """sentences of the whitespace-normalised text, one row each with its index."""
    ss = X.sentence_split(X.clean_text("text", "whitespace"))
    return _docs(spark, sf).select("doc_id", F.posexplode(ss).alias("sent_idx", "sentence")) \
        .select("doc_id", F.col("sent_idx").cast("bigint").alias("sent_idx"), "sentence")


WORD_TOKEN_RE = "[\\p{L}\\p{N}_]+|[^ \\t\\n\\r\\f\\x0B\\p{L}\\p{N}_]"


@register("text_statistics", f"""
SELECT doc_id, length(text) AS n_characters,
       len(regexp_extract_all(text, '{WORD_TOKEN_RE}')) AS n_words,
       len({X.sentence_split_sql(X.clean_sql('text', 'whitespace'))}) AS n_sentences
FROM documents""")
def text_statistics(spark, sf):
    """Characters, word tokens (F3) and sentences (F4) per document."""
    d = _docs(spark, sf)
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_characters"),
                    F.size(F.regexp_extract_all("text", F.lit(WORD_TOKEN_RE), 0)).cast("bigint").alias("n_words"),
                    F.size(X.sentence_split(X.clean_text("text", "whitespace"))).cast("bigint").alias("n_sentences"))


def _ngrams(tokens, n: int):
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
                                                    lambda i: F.array_join(F.slice(tokens, i, n), " "))) \
        .otherwise(F.array().cast("array<string>"))


def _ngrams_sql(t: str, n: int) -> str:
    return f"list_transform(range(1, len({t}) - {n - 2}), lambda i: array_to_string({t}[i:i + {n - 1}], ' '))"


_SENT_TOK_SQL = X.clean_tokens_sql("text", "sentiment")


def _each(body):
    return lambda x: body(x)


def _gram_counts(docs, grams: dict, prefix: str):
    """Per-document n-gram totals per n and the distinct count. A document's terms are one array, whose
    distinct ones are a hash set a row, so no n-gram is a row; repeated ids are counted together."""
    source = docs.columns[-1]
    own = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.collect_list(source).alias("_all"), F.count(F.lit(1)).alias("_rows"))
    every = own.select("doc_id", "_rows", *[F.flatten(F.transform("_all", _each(g))).alias(f"_{n}") for n, g in grams.items()])
    counts = every.select("doc_id", "_rows", *[F.size(f"_{n}").cast("bigint").alias(f"{prefix}{n}") for n in grams],
                          F.size(F.array_distinct(F.concat(*[F.col(f"_{n}") for n in grams]))).cast("bigint").alias("n_distinct"))
    names = [f"{prefix}{n}" for n in grams] + ["n_distinct"]
    unnamed = docs.where(F.col("doc_id").isNull()).select("doc_id", *[F.lit(0).cast("bigint").alias(c) for c in names])
    return counts.select("doc_id", *names, F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))).drop("col").unionByName(unnamed)


def _gram_sql(grams: dict[int, str], prefix: str, source: str) -> str:
    parts = " UNION ALL ".join(f"SELECT doc_id, {n} AS n, unnest({g}) AS g FROM src" for n, g in grams.items())
    cols = ", ".join(f"coalesce(count(*) FILTER (WHERE e.n = {n}), 0) AS {prefix}{n}" for n in grams)
    return f"""
WITH src AS ({source}), e AS ({parts})
SELECT d.doc_id, {cols}, count(DISTINCT e.g) AS n_distinct
FROM documents d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id"""


@register("word_ngrams", _gram_sql({1: "t", 2: _ngrams_sql("t", 2), 3: _ngrams_sql("t", 3)}, "n_",
                                   f"SELECT doc_id, {_SENT_TOK_SQL} AS t FROM documents"))
def word_ngrams(spark, sf):
    """Word n-grams for ngram_range (1, 3) on sentiment-cleaned tokens."""
    d = _docs(spark, sf).select("doc_id", X.clean_tokens("text", "sentiment").alias("t"))
    return _gram_counts(d, {1: lambda t: t, 2: lambda t: _ngrams(t, 2), 3: lambda t: _ngrams(t, 3)}, "n_")


def _char_ngrams(c, n: int):
    # Overlapping n-grams in one linear regex pass (a zero-width look-ahead
    # capture at every position); positional substring would rescan UTF-8
    # from the start for every position.
    return F.regexp_extract_all(c, F.lit("(?s)(?=(.{%d}))" % n), 1)


def _char_ngrams_sql(c: str, n: int) -> str:
    return f"list_transform(range(1, length({c}) - {n - 2}), lambda i: substring({c}, i, {n}))"


@register("char_ngrams", _gram_sql({n: _char_ngrams_sql("c", n) for n in (2, 3, 4)}, "n_char",
                                   f"SELECT doc_id, {X.clean_sql('text', 'lang')} AS c FROM documents"))
def char_ngrams(spark, sf):
    """Character 2-4-grams spanning spaces, on language-cleaned text."""
    d = _docs(spark, sf).select("doc_id", X.clean_text("text", "lang").alias("c"))
    return _gram_counts(d, {n: partial(_char_ngrams, n=n) for n in (2, 3, 4)}, "n_char")


_TFIDF_SQL = f"""
tok AS (SELECT doc_id, unnest({X.word_tokens_sql('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w0 AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
       FROM tf JOIN dfs USING (term)),
w AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w0)"""


def doc_tfidf(docs, n_docs=None):
    # texts are dealt out once: a document's terms are then counted and its norm taken without a shuffle
    tf = tfidf.term_counts(docs.select(F.col("doc_id").alias("doc"), "text").repartition("doc"), "doc", X.word_tokens("text"))
    n = docs.select(F.count(F.lit(1))).scalar() if n_docs is None else n_docs
    return tfidf.tfidf(tf, n_docs=n)


@register("tfidf_weights", f"""
WITH {_TFIDF_SQL}
SELECT doc_id, term, round(w, 6) AS weight FROM w""")
def tfidf_weights(spark, sf):
    """X1 long form: smoothed idf, raw tf, L2 rows; documents without tokens have no rows."""
    w = doc_tfidf(_docs(spark, sf))
    return w.select(F.col("doc").alias("doc_id"), "term", rnd("weight", 6).alias("weight"))


@register("top_vocabulary", f"""
SELECT term, n, rank FROM (
  SELECT term, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, term ASC) AS rank
  FROM (SELECT unnest({X.word_tokens_sql('text')}) AS term FROM documents) GROUP BY term)
WHERE rank <= 5000""")
def top_vocabulary(spark, sf, size: int = 5000):
    """Vocabulary cap — the ``size`` most frequent terms over the corpus.

    The global top-k is a ``TakeOrderedAndProject`` (each task keeps its own
    top k, the driver merges k per task), not a full sort.
    """
    counts = (_docs(spark, sf).select(F.explode(X.word_tokens("text")).alias("term"))
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.desc("n"), F.asc("term")).limit(size)
    return top.select("term", "n", F.row_number().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy(F.desc("n"), F.asc("term")))
        .cast("bigint").alias("rank"))


_WS_TRIM = "'^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$'"


@register("min_length_docs", f"""
SELECT doc_id, length(regexp_replace(text, {_WS_TRIM}, '', 'g')) AS n_chars FROM documents
WHERE length(regexp_replace(text, {_WS_TRIM}, '', 'g')) >= 50""")
def min_length_docs(spark, sf, min_chars: int = 50):
    """Documents whose stripped text has at least ``min_chars`` characters."""
    stripped = F.regexp_replace("text", "^" + X.RE_WS_RUN + "|" + X.RE_WS_RUN + "$", "")
    return _docs(spark, sf).select("doc_id", F.length(stripped).cast("bigint").alias("n_chars")) \
        .where(F.col("n_chars") >= min_chars)


@register("label_distribution", "SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang")
def label_distribution(spark, sf):
    """A5: value counts of the label column."""
    return _docs(spark, sf).groupBy(F.col("lang").alias("label")).agg(F.count(F.lit(1)).alias("n"))


_LABELLED_SQL = "SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"


def _labelled(spark, sf):
    t = Tables(spark, sf)
    return t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left")


@register("null_profile", f"""
SELECT count(*) AS n_rows, 4 AS n_cols, count(*) - count(text) AS null_text,
       count(*) - count(quality) AS null_quality, count(*) - count(toxic) AS null_toxic
FROM ({_LABELLED_SQL})""")
def null_profile(spark, sf):
    """P5: shape and null count per column of documents ⟕ labels."""
    d = _labelled(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(d.columns)).alias("n_cols"),
                 *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("text", "quality", "toxic")])


@register("drop_null_rows", f"""
SELECT doc_id, quality FROM ({_LABELLED_SQL}) WHERE text IS NOT NULL AND quality IS NOT NULL""")
def drop_null_rows(spark, sf):
    """Rows with a null text or label dropped."""
    return _labelled(spark, sf).dropna(subset=["text", "quality"]).select("doc_id", "quality")


def positive_class(labels_df, label: str):
    """First sorted class whose lower case is a positive name, else the last class."""
    names = F.array(*[F.lit(x) for x in POSITIVE_LABEL_NAMES])
    classes = labels_df.select(F.col(label).cast("string").alias("c")).where(F.col("c").isNotNull())
    agg = classes.agg(F.min(F.when(F.array_contains(names, F.lower("c")), F.col("c"))).alias("p"),
                      F.max("c").alias("last"))
    return agg.select(F.coalesce("p", "last")).scalar()


@register("binarize_label", f"""
WITH d AS (SELECT doc_id, CAST(quality AS VARCHAR) AS label FROM labels),
p AS (SELECT coalesce(min(label) FILTER (WHERE lower(label) IN ({', '.join(f"'{x}'" for x in POSITIVE_LABEL_NAMES)})),
                      max(label)) AS pos FROM d)
SELECT doc_id, label, CAST(label = (SELECT pos FROM p) AS INTEGER) AS y FROM d""")
def binarize_label(spark, sf):
    """P13 on the quality label of ``labels``."""
    d = Tables(spark, sf).labels.select("doc_id", F.col("quality").cast("string").alias("label"))
    pos = positive_class(d, "label")
    return d.select("doc_id", "label", (F.col("label") == pos).cast("int").alias("y"))
