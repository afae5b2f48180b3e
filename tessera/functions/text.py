"""Text cleaning and tokenising column functions.

Every cleaner is a list of steps. ``clean_text`` turns the steps into native
Catalyst expressions (lower / regexp_replace / translate / trim), so cleaning
runs inside whole-stage codegen. ``clean_sql`` renders the same steps as a
DuckDB expression for the oracle queries. Regexes are written with explicit
classes (no ``\\w \\s \\S \\b``) so Java regex and RE2 read them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import ENGLISH_STOP_WORDS, LEMMAS, PUNCTUATION

WS_CLASS = "[ \\t\\n\\r\\f\\x0B]"
NON_WS_CLASS = "[^ \\t\\n\\r\\f\\x0B]"
WORD_CLASS = "[\\p{L}\\p{N}_]"

# Named regexes, each equal in Java and RE2.
RE_DIGITS = "[0-9]+"
RE_URL = "http" + NON_WS_CLASS + "+"
RE_MENTION = "@" + WORD_CLASS + "+"
RE_HASH = "#"
RE_NON_ALPHA_SPACE = "[^a-zA-Z ]"
RE_NON_ALPHA_WS = "[^a-zA-Z \\t\\n\\r\\f\\x0B]"
RE_HTML_TAG = "<.*?>"
RE_NON_SUMMARY = "[^a-zA-Z0-9.,!? ]"
RE_WS_RUN = WS_CLASS + "+"
# Unicode word token of two or more characters (TF-IDF default tokens).
RE_WORD2 = WORD_CLASS + "{2,}"
RE_ALPHA = "[a-zA-Z]+"


# Steps: ("lower",) ("coalesce",) ("re", pattern, replacement) ("delete", chars)
# ("to_space", chars) ("ws",) ("trim",)
CLEANERS: dict[str, list[tuple]] = {
    # T1 preprocessing pipeline
    "pipeline": [("coalesce",), ("lower",), ("re", RE_DIGITS, ""), ("delete", PUNCTUATION),
                 ("re", RE_NON_ALPHA_WS, ""), ("ws",), ("trim",)],
    # T2 news
    "news": [("lower",), ("re", RE_URL, ""), ("re", RE_MENTION, ""), ("re", RE_HASH, ""),
             ("re", RE_NON_ALPHA_SPACE, " ")],
    # T3 / T5 email and model comparison (digits kept)
    "email": [("lower",), ("re", RE_URL, ""), ("delete", PUNCTUATION)],
    # T4 sentiment
    "sentiment": [("lower",), ("delete", PUNCTUATION), ("re", RE_DIGITS, "")],
    # T6 tuning
    "tuning": [("lower",), ("delete", PUNCTUATION), ("re", RE_DIGITS, ""), ("ws",), ("trim",)],
    # T7 intent
    "intent": [("lower",), ("trim",), ("re", RE_NON_ALPHA_SPACE, ""), ("ws",), ("trim",)],
    # T8 language (all scripts kept)
    "lang": [("lower",), ("ws",), ("trim",)],
    # T9 chatbot regex path: punctuation becomes space
    "chat": [("lower",), ("to_space", PUNCTUATION)],
    # T10 summariser; newlines are deleted before the whitespace collapse
    "summary": [("lower",), ("re", RE_URL, ""), ("re", RE_HTML_TAG, ""),
                ("re", RE_NON_SUMMARY, ""), ("ws",), ("trim",)],
    # T11 whitespace collapse + trim
    "whitespace": [("ws",), ("trim",)],
    # tag stripping only (pages.html)
    "strip_html": [("re", RE_HTML_TAG, ""), ("ws",), ("trim",)],
}

# Token post-processing per cleaner: (split on whitespace, drop stop words,
# drop 1-char tokens, lemma part of speech or None).
TOKEN_STEPS: dict[str, tuple[bool, bool, bool, str | None]] = {
    "news": (True, True, False, "n"),
    "email": (True, True, False, "n"),
    "sentiment": (True, True, False, "n"),
    "tuning": (True, True, True, "n"),
    "intent": (True, False, False, "n"),
    "chat": (True, False, False, None),
}


def clean_text(col: Column | str, steps: list[tuple] | str) -> Column:
    """Apply cleaner steps (or a named cleaner) as native expressions."""
    if isinstance(steps, str):
        steps = CLEANERS[steps]
    c = F.col(col) if isinstance(col, str) else col
    for step in steps:
        kind = step[0]
        if kind == "lower":
            c = F.lower(c)
        elif kind == "coalesce":
            c = F.coalesce(c, F.lit(""))
        elif kind == "re":
            c = F.regexp_replace(c, step[1], step[2])
        elif kind == "delete":
            c = F.translate(c, step[1], "")
        elif kind == "to_space":
            c = F.translate(c, step[1], " " * len(step[1]))
        elif kind == "ws":
            c = F.regexp_replace(c, RE_WS_RUN, " ")
        elif kind == "trim":
            c = F.trim(c)
        else:
            raise ValueError(f"unknown step {kind}")
    return c


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(expr: str, steps: list[tuple] | str) -> str:
    """The same cleaner as a DuckDB SQL expression (for oracle queries)."""
    if isinstance(steps, str):
        steps = CLEANERS[steps]
    e = expr
    for step in steps:
        kind = step[0]
        if kind == "lower":
            e = f"lower({e})"
        elif kind == "coalesce":
            e = f"coalesce({e}, '')"
        elif kind == "re":
            e = f"regexp_replace({e}, {_sql_str(step[1])}, {_sql_str(step[2])}, 'g')"
        elif kind == "delete":
            e = f"translate({e}, {_sql_str(step[1])}, '')"
        elif kind == "to_space":
            e = f"translate({e}, {_sql_str(step[1])}, {_sql_str(' ' * len(step[1]))})"
        elif kind == "ws":
            e = f"regexp_replace({e}, {_sql_str(RE_WS_RUN)}, ' ', 'g')"
        elif kind == "trim":
            e = f"trim({e}, ' ')"
        else:
            raise ValueError(f"unknown step {kind}")
    return e


# ---------------------------------------------------------------- tokens

def split_ws(col: Column | str) -> Column:
    """``str.split()``: whitespace split without empty tokens."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(c, RE_WS_RUN), lambda x: x != "")


def split_ws_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {_sql_str(RE_WS_RUN)}), lambda x: x <> '')"


def tokenize_alpha(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(RE_ALPHA), 0)


def tokenize_alpha_sql(expr: str) -> str:
    return f"regexp_extract_all({expr}, {_sql_str(RE_ALPHA)})"


def word_tokens(col: Column | str) -> Column:
    """Lower-cased Unicode word tokens of two or more characters."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(c), F.lit(RE_WORD2), 0)


def word_tokens_sql(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {_sql_str(RE_WORD2)})"


def remove_stop(tokens: Column, words=ENGLISH_STOP_WORDS, min_len: int = 0) -> Column:
    """Drop stop words from a token array. ``isin`` over a literal list becomes a
    hash-set lookup (InSet) in the optimizer, not a scan of the list per token."""
    words = list(words)
    if min_len:
        return F.filter(tokens, lambda x: ~x.isin(words) & (F.length(x) > min_len))
    return F.filter(tokens, lambda x: ~x.isin(words))


def stop_list_sql(words=ENGLISH_STOP_WORDS) -> str:
    return "[" + ", ".join(_sql_str(w) for w in words) + "]"


def remove_stop_sql(tokens: str, words=ENGLISH_STOP_WORDS, min_len: int = 0) -> str:
    cond = f"NOT list_contains({stop_list_sql(words)}, x)"
    if min_len:
        cond += f" AND length(x) > {min_len}"
    return f"list_filter({tokens}, lambda x: {cond})"


def lemma_map(pos: str, lemmas=LEMMAS) -> Column:
    kv = []
    for tok, p, lem in lemmas:
        if p == pos:
            kv += [F.lit(tok), F.lit(lem)]
    return F.create_map(*kv)


def lemmatize(tokens: Column, pos: str = "n", lemmas=LEMMAS) -> Column:
    """Dictionary lemma per token; unknown tokens pass through."""
    m = lemma_map(pos, lemmas)
    return F.transform(tokens, lambda x: F.coalesce(F.try_element_at(m, x), x))


def lemmatize_sql(tokens: str, pos: str = "n", lemmas=LEMMAS) -> str:
    cases = " ".join(f"WHEN {_sql_str(t)} THEN {_sql_str(l)}" for t, p, l in lemmas if p == pos)
    return f"list_transform({tokens}, lambda x: CASE x {cases} ELSE x END)"


def clean_tokens(col: Column | str, name: str) -> Column:
    """Named cleaner followed by its token steps; returns array<string>."""
    toks = split_ws(clean_text(col, name))
    _, stop, drop1, pos = TOKEN_STEPS[name]
    if stop:
        toks = remove_stop(toks, min_len=1 if drop1 else 0)
    if pos:
        toks = lemmatize(toks, pos)
    return toks


def clean_tokens_sql(expr: str, name: str) -> str:
    toks = split_ws_sql(clean_sql(expr, name))
    _, stop, drop1, pos = TOKEN_STEPS[name]
    if stop:
        toks = remove_stop_sql(toks, min_len=1 if drop1 else 0)
    if pos:
        toks = lemmatize_sql(toks, pos)
    return toks


def sentence_split(col: Column | str) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; no empty sentences."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(c, "(?<=[.!?])" + RE_WS_RUN), lambda x: x != "")


def sentence_split_sql(expr: str) -> str:
    # RE2 has no look-behind: mark each boundary first, then split on the mark.
    marked = f"regexp_replace({expr}, '([.!?]){RE_WS_RUN}', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda x: x <> '')"


def ngrams_sql_expr(tokens: str, lo: int, hi: int) -> str:
    """Spark SQL text of the n-grams of ``lo`` to ``hi`` tokens of an array, joined by spaces."""
    parts = [tokens if n == 1 else
             f"transform(filter(sequence(1, greatest(size({tokens}) - {n - 1}, 1)), i -> i + {n - 1} <= size({tokens})), "
             f"i -> array_join(slice({tokens}, i, {n}), ' '))" for n in range(lo, hi + 1)]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def char_ngrams_sql_expr(text: str, lo: int, hi: int) -> str:
    """Spark SQL text of all runs of ``lo`` to ``hi`` characters of a text: one pass of a look-ahead a
    length (a substring a position would rescan the text from its start)."""
    parts = [f"regexp_extract_all({text}, '(?s)(?=(.{{{n}}}))', 1)" for n in range(lo, hi + 1)]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """The n-grams of ``lo`` to ``hi`` tokens; an array with fewer tokens has none of that size."""
    def of(t: Column, n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(1))), lambda i: i + (n - 1) <= F.size(t))
        return t if n == 1 else F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))

    # the tokens are a lambda's variable, so they are computed once a row
    return F.get(F.transform(F.array(tokens), lambda t: F.concat(*[of(t, n) for n in range(lo, hi + 1)])), F.lit(0))
