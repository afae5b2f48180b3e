"""URL filter: allow and block rules on hosts and paths, then a weighted vocabulary.

A rule ``host/path`` fits an URL of its host or a subdomain whose path starts with the
rule's; the longest fitting rule decides. Every other URL is judged by the vocabulary:
one Aho-Corasick automaton over the lower-cased bytes finds all terms in one pass; a
hit counts if neither neighbour is an ASCII letter or digit. One strict term, or
``min_soft`` distinct soft terms, reject the URL. The automaton is a table of
(states x 256) whose size depends on the vocabulary alone; tasks step it over a matrix
of URLs, one character position of many URLs at a time.

Edge cases: a null URL, or one without ``://``, has an empty host and path, so no rule
fits; the vocabulary judges its text (null: no hit, allowed). Rows are independent: ids
may be null or repeated, an empty table gives an empty result, other columns are dropped.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the rules as (verdict, host and path), and the vocabulary with its weights
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
STRICT = 1.0
VOCABULARY = {
    "casino": 1.0, "porn": 1.0, "xxx": 1.0, "viagra": 1.0, "escort": 1.0, "spam": 1.0, "malware": 1.0,
    "adult": 0.5, "ads": 0.5, "bet": 0.5, "cheap": 0.5, "click": 0.5, "farm": 0.5, "free": 0.5, "loan": 0.5,
    "pills": 0.5, "poker": 0.5, "sex": 0.5, "track": 0.5, "win": 0.5,
}
MIN_SOFT = 2
_CELLS = 1 << 22  # cells of one URL matrix: bounds a task's memory, whatever the batch


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]], pick) -> Column:
    """``pick(verdict, rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        out = F.when(fits, F.lit(pick(verdict, rule))).otherwise(out)
    return out


class Automaton:
    """Aho-Corasick over bytes: ``step[state, byte]`` and the terms that end in a state."""

    def __init__(self, terms: list[str]):
        self.lengths = [len(t.encode()) for t in terms]
        step, ends = [[-1] * 256], [[]]
        for k, term in enumerate(terms):
            s = 0
            for b in term.lower().encode():
                if step[s][b] < 0:
                    step[s][b] = len(step)
                    step.append([-1] * 256)
                    ends.append([])
                s = step[s][b]
            ends[s].append(k)
        back, todo = [0] * len(step), deque()
        for b in range(256):
            t = step[0][b]
            step[0][b] = max(t, 0)
            if t > 0:
                todo.append(t)
        while todo:  # breadth first: a state's fallback is shorter and thus complete
            s = todo.popleft()
            ends[s] = ends[s] + ends[back[s]]
            for b in range(256):
                t = step[s][b]
                if t < 0:
                    step[s][b] = step[back[s]][b]
                else:
                    back[t] = step[back[s]][b]
                    todo.append(t)
        self.step, self.ends = np.array(step, np.int32), ends
        self.final = np.array([bool(e) for e in ends])

    def hits(self, rows: list[bytes]) -> np.ndarray:
        """Boolean matrix (rows x terms): which terms occur between boundaries."""
        found = np.zeros((len(rows), len(self.lengths)), bool)
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        while order:
            n, width = 0, 0
            while n < len(order) and (n == 0 or (n + 1) * (len(rows[order[n]]) + 2) <= _CELLS):
                width, n = len(rows[order[n]]) + 2, n + 1
            some, order = order[:n], order[n:]
            text = b"".join(b"\0" + rows[i] + b"\0" * (width - 1 - len(rows[i])) for i in some)
            found[some] = self._scan(np.frombuffer(text, np.uint8).reshape(n, width))
        return found

    def _scan(self, m: np.ndarray) -> np.ndarray:
        m = np.where((m >= 65) & (m <= 90), m + 32, m).astype(np.uint8)
        inside = ((m >= 97) & (m <= 122)) | ((m >= 48) & (m <= 57))
        found = np.zeros((len(m), len(self.lengths)), bool)
        state = np.zeros(len(m), np.int32)
        for j in range(1, m.shape[1] - 1):
            state = self.step[state, m[:, j]]
            at = np.nonzero(self.final[state])[0]
            for s in np.unique(state[at]):
                here = at[state[at] == s]
                for k in self.ends[s]:
                    ok = ~inside[here, j + 1] & ~inside[here, j - self.lengths[k]]
                    found[here[ok], k] = True
        return found


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES,
          vocabulary: dict[str, float] = VOCABULARY, min_soft: int = MIN_SOFT) -> DataFrame:
    """(id, host, path, rule, verdict, strict_hits, soft_hits, weight): the hits are numbers
    of distinct terms and ``weight`` the sum of their weights."""
    url = F.col(url_col)
    base = pages.select(F.col(id_col), url.alias("url")).select(
        F.col(id_col), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "url")
    named = base.select(
        id_col, "host", "path",
        longest_rule(F.col("host"), F.col("path"), rules, lambda v, r: r).alias("rule"),
        longest_rule(F.col("host"), F.col("path"), rules, lambda v, r: v).alias("verdict"), "url")
    terms = sorted(vocabulary)
    weights = np.array([vocabulary[t] for t in terms])
    automaton = Automaton(terms)
    id_type = pages.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = automaton.hits([(u or "").encode() for u in b.column("url").to_pylist()])
            strict, soft = found[:, weights >= STRICT].sum(1), found[:, weights < STRICT].sum(1)
            bad = (strict >= 1) | (soft >= min_soft)
            method = pa.array(np.where(bad, "block", "allow").tolist(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(4)), pc.coalesce(b.column("verdict"), method),
                 pa.array(strict, pa.int64()), pa.array(soft, pa.int64()), pa.array(found @ weights, pa.float64())],
                [id_col, "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "weight"])

    return named.mapInArrow(score, f"{id_col} {id_type}, host string, path string, rule string, verdict string, "
                                   "strict_hits long, soft_hits long, weight double")


def sql(rules: list[tuple[str, str]] = RULES, vocabulary: dict[str, float] = VOCABULARY,
        min_soft: int = MIN_SOFT) -> str:
    """The same judgement as DuckDB SQL over ``pages``, each term as a regular expression."""
    def hit(term: str) -> str:
        return f"regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INT"

    strict = " + ".join(hit(t) for t in vocabulary if vocabulary[t] >= STRICT)
    soft = " + ".join(hit(t) for t in vocabulary if vocabulary[t] < STRICT)
    weight = " + ".join(f"{vocabulary[t]} * {hit(t)}" for t in vocabulary)
    values = ", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for v, r in rules)
    return f"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
  FROM p),
r(verdict, h, p, rule) AS (VALUES {values}),
best AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM q JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n),
s AS (SELECT *, {strict} AS strict_hits, {soft} AS soft_hits, {weight} AS weight FROM q)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN strict_hits >= 1 OR soft_hits >= {min_soft} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits::BIGINT AS strict_hits, soft_hits::BIGINT AS soft_hits, weight::DOUBLE AS weight
FROM s LEFT JOIN best USING (n)"""
