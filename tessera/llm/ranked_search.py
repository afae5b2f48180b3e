"""Ranked lexical search with presence-mask grouping.

Terms are runs of ASCII letters and digits and of all other code points, A-Z lower-cased. An
item is a bag of distinct terms; a document's score is the sum over the item's terms of
``w * tf / (tf + length part)`` in whole numbers (``search``). Every document is scored for
every item, ``top`` documents are kept.

* One pass over the texts writes, for each document, its number of terms and the counts of
  those that some item has. The counts of documents and terms follow from that table.
* Mask grouping. A task takes blocks of documents of about equal length and turns them into
  presence bitmaps, a row of bits for each term. For an item the bits of its terms give each
  document's matched-term mask. Documents are grouped by mask; a mask's highest possible
  score is the sum of the weights of its terms, each times the term's best contribution
  in the block. Distinct masks are evaluated by descending maximum until the next maximum
  lies below the item's worst kept score: no document behind it can enter, ties included.
* Each task keeps ``top`` documents an item, which are ranked in two steps, first in salted
  groups, so no task holds all tasks' rows of an item.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms (one item may have more); a
block's terms go to the tasks, and each block reads the documents once.

Edge cases: null and empty texts have no terms, match nothing and count as no document; an
item without terms has no rows; items of the same id are one item; rows that repeat a document are
ranked each; equal scores go by ascending id, null first; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._batch import coded, slices
from ._shared import materialize

TOP = 10
BLOCK_TERMS = 50_000
SALTS = 64
_CELLS = 1 << 23  # (terms x documents) of one block of a task
_STEP = 64  # masks evaluated at once
# every byte that separates terms becomes a space, A-Z become a-z
_TERM_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


def _item_blocks(items: DataFrame, block_terms: int) -> Iterator[dict]:
    """{item id: its distinct terms}, blocks of about ``block_terms`` terms in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, t in enumerate(b.column("text")):
                own = sorted(set(terms(t.as_py() or "")))
                yield pa.RecordBatch.from_arrays([pa.array([b.column("item")[k].as_py()] * len(own), b.schema.field("item").type),
                                                  pa.array(own, pa.binary())], ["item", "term"])

    kind = items.schema["item"].dataType.simpleString()
    each = materialize(items.mapInArrow(run, f"item {kind}, term binary").distinct(), "search-items")
    n = max(1, -(-each.count() // block_terms))
    while True:
        block = F.pmod(F.xxhash64("item"), F.lit(n))
        sizes = each.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("terms"), F.countDistinct("item").alias("items"))
        if not sizes.where((F.col("terms") > 2 * block_terms) & (F.col("items") > 1)).limit(1).count():
            break
        n *= 2
    for k in range(n):
        found: dict = {}
        for r in each.where(block == k).toLocalIterator():
            found.setdefault(r["item"], []).append(bytes(r["term"]))
        if found:
            yield found


def _counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc, n, terms, tfs): the number of terms of each row of ``docs`` (doc, text) that has one,
    and the counts of the terms in ``vocabulary``, by their numbers."""
    number = {t: k for k, t in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for some in slices(t.as_py() for t in b.column("text")):
                words, codes, ends = coded(some, terms)
                size = np.diff(ends, prepend=0)
                doc = np.repeat(np.arange(len(some)), size)
                own = np.array([number.get(w, -1) for w in words] or [-1], np.int64)
                term = own[codes] if len(codes) else np.zeros(0, np.int64)
                pair, tf = np.unique((doc * len(number) + term)[term >= 0], return_counts=True)
                hits = np.bincount(pair // max(1, len(number)), minlength=len(some))
                ends = np.concatenate([[0], np.cumsum(hits)])
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32()))
                         for v in (pair % max(1, len(number)), tf)]
                out = pa.RecordBatch.from_arrays([b.column("doc").slice(at, len(some)), pa.array(size, pa.int64()), *lists],
                                                 ["doc", "n", "terms", "tfs"])
                at += len(some)
                yield out.filter(pa.array(size > 0))

    kind = docs.schema["doc"].dataType.simpleString()
    return materialize(docs.select("doc", "text").mapInArrow(run, f"doc {kind}, n long, terms array<int>, tfs array<int>"),
                       "search-counts")


class _Best:
    """The ``top`` highest (score, smallest document) of one item."""

    def __init__(self, top: int):
        self.top, self.scores, self.docs = top, np.zeros(0, np.int64), []

    @property
    def worst(self) -> int:
        """A score below this can't enter."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, docs: list) -> None:
        scores, docs = np.concatenate([self.scores, scores]), self.docs + docs
        order = sorted(range(len(docs)), key=lambda k: (-scores[k], docs[k] is not None, docs[k]))[:self.top]
        self.scores, self.docs = scores[order], [docs[k] for k in order]


def _search_block(best: list[_Best], queries: list[np.ndarray], weights: np.ndarray, impact: np.ndarray, docs: list) -> int:
    """Score the block's documents (columns of ``impact``) for every item; the number of
    (item, document) pairs that were evaluated."""
    bitmaps = impact > 0
    limit = impact.max(1).astype(np.int64) * weights  # a term's best contribution in this block
    evaluated = 0
    for b, own in zip(best, queries, strict=True):
        if int(limit[own].sum()) < b.worst:
            continue
        present = bitmaps[own]
        packed = np.ascontiguousarray(np.packbits(present, axis=0).T)
        packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
        if packed.shape[1] == 1:
            _, first, group = np.unique(packed[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, group = np.unique(packed, axis=0, return_index=True, return_inverse=True)
        most = limit[own] @ present[:, first]  # the highest possible score of each distinct mask
        by = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(first)))
        order = np.argsort(-most, kind="stable")
        for k in range(0, len(order), _STEP):
            step = order[k:k + _STEP]
            step = step[most[step] >= b.worst]
            if not len(step):
                break
            some = np.concatenate([by[ends[g - 1] if g else 0:ends[g]] for g in step])
            scores = weights[own] @ impact[np.ix_(own, some)].astype(np.int64)
            evaluated += len(some)
            keep = np.flatnonzero(scores >= b.worst)
            if len(keep) > b.top:  # all that tie with the last one stay
                keep = keep[scores[keep] >= np.partition(scores[keep], -b.top)[-b.top]]
            if len(keep):
                b.add(scores[keep], [docs[j] for j in some[keep].tolist()])
    return evaluated


def _best(counts: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item int, doc, score, salt): the best documents of each task for each item."""
    kind = counts.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, doc_type, width = [_Best(top) for _ in queries], None, max(16, _CELLS // max(1, len(weights)))
        for b in batches:
            doc_type = b.schema.field("doc").type
            n = b.column("n").to_numpy()
            term, tf = (b.column(c).values.to_numpy().astype(np.int64) for c in ("terms", "tfs"))
            first = b.column("terms").offsets.to_numpy()
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            row = np.repeat(np.arange(len(n)), np.diff(first))
            score = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
            by_length, docs = np.argsort(n, kind="stable"), b.column("doc").to_pylist()
            for k in range(0, len(n), width):
                some = by_length[k:k + width]
                at = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
                impact = np.zeros((len(weights), len(some)), np.int32)
                impact[term[at], np.repeat(np.arange(len(some)), np.diff(first)[some])] = score[at]
                _search_block(best, queries, weights, impact, [docs[i] for i in some.tolist()])
        found = [(k, d, int(s)) for k, x in enumerate(best) for d, s in zip(x.docs, x.scores, strict=True)]
        if found:
            items, ids, scores = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(ids, doc_type), pa.array(scores, pa.int64())],
                                             ["item", "doc", "score"])

    return counts.mapInArrow(run, f"item int, doc {kind}, score long").withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


def _ranked(best: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_first("doc")]
    within = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return (best.withColumn("rank", within).where(F.col("rank") <= top).drop("rank")
            .withColumn("rank", last).where(F.col("rank") <= top))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of ``docs`` (doc_id, text) for each of
    ``items`` (item_id, text) by

        w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))
        m = 100 - 90 + 90 * n * N div L
        score = sum of w * (1000000000 * tf div (1000 * tf + 8 * m))

    with N documents that have a term, L terms in all, n terms of the document, df documents
    with the term and tf its occurrences; only scores above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").alias("doc"), "text")
    item_type = items.schema["item_id"].dataType.simpleString()
    doc_type = docs.schema["doc"].dataType.simpleString()
    out = []
    for block in _item_blocks(items.select(F.col("item_id").alias("item"), "text"), block_terms):
        vocabulary = sorted({t for own in block.values() for t in own})
        number = {t: k for k, t in enumerate(vocabulary)}
        counts = _counted(docs, vocabulary)
        n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = np.zeros(len(vocabulary), np.int64)
        for r in held.toLocalIterator():
            df[r["term"]] = r["df"]
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        queries = [np.array([number[t] for t in own], np.int64) for own in block.values()]
        names = spark.createDataFrame([(k, i) for k, i in enumerate(block)], f"item int, item_id {item_type}")
        found = _ranked(_best(counts, queries, weights, n_docs, n_terms, top), top)
        out.append(found.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
    if not out:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score long")
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return whole


def sql(docs: str = "documents", items: str = "benchmark", top: int = TOP) -> str:
    """DuckDB SQL of ``search``."""
    cut = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {cut} AS t FROM {docs} WHERE text IS NOT NULL),
kept AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM kept),
q AS (SELECT DISTINCT item_id, unnest({cut}) AS term FROM {items}),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, total GROUP BY term),
scored AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM tf JOIN w USING (term) JOIN q USING (term) JOIN kept USING (r), total GROUP BY item_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank, doc_id, score
  FROM scored JOIN kept USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {top}"""
