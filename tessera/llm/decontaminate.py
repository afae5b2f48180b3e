"""Benchmark decontamination: size-partitioned MinHash containment search.

Items and documents are sets of five-word shingles (lower-cased runs of letters and
digits). An item of one to four words has a single shingle, its whole sequence, and is
looked for among all runs of that many words of the documents. Wanted is every (document,
item) where the document holds at least ``share`` of the item's shingles, however long the
document is.

Search. Items are partitioned by size (powers of two). A partition with at most ``u``
shingles an item keeps as MinHash sketch the ``u - ceil(share * u) + 1`` smallest hashes
of each item: a document that holds ``share`` of an item misses at most ``u - ceil(share
* u)`` of its shingles, so it holds at least one of the sketch. The usual MinHash
banding can only miss pairs when a short item meets a long document (their Jaccard
similarity is near 0); this form has no false negative whatever the document's size. A
document with fewer shingles than the partition's least size needs is passed over.

Verification. The candidates' documents are cut into shingles again, matched with the
items' shingles as strings, and the distinct matches counted: exact containment.

The documents are only scanned; the items' sketches and shingles are broadcast if they
are counted below ``broadcast_rows``, otherwise Spark shuffles by shingle. A passage that
many documents share makes one row for each of them, never pairs of documents.

Edge cases: null and empty texts have no shingle and no pair; rows that repeat an id are
searched alike and give one pair with the best containment; null ids are left out of
pairs (``remove`` keeps such rows); empty tables give no pair; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, fresh, materialize, runs, windows

SIZE = 5
SHARE = 0.8
BROADCAST_ROWS = 1_000_000


def tokens_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")


def strings(tokens: str = "t") -> Column:
    """The shingles of an item's token array: its windows, or the whole shorter sequence."""
    t = F.col(tokens)
    return F.when(F.size(t) >= SIZE, windows(t, SIZE, _joined)).when(
        F.size(t) > 0, F.array(F.array_join(t, " "))).otherwise(F.array().cast("array<string>"))


def _joined(w: list[Column]) -> Column:
    return F.concat_ws(" ", *w)


def _short_lengths(shingles: DataFrame) -> list[int]:
    """The numbers of words, below a full shingle's, that occur among the items' shingles."""
    found = shingles.select(F.size(F.split("s", " ")).alias("words")).where(F.col("words") < SIZE).distinct()
    return sorted(r["words"] for r in found.collect())


def item_shingles(items: DataFrame, share: float = SHARE) -> DataFrame:
    """(item, v, n, need, s, h, probe) for each distinct shingle ``s`` of each item: its hash,
    whether the hash belongs to the item's sketch, the item's number ``n`` of shingles
    and the number a document has to hold. ``v`` tells texts of a repeated id apart."""
    n = F.size("hs")
    top = F.pow(F.lit(2), F.floor(F.log2(n)) + 1).cast("int") - 1  # the partition's largest size
    needs = lambda size: F.ceil(F.lit(share) * size - 1e-9).cast("int")
    return (items.where("item IS NOT NULL").select("item", tokens_of(F.col("text")).alias("t"))
            .select("item", F.xxhash64("t").alias("v"), F.transform(strings(), lambda s: F.struct(
                F.xxhash64(F.split(s, " ")).alias("h"), s.alias("s"))).alias("hs"))
            .dropDuplicates(["item", "v"])
            .select("item", "v", F.array_sort(F.array_distinct("hs")).alias("hs"))
            .select("item", "v", n.alias("n"), needs(n).alias("need"), (top - needs(top) + 1).alias("keep"),
                    F.posexplode_outer("hs").alias("i", "x")).where("x IS NOT NULL")
            .select("item", "v", "n", "need", "x.s", "x.h", (F.col("i") < F.col("keep")).alias("probe")))


def candidates(docs: DataFrame, shingles: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc, item, v): the document has a hash of the item's sketch and shingles enough."""
    probes = broadcast_if_small(shingles.where("probe").select("h", "item", "v", "need"), broadcast_rows)
    t, hashed = F.col("t"), lambda n: F.xxhash64(*[f"w{k}" for k in range(n)])
    each = (docs.select("doc", tokens_of(F.col("text")).alias("t"))
            .select("doc", F.size(t).alias("size"), runs(t, SIZE).alias("runs")).select("doc", "size", F.inline_outer("runs")))
    short = _short_lengths(shingles)
    if not short:
        each = (each.where(F.col(f"w{SIZE - 1}").isNotNull())
                .select("doc", (F.col("size") - SIZE + 1).alias("size"), hashed(SIZE).alias("h")))
    else:  # a run of words starts a full shingle and one of each short length, where words enough follow
        starts = [F.when(F.col(f"w{n - 1}").isNotNull(), hashed(n)) for n in [*short, SIZE]]
        each = (each.where("w0 IS NOT NULL").select("doc", F.greatest(F.col("size") - SIZE + 1, F.lit(1)).alias("size"),
                                                    F.explode(F.array(*starts)).alias("h")).where("h IS NOT NULL"))
    return each.join(probes, "h").where("size >= need").select("doc", "item", "v").distinct()


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
         text_col: str = "text", share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc id, item id, n_shingles, n_shared, containment) for every pair with a containment of
    at least ``share``."""
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(text_col).alias("text")).where("doc IS NOT NULL")
    items = items.select(F.col(item_id).alias("item"), F.col(text_col).alias("text"))
    shingles = materialize(item_shingles(items, share), "bench-shingles")
    pairs = materialize(candidates(docs, shingles, broadcast_rows), "bench-candidates")
    some = docs.join(broadcast_if_small(pairs.select("doc").distinct(), broadcast_rows), "doc", "left_semi")
    sets = F.concat(*[windows(F.col("t"), n, _joined) for n in [*_short_lengths(shingles), SIZE]])
    each = (some.select("doc", tokens_of(F.col("text")).alias("t"))
            .select("doc", F.xxhash64("t").alias("w"), F.array_distinct(sets).alias("ss"))
            .select("doc", "w", F.explode_outer("ss").alias("s")).where("s IS NOT NULL"))
    known = broadcast_if_small(shingles.select("s", "item", "v", "n", "need"), broadcast_rows)
    shared = (each.join(known, "s").groupBy("doc", "w", "item", "v", "n", "need").agg(F.countDistinct("s").alias("m"))
              .where("m >= need").join(pairs, ["doc", "item", "v"], "left_semi"))
    best = F.max(F.struct((F.col("m") / F.col("n")).alias("c"), "n", "m"))
    return shared.groupBy("doc", "item").agg(best.alias("b")).select(
        F.col("doc").alias(doc_id), F.col("item").alias(item_id), F.col("b.n").cast("long").alias("n_shingles"),
        F.col("b.m").alias("n_shared"), F.col("b.c").alias("containment"))


def remove(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
           text_col: str = "text", share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs``, all columns, without the documents that hold an item."""
    key = fresh("_leak", docs)
    leaks = materialize(find(docs, items, doc_id, item_id, text_col, share, broadcast_rows)
                        .select(F.col(doc_id).alias(key)).distinct(), "bench-leaks")
    leaks = broadcast_if_small(leaks, broadcast_rows)
    return docs.join(leaks, docs[doc_id] == leaks[key], "left_anti")


def sql(share: float = SHARE) -> str:
    """Exact containment of every pair as DuckDB SQL over ``documents`` and ``benchmark``."""
    def cut(table: str, key: str) -> str:
        return f"""
  SELECT {key}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t
  FROM {table} WHERE {key} IS NOT NULL AND text IS NOT NULL"""
    return f"""
WITH dt AS ({cut("documents", "doc_id")}), bt AS ({cut("benchmark", "item_id")}),
lengths AS (SELECT DISTINCT least(len(t), {SIZE}) AS k FROM bt WHERE len(t) > 0),
b AS (SELECT DISTINCT item_id, array_to_string(t[i:i + k - 1], ' ') AS s FROM (
        SELECT item_id, t, least(len(t), {SIZE}) AS k, unnest(range(1, len(t) - least(len(t), {SIZE}) + 2)) AS i FROM bt WHERE len(t) > 0)),
d AS (SELECT DISTINCT doc_id, array_to_string(t[i:i + k - 1], ' ') AS s FROM (
        SELECT doc_id, t, k, unnest(range(1, len(t) - k + 2)) AS i FROM dt JOIN lengths ON len(t) >= k)),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, count(*)::BIGINT AS n_shared,
       count(*)::DOUBLE / n_shingles AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= ceil({share} * n_shingles - 1e-9)"""
