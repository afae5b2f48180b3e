"""SimHash near-dedup with pivot distance tables.

Fingerprints. A-Z are lower-cased, words are runs without space or \\x09-\\x0D, a shingle is
``size`` words joined by single spaces. Each shingle, repeats included, is hashed
with XXH64 (seed 42); a bit of the fingerprint is 1 if more than half of the hashes
have it set. Two fingerprints link at ``distance`` or fewer differing bits, and a
component is what links reach; its id is the smallest document id in it.

Links. The distinct fingerprints, each with its smallest document id, are joined:

* Partition. With ``blocks`` disjoint bit blocks, at most ``distance`` of them differ in
  a linked pair, so it agrees in ``blocks - distance`` of them: one key for each such
  choice of blocks. ``blocks_for`` tells how many keep groups of unrelated fingerprints
  small; any number gives the same links. (A partition by the pivots alone can't do this:
  one pivot's distance lets 57 % of unrelated pairs pass, whatever the cell.)
* Pivot table. The Hamming distances to ``PIVOTS`` reference fingerprints are computed
  once for each row. By the triangle inequality a linked pair differs by at most
  ``distance`` in every coordinate; pairs whose maximum coordinate difference is larger are
  discarded, and the rest are verified by the bits themselves.
* Large groups are cut into chunks of ``CHUNK`` fingerprints, and each pair of chunks is an
  own group, so a task holds two chunks whatever the group's size. A group returns a
  spanning forest of its links, not its pairs.

Components come from alternating star operations on the edges, each round written to
shared storage; nothing but counts reaches the driver.

Edge cases: a text of fewer than ``size`` words is one shingle, its whole sequence; null,
empty and blank texts have fingerprint zero and link like any other; rows that repeat an id
are each fingerprinted and linked by their own text; rows with a null id are
fingerprinted, have a null component and link nothing; an empty table gives an empty
result; other columns are ignored by ``components`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, fresh, materialize

SIZE = 4
DISTANCE = 4
PIVOTS = 24
BLOCKS = 6  # 15 keys of 21 bits: for some hundred millions of fingerprints
CHUNK = 1024
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PAIRS = 1 << 21  # squares of group sizes that a task compares at once
_STEP = 1 << 16  # hashes whose bits are counted at once, whatever the text's length


def _one_fingerprint(text: str | None, size: int) -> int:
    found = (text or "").encode().translate(_UPPER).split()  # bytes split at the ASCII separators alone
    if not found:
        return 0
    joined, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:max(1, len(found) - size + 1)].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    last = ends[size - 1:].tolist() or [len(joined)]
    for k in range(0, len(starts), _STEP):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[k:k + _STEP], last[k:k + _STEP], strict=True)],
                     ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc, fp long) for each row of ``docs`` (doc, text), and its ``extra`` if there is one."""
    more = [c for c in docs.columns if c == "extra"]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_one_fingerprint(t.as_py(), size) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(fps, pa.int64()), *[b.column(c) for c in more]],
                                             ["doc", "fp", *more])

    return docs.select("doc", "text", *more).mapInArrow(
        run, f"doc {docs.schema['doc'].dataType.simpleString()}, fp long" + ", extra long" * len(more))


def pivots() -> np.ndarray:
    """The reference fingerprints: hashes of their own numbers."""
    return np.array([xxhash.xxh64_intdigest(f"pivot-{k}") for k in range(PIVOTS)], np.uint64)


def blocks_for(n: int, distance: int = DISTANCE, group: int = 512) -> int:
    """The fewest blocks for which ``n`` unrelated fingerprints meet in groups of ``group`` or
    fewer: a parameter to choose, as more blocks mean more keys a fingerprint."""
    blocks = distance + 1
    while n / 2 ** (64 * (blocks - distance) / blocks) > group and blocks < distance + 6:
        blocks += 1
    return blocks


def block_keys(fp: Column, blocks: int, distance: int) -> Column:
    """One key for each choice of ``blocks - distance`` blocks: a number for the choice,
    then the fingerprint with all other bits cleared."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(signed(sum(masks[b] for b in c)))).alias("bits"))
            for k, c in enumerate(combinations(range(blocks), blocks - distance))]
    return F.array(*keys)


def _groups(distinct: DataFrame, blocks: int, distance: int, chunk: int) -> DataFrame:
    """(choice, bits, lo, hi, side, fp): every fingerprint in each group it has to be compared
    in. A group of more than ``chunk`` is cut into chunks; ``lo`` and ``hi`` are the two
    that meet, ``side`` is 1 in the second."""
    key = ["choice", "bits"]
    keyed = distinct.select("fp", F.inline(block_keys(F.col("fp"), blocks, distance)))
    large = materialize(keyed.groupBy(*key).count().where(F.col("count") > chunk)
                        .select(*key, F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "simhash-large")
    cut = (keyed.join(broadcast_if_small(large), key, "left")
           .select(*key, "fp", F.coalesce("chunks", F.lit(1)).alias("chunks"))
           .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")))
    return (cut.select(*key, "fp", "own", F.explode_outer(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
            .select(*key, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "fp"))


def _linked(fp: np.ndarray, run: np.ndarray, side: np.ndarray, cross: np.ndarray, distance: int,
            refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest fingerprint it is linked to, over any path) for those of some
    whole groups that have a link. ``run`` numbers the groups, in ascending order."""
    pivot = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    found, step, left = [], 1, np.arange(len(fp) - 1)
    while len(left := left[left + step < len(fp)]):  # rows whose group reaches ``step`` rows on
        left = left[run[left] == run[left + step]]
        at = left[(cross[left] == 0) | (side[left] != side[left + step])]
        for k in range(pivot.shape[1]):  # discard by the largest coordinate difference
            at = at[np.abs(pivot[at, k] - pivot[at + step, k]) <= distance]
        at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
        found.append(np.stack([at, at + step]))
        step += 1
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    label = np.arange(len(fp))
    while len(a):  # a spanning forest is enough: every linked row with its group's smallest
        low = np.minimum(label[a], label[b])
        if (low == label[a]).all() and (low == label[b]).all():
            break
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
    own = np.nonzero(label != np.arange(len(fp)))[0]
    return fp[own], fp[label[own]]


def links(distinct: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): edges between the fingerprints of ``distinct`` (fp, each once) that connect all
    pairs within ``distance`` bits. Each group gives a forest, not its pairs."""
    key, refs = ["choice", "bits", "lo", "hi"], pivots()
    dealt = _groups(distinct, blocks, distance, chunk).repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
            """``t`` has whole groups, which begin at ``start``."""
            size = np.diff(np.append(start, t.num_rows))
            group = np.repeat(np.arange(len(start)), size)
            many = size[group] > 1
            fp = t.column("fp").to_numpy().view(np.uint64)[many]
            side, cross = t.column("side").to_numpy()[many], (t.column("lo").to_numpy() != t.column("hi").to_numpy())[many]
            # some groups at a time, so that the pairs in memory are bounded
            part = np.cumsum(size.astype(np.int64) ** 2) // _PAIRS
            for p in np.unique(part[group[many]]):
                here = part[group[many]] == p
                a, b = _linked(fp[here], group[many][here], side[here], cross[here], distance, refs)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            t = t.combine_chunks()
            cols = [t.column(k).to_numpy() for k in key]
            new = np.ones(t.num_rows, bool)
            if t.num_rows:
                new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            start = np.nonzero(new)[0]
            if len(start) > 1:  # the last group may go on in the next batch
                yield from solve(t.slice(0, start[-1]), start[:-1])
                t = t.slice(start[-1])
            rest = t
        if rest is not None and rest.num_rows:
            yield from solve(rest, np.zeros(1, np.int64))

    return dealt.mapInArrow(run, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): ``root`` is the smallest node that it
    reaches. Alternating star operations until nothing changes; a round aggregates and
    joins on nodes, so a hub is reduced in parts and its join partition can be split."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                      .where("hi > lo").distinct(), "cc")
    before = None
    while (mark := state(now)) != before:
        before = mark
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                            .distinct(), "cc")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.inline(F.array(
            F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))))
        now = materialize(small.where("hi > lo").distinct(), "cc")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, distance: int = DISTANCE,
               chunk: int = CHUNK, blocks: int = BLOCKS, extra: Column | None = None) -> DataFrame:
    """(id, fingerprint hex, component_id) for every row of ``docs``. With ``extra`` also that and
    ``root``, the component's smallest fingerprint: an id with several texts may be the
    smallest of several components."""
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), *([extra.alias("extra")] if extra is not None else []))
    fps = materialize(fingerprints(docs, size), "simhash")
    distinct = materialize(fps.where("doc IS NOT NULL").groupBy("fp").agg(F.min("doc").alias("rep")), "simhash-distinct")
    roots = connected(links(distinct.select("fp"), distance, chunk, blocks))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    named = rooted.join(least, "root").select("fp", "component", "root")
    return fps.join(named, "fp", "left").select(
        F.col("doc").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc").isNotNull(), F.col("component")).alias("component_id"),
        *(["root", "extra"] if extra is not None else []))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
          distance: int = DISTANCE) -> DataFrame:
    """``docs``, all columns, with one document of each component: that of the smallest id. What goes
    is named by id and XXH64 of the text, so of an id with several texts only the copies go;
    of rows with equal id and text one stays. Rows with a null id stay."""
    key, text_hash = fresh("_copy", docs), fresh("_text", docs)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    found = materialize(components(texts, "doc", "text", size, distance, extra=F.xxhash64("text"))
                        .where("doc IS NOT NULL").select("doc", "component_id", "root", "extra"), "simhash-found")
    each = found.groupBy("doc", "component_id", "root", "extra").agg(F.count("*").alias("n"))
    # the text that stays is the smallest id's; of its texts in one component that of the smallest hash
    first = each.where("doc = component_id").groupBy(F.col("root").alias("of")).agg(F.min("extra").alias("first"))
    gone = each.join(first, F.col("root") == F.col("of")).where("doc <> component_id OR extra <> first")
    named = lambda df, what: broadcast_if_small(materialize(df.select(
        F.col("doc").alias(key), F.col("extra").alias(text_hash)), what))
    same = lambda t: (docs[id_col] == t[key]) & (F.xxhash64(docs[text_col]) == t[text_hash])
    gone, again = named(gone, "simhash-copies"), named(each.where("n > 1"), "simhash-repeats")
    left = docs.join(gone, same(gone), "left_anti")
    if again.limit(1).count() == 0:
        return left
    return left.join(again, same(again), "left_anti").unionByName(
        left.join(again, same(again), "left_semi").dropDuplicates([id_col, text_col]))
