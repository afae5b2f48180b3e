"""Line dedup by a deletion-neighbourhood join.

A line is a sequence of words (split at single spaces, so equal words mean equal lines).
It is dropped if an earlier line, by (document id, line number), is equal to it or within
an edit distance of one unit: one unit deleted, inserted or replaced, where the longer of
both has at least ``min_units``, so four fifths agree. Units are words; between lines of
fewer than ``min_units`` words each, as in scripts without spaces, they are characters.
Earlier lines count whether or not they are dropped themselves, so the result doesn't
depend on any order of work.

Exact copies: one aggregation over 128 hashed bits of the lines finds each distinct line's
earliest place.

Near copies, over the distinct lines:

1. Two lines within one edit share their first half or their last half. Only lines that
   share a half with another distinct line go on; all others have no partner.
2. These lines emit all variants within the bound, the line itself and the line without
   one unit, as hashed keys. A variant's key is the XOR of hashes of (unit, position),
   so running XORs from the left give all keys of a line in one pass, however long
   it is: unit i is left out, the units after it move up by one position. A line of one
   unit less than ``min_units`` emits itself alone, as partner of a longer one.
3. Equal keys join. A line equal to another's variant is a deletion; equal variants
   without the same position are a replacement. All lines of such a group are within
   the bound of each other, or of the one whole line in it, so each is linked only
   with the group's earliest line: no pairs within a group.
4. Each link is verified on the units themselves.

Everything is Spark SQL expressions. Hot lines are reduced by partial aggregation; the joins
back to a line's places are plain equi-joins, whose skewed partitions Spark splits.

Edge cases: blank lines (white space only) are always kept; a null text stays null; a
document whose lines all go keeps its row with an empty text; rows with a null id are
passed through unchanged; rows that repeat an id count as one place, so exact repeats of
a row keep the same lines; an empty table gives an empty result; extra columns are kept by
``apply``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import NOT_SPACE, broadcast_if_small, fresh, materialize, once

MIN_UNITS = 5
BROADCAST_ROWS = 1_000_000
PLACE = ("doc", "line", "version")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, version, line, text): the lines that are not blank; ``version`` tells texts of a
    repeated id apart."""
    lines = F.split("text", "\n", -1)
    return (docs.where("doc IS NOT NULL AND text IS NOT NULL")
            .select("doc", F.xxhash64("text").alias("version"), lines.alias("lines"))
            .select("doc", "version", F.posexplode_outer("lines").alias("line", "text"))
            .where(F.col("text").rlike(NOT_SPACE)))


def _texts_of(docs: DataFrame, places: DataFrame, broadcast_rows: int) -> DataFrame:
    """(place, text) of the given places, each once; other documents are not cut into lines."""
    wanted = materialize(places.groupBy("doc", "version").agg(F.collect_list("line").alias("wanted")), "near-docs")
    some = (docs.where("doc IS NOT NULL AND text IS NOT NULL").withColumn("version", F.xxhash64("text"))
            .join(broadcast_if_small(wanted, broadcast_rows), ["doc", "version"]))
    lines = once(F.split("text", "\n", -1), lambda t: F.transform(
        "wanted", lambda i: F.struct(i.alias("line"), F.get(t, i).alias("text"))))
    return some.select("doc", "version", F.inline_outer(lines)).select(*PLACE, "text").dropDuplicates(list(PLACE))


WORDS, CHARS = 0, 1


def _kinds(line: Column, min_units: int) -> Column:
    """The units in which a line takes part: words, characters, both (a line of one word less than
    ``min_units``) or none."""
    n = _n_words(line)
    return F.filter(F.array(F.when(n >= min_units - 1, F.lit(WORDS)),
                            F.when((n < min_units) & (F.length(line) >= min_units - 1), F.lit(CHARS))),
                    lambda k: k.isNotNull())


def _n_words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _units(line: Column, kind: Column) -> Column:
    return F.when(kind == WORDS, F.split(line, " ", -1)).otherwise(F.regexp_extract_all(line, F.lit("(?s)."), 0))


def _halves(line: Column, n: Column, chars: Column, min_units: int) -> Column:
    """Hashes of the line's first and last h units, for h half its units and half its units without
    one (the half of a partner that is one unit shorter). ``n`` and ``chars`` are its numbers of
    words and characters, as columns: they are read often."""
    def halves(n: Column, cut, tag: int) -> Column:
        def half(h: Column) -> list[Column]:
            h = h.cast("int")
            first, last = cut(h)
            return [F.xxhash64(F.lit(tag), h, first), F.xxhash64(F.lit(tag + 1), h, last)]
        own, less = half(F.floor(n / 2)), half(F.floor(n / 2) - 1)  # a partner one unit shorter has this half
        return F.when((n % 2 == 0) & (n >= min_units), F.array(*own, *less)).otherwise(F.array(*own))

    of_words = halves(n, lambda h: [F.call_function("substring_index", line, F.lit(" "), x) for x in (h, -h)], 1)
    of_chars = halves(chars, lambda h: [F.left(line, h), F.right(line, h)], 3)
    return (F.when(n >= min_units, of_words).when(chars < min_units - 1, F.lit(None))
            .when(n < min_units - 1, of_chars).otherwise(F.concat(of_words, of_chars)))


def _variants(lines: DataFrame, min_units: int = MIN_UNITS) -> DataFrame:
    """(place, kind, variant, at) for lines (place, text), each place once: ``at`` is the position
    left out, 0 for the whole line."""
    line_of = [*PLACE, "kind"]
    units = _units(F.col("text"), F.col("kind"))
    # what stands beside an explode is computed for every row of it, so ``n`` comes before; the two kinds of units
    # count their positions up and down from 0
    place = lambda i: F.when(F.col("kind") == WORDS, i).otherwise(-i)
    each = (lines.repartition(*PLACE).select(*PLACE, "text", F.explode(_kinds(F.col("text"), min_units)).alias("kind"))
            .select(*line_of, units.alias("ws")).select(*line_of, F.size("ws").alias("n"), "ws")
            .select(*line_of, "n", F.posexplode_outer("ws").alias("i", "w"))
            .select(*line_of, "n", (F.col("i") + 1).alias("at"),
                    F.xxhash64("w", place(F.col("i") + 1)).alias("here"), F.xxhash64("w", place(F.col("i"))).alias("moved")))
    line = Window.partitionBy(*line_of).orderBy("at")
    running = lambda c: F.bit_xor(c).over(line.rowsBetween(Window.unboundedPreceding, 0))
    all_moved = F.bit_xor("moved").over(Window.partitionBy(*line_of))
    sums = each.select(*line_of, "n", "at", "here", running("here").alias("upto"),
                       all_moved.bitwiseXOR(running("moved")).alias("after"))
    less = F.when(F.col("n") >= min_units, F.struct(
        "at", F.col("upto").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("after")).alias("variant")))
    full = F.when(F.col("at") == F.col("n"), F.struct(F.lit(0).alias("at"), F.col("upto").alias("variant")))
    return (sums.select(*line_of, F.explode(F.array(less, full)).alias("v")).where("v IS NOT NULL")
            .select(*line_of, "v.variant", "v.at"))


def _links(variants: DataFrame) -> DataFrame:
    """(late, early, kind, at): each line with the earliest of every group it shares a key with."""
    place = F.struct(*PLACE)
    groups = variants.groupBy("kind", "variant", "at").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    every = variants.select("kind", "variant", "at", place.alias("place")).where("at > 0")
    replaced = (every.join(groups.where("at > 0 AND n > 1").drop("n"), ["kind", "variant", "at"])
                .where("place > first").select(F.col("place").alias("late"), F.col("first").alias("early"), "kind", "at"))
    whole = groups.where("at = 0").select("kind", "variant", F.col("first").alias("whole"))
    deleted = every.join(whole, ["kind", "variant"]).select(
        F.greatest("place", "whole").alias("late"), F.least("place", "whole").alias("early"), "kind", "at")
    return replaced.union(deleted)


def _verified(links: DataFrame, texts: DataFrame) -> DataFrame:
    """The links whose lines, without the unit at ``at`` of the longer or of both, are equal."""
    for end in ("late", "early"):
        side = texts.select(F.struct(*PLACE).alias(end), F.col("text").alias(f"{end}_text"))
        links = links.join(side, end).withColumn(f"{end}_units", _units(F.col(f"{end}_text"), F.col("kind"))).drop(f"{end}_text")
    a, b = F.col("late_units"), F.col("early_units")
    less = lambda w: F.filter(w, lambda _, i: i + 1 != F.col("at"))
    rest_a = F.when(F.size(a) >= F.size(b), less(a)).otherwise(a)
    rest_b = F.when(F.size(b) >= F.size(a), less(b)).otherwise(b)
    return links.where((F.abs(F.size(a) - F.size(b)) <= 1) & (rest_a == rest_b)).select("late", "early")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_units: int = MIN_UNITS,
         broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc, version, dropped): the numbers, from 0, of the lines to drop from each text that
    loses any; ``version`` is the text's XXH64."""
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    lines = _lines(docs)
    key = ["key_a", "key_b"]
    lines = lines.select(*PLACE, "text", _n_words(F.col("text")).alias("n"), F.length("text").alias("chars"))
    every = materialize(lines.select(*PLACE, F.xxhash64("text").alias("key_a"), F.xxhash64(F.lit("b"), "text").alias("key_b"),
                                     _halves(F.col("text"), F.col("n"), F.col("chars"), min_units).alias("halves")), "lines")
    distinct = materialize(every.groupBy(*key).agg(
        F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("copies"), F.first("halves").alias("halves")),
        "distinct-lines")

    halves = distinct.select("first", F.explode("halves").alias("half"))
    shared = materialize(halves.groupBy("half").count().where("count > 1").select("half"), "shared-halves")
    near = halves.join(broadcast_if_small(shared, broadcast_rows), "half", "left_semi").select("first.*").distinct()
    texts = materialize(_texts_of(docs, materialize(near, "near-lines"), broadcast_rows), "near-texts")

    links = _verified(_links(materialize(_variants(texts, min_units), "variants")).distinct(), texts)
    early = links.groupBy(F.col("late").alias("first")).agg(F.min("early").alias("early"))
    fate = (distinct.join(early, "first", "left").where("copies > 1 OR early IS NOT NULL")
            .select(*key, F.coalesce("early", "first").alias("kept")))
    dropped = every.select(*PLACE, *key).join(fate, key).where(F.struct(*PLACE) > F.col("kept"))
    return dropped.groupBy("doc", "version").agg(F.collect_set("line").alias("dropped"))


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_units: int = MIN_UNITS,
          broadcast_rows: int = BROADCAST_ROWS, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs``, all rows and columns, with the dropped lines cut from the text; ``counts`` names
    two further columns for the numbers of lines before and after."""
    found = materialize(find(docs, id_col, text_col, min_units, broadcast_rows), "dropped-lines")
    doc, version, dropped = (fresh(c, docs) for c in ("_doc", "_version", "_dropped"))
    found = found.toDF(doc, version, dropped)
    text, gone = docs[text_col], found[dropped]
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    cut = F.when(gone.isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    out = docs.join(found, (docs[id_col] == found[doc]) & (F.xxhash64(text) == found[version]), "left")
    extra = []
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
        extra = [n.alias(counts[0]), (n - F.coalesce(F.size(gone), F.lit(0))).alias(counts[1])]
    return out.select(*[cut.alias(c) if c == text_col else docs[c] for c in docs.columns], *extra)


def sql(min_units: int = MIN_UNITS) -> str:
    """All pairs of equal or near lines as DuckDB SQL over ``documents``."""
    return f"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, t[i] AS s, string_split(t[i], ' ') AS w
  FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents WHERE doc_id IS NOT NULL))
  WHERE regexp_matches(t[i], '[^\x20\x09-\x0D]')),
u AS (SELECT s, any_value(w) AS w, min((doc_id, line)) AS first FROM l GROUP BY s),
k0 AS (
  SELECT first, {WORDS} AS kind, w AS t FROM u WHERE len(w) >= {min_units - 1}
  UNION ALL SELECT first, {CHARS}, list_transform(range(1, length(s) + 1), lambda i: substring(s, i, 1)) FROM u
  WHERE len(w) < {min_units} AND length(s) >= {min_units - 1}),
v AS (
  SELECT first, kind, len(t) AS n, p, t[1:p - 1] || t[p + 1:] AS rest
  FROM (SELECT first, kind, t, unnest(range(1, len(t) + 1)) AS p FROM k0 WHERE len(t) >= {min_units})),
near AS (
  SELECT a.first AS x, b.first AS y FROM v a JOIN v b ON a.kind = b.kind AND a.rest = b.rest AND a.p = b.p AND a.n = b.n
  UNION
  SELECT a.first, k0.first FROM v a JOIN k0 ON a.kind = k0.kind AND a.rest = k0.t),
early AS (SELECT x AS first, min(y) AS early FROM (SELECT x, y FROM near UNION SELECT y, x FROM near) WHERE y < x GROUP BY x),
d AS (
  SELECT doc_id, line FROM l JOIN u USING (s) LEFT JOIN early USING (first)
  WHERE (doc_id, line) > coalesce(early, first)),
k AS (
  SELECT doc_id, count(*) AS n, string_agg(t[i], chr(10) ORDER BY i) AS kept FROM (
    SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents)) x
  WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.doc_id = x.doc_id AND d.line = x.i - 1) GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_kept,
       CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text
FROM documents LEFT JOIN k USING (doc_id)"""
