"""Merkle dataset manifest with nested-interval labels.

Every row is a leaf; the leaves of a group (a source) ascend by an order, and while more
than one node remains each ``FAN`` consecutive ones become the hash of their hashes (a last
run may be shorter, even one node). What remains is the group's subroot; the subroots,
ordered by group, make the root in the same way.

* Labels. A node carries the interval ``[lo, hi)`` of the leaf ranks that it covers. On
  level k intervals start at multiples of ``FAN ** k``, so a node's bucket on the level
  above follows from its own ``lo``.
* Up. One grouping a level by (group, bucket), never more than ``FAN`` rows a group; each
  level is written, so a lost executor costs a reread.
* Down. Each level joins the one above where the interval contains its own, an equi-join on
  (group, bucket) with at most ``FAN`` rows a key. The parent's children whose intervals end
  before the node's or start after it (the interval difference) are its siblings. A node's
  proof is its siblings and then its parent's proof, so long proofs are joined to the few
  nodes of a level, and leaves get theirs from their own parent's row.
* Ranks come from ranges of rows (``ranked``), so a source with a third of all rows is no
  task's own. The driver learns only how many levels there are.

Edge cases: null values hash as ``-``; a null group sorts first; null order values sort first;
rows with equal order values keep the order of their leaf hashes; equal rows are
leaves each; an empty table gives an empty result; columns that aren't named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, key_of, materialize, ranked

FAN = 3
#: Subroots (a hash and a proof of at most some kilobytes each) that are broadcast.
BROADCAST_ROOTS = 100_000


def digest(*values: Column) -> Column:
    """SHA-256 of the values, each written as its UTF-8 byte count, ``:`` and itself; null is ``-``."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


@dataclass
class Tree:
    """``nodes``: (grp, level, lo, hi, n, h) of every level; ``roots``: (grp, h);
    ``proofs``: (grp, item, h, path) of the leaves, ``path`` being the left and right siblings of
    the leaf and its ancestors, from the leaf up."""
    nodes: DataFrame
    roots: DataFrame
    proofs: DataFrame


_PATH = "array<struct<left:string,right:string>>"


def _step(children: Column, lo: Column, hi: Column) -> Column:
    """The siblings of the node [lo, hi) among its parent's children."""
    side = lambda keep: F.array_join(F.transform(F.filter(children, keep), lambda c: c["h"]), "")
    return F.struct(side(lambda c: c["hi"] <= lo).alias("left"), side(lambda c: c["lo"] >= hi).alias("right"))


def build(leaves: DataFrame, order: list, what: str) -> Tree:
    """The trees of ``leaves`` (grp string, h string, item of any type), one a ``grp``."""
    level0 = (ranked(leaves, "grp", [*order, F.col("h")], f"{what}-leaves")
              .select("grp", F.col("before").alias("lo"), (F.col("before") + 1).alias("hi"),
                      F.col("total").alias("n"), "h", "item"))
    level0 = materialize(level0, f"{what}-level0")
    levels, left, width = [level0], level0.agg(F.max("n")).first()[0] or 0, 1
    while left > 1:
        width *= FAN
        below = levels[-1].where("NOT (lo = 0 AND hi = n)")
        child = F.struct(*[c for c in ("lo", "hi", "h", "item") if c in below.columns])
        up = (below.groupBy("grp", "n", (F.col("lo") - F.col("lo") % width).alias("at"))
              .agg(F.array_sort(F.collect_list(child), lambda a, b: (a["lo"] - b["lo"]).cast("int")).alias("children")))
        levels.append(materialize(up.select(
            "grp", F.col("at").alias("lo"), F.least(F.col("at") + width, F.col("n")).alias("hi"), "n",
            F.sha2(F.array_join(F.transform("children", lambda c: c["h"]), ""), 256).alias("h"), "children"),
            f"{what}-level{len(levels)}"))
        left = -(-left // FAN)
    nodes = reduce(DataFrame.unionByName, [t.select("grp", F.lit(k).alias("level"), "lo", "hi", "n", "h")
                                           for k, t in enumerate(levels)])
    is_root = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
    roots = reduce(DataFrame.unionByName, [t.where(is_root).select("grp", "h") for t in levels])
    return Tree(nodes, roots, _descend(levels, is_root))


def _descend(levels: list[DataFrame], is_root: Column) -> DataFrame:
    """The leaves with their paths, from the highest level down."""
    none = F.array().cast(_PATH)
    alone = levels[0].where(is_root).select("grp", "item", "h", none.alias("path"))
    if len(levels) == 1:
        return alone
    above = levels[-1].withColumn("path", none)
    for k in range(len(levels) - 2, 0, -1):
        width = FAN ** (k + 1)
        up = above.select(F.col("grp").alias("p_grp"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                          F.col("children").alias("p_children"), F.col("path").alias("p_path"))
        here = levels[k]
        inside = ((F.col("grp") == F.col("p_grp")) & (F.col("lo") - F.col("lo") % width == F.col("p_lo"))
                  & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")))
        path = F.concat(F.array(_step(F.col("p_children"), F.col("lo"), F.col("hi"))), F.col("p_path"))
        joined = here.where(~is_root).join(up, inside).select(*here.columns, path.alias("path"))
        above = joined.unionByName(here.where(is_root).withColumn("path", none))
    each = above.select("grp", "children", "path", F.explode("children").alias("c"))
    return alone.unionByName(each.select(
        "grp", "c.item", "c.h", F.concat(F.array(_step(F.col("children"), F.col("c.lo"), F.col("c.hi"))),
                                         F.col("path")).alias("path")))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's hash and its proof."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


@dataclass
class Manifest:
    """``nodes``: the nodes of all groups' trees, and of the tree over the groups under level
    numbers from -1 down (``grp`` null); ``proofs``: (item, leaf, subroot, root, path)."""
    nodes: DataFrame
    proofs: DataFrame

    def write(self, path: str) -> None:
        self.nodes.write.partitionBy("level").parquet(path)


def manifest(rows: DataFrame, group: str, order: list[str], columns: list[str], item: Column) -> Manifest:
    """The manifest of ``rows`` with leaves over ``columns``; ``item`` (any expression) comes
    back beside each leaf's proof."""
    leaves = rows.select(key_of(F.col(group)).alias("grp"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)],
                         digest(*[F.col(c) for c in columns]).alias("h"), item.alias("item"))
    trees = build(materialize(leaves, "merkle-hashes"), [F.col(f"o{k}") for k in range(len(order))], "merkle")
    tops = trees.roots.select(F.lit("").alias("grp"), "h", F.struct("grp").alias("item"))
    whole = build(tops, [F.col("item.grp")], "merkle-tops")
    root = whole.roots.first()  # one hash
    over = whole.proofs.select(F.col("item.grp").alias("top_grp"), F.col("h").alias("subroot"),
                               F.lit(root.h if root else None).alias("root"), F.col("path").alias("top_path"))
    over = broadcast_if_small(materialize(over, "merkle-roots"), BROADCAST_ROOTS)
    proofs = (trees.proofs.join(over, F.col("grp") == F.col("top_grp"))
              .select("item", F.col("h").alias("leaf"), "subroot", "root", F.concat("path", "top_path").alias("path")))
    nodes = trees.nodes.unionByName(whole.nodes.withColumn("grp", F.lit(None).cast("string"))
                                    .withColumn("level", -F.col("level") - 1))
    return Manifest(nodes, proofs)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a proof, left to right and from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs ``{name}_up``, ``_fam`` and ``_walk`` over ``leaves`` (grp, idx, cnt, h, changed)."""
    return f"""
{name}_up AS (
  SELECT grp, 0 AS level, idx, cnt, h FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, idx // {FAN}, (cnt + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY idx))
  FROM {name}_up WHERE cnt > 1 GROUP BY grp, level, idx // {FAN}, cnt),
{name}_fam AS (
  SELECT grp, level, idx // {FAN} AS up, list(struct_pack(i := idx, h := h) ORDER BY idx) AS kids
  FROM {name}_up WHERE cnt > 1 GROUP BY ALL),
{name}_walk AS (
  SELECT grp, idx AS leaf_idx, 0 AS level, idx, cnt, '' AS proof, changed AS folded FROM {leaves}
  UNION ALL
  SELECT w.grp, leaf_idx, w.level + 1, w.idx // {FAN}, (cnt + {FAN - 1}) // {FAN},
         proof || list_aggregate(list_transform(list_filter(kids, lambda k: k.i <> w.idx), lambda k: k.h) || [''], 'string_agg', ''),
         sha256(list_aggregate(list_transform(kids, lambda k: CASE WHEN k.i = w.idx THEN folded ELSE k.h END), 'string_agg', ''))
  FROM {name}_walk w JOIN {name}_fam f ON f.grp = w.grp AND f.level = w.level AND f.up = w.idx // {FAN} WHERE cnt > 1)"""


def sql(columns: list[str], table: str = "documents", group: str = "source", order: str = "doc_id") -> str:
    """DuckDB SQL of the manifest of a table whose ``text`` loses its line ends where 2 divides
    the CRC-32 of the order column."""
    h = lambda text: "sha256(" + " || ".join(
        f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in (text if c == "text" else f"{c}::VARCHAR" for c in columns)) + ")"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"
    crc = (f"xor(list_reduce([4294967295] || list_transform(string_split({order}::VARCHAR, ''), lambda d: ascii(d)::BIGINT), "
           f"lambda c, b: {step}), 4294967295)")
    return f"""
WITH RECURSIVE hashed AS (
  SELECT coalesce('=' || {group}::VARCHAR, '') AS grp, {order} AS item, {h("text")} AS h,
         CASE WHEN {crc} % 2 = 0 THEN {h("replace(text, chr(10), '')")} ELSE {h("text")} END AS changed FROM {table}),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY item NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS cnt
  FROM hashed),
{_tree_sql("a", "leaves")},
subroots AS (
  SELECT grp AS sub, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS cnt, '' AS grp, h AS changed
  FROM a_up WHERE cnt = 1),
{_tree_sql("b", "subroots")},
top AS (SELECT h AS root FROM b_up WHERE cnt = 1),
single AS (
  SELECT l.item, l.h AS leaf, s.h AS subroot, s.idx AS pos, w.proof, w.folded
  FROM leaves l JOIN a_walk w ON w.grp = l.grp AND w.leaf_idx = l.idx AND w.cnt = 1 JOIN subroots s ON s.sub = l.grp),
over AS (
  SELECT item, leaf, subroot, pos AS idx0, 0 AS level, pos AS idx, (SELECT count(*) FROM subroots) AS cnt, proof, folded FROM single
  UNION ALL
  SELECT item, leaf, subroot, idx0, w.level + 1, w.idx // {FAN}, (cnt + {FAN - 1}) // {FAN},
         proof || list_aggregate(list_transform(list_filter(kids, lambda k: k.i <> w.idx), lambda k: k.h) || [''], 'string_agg', ''),
         sha256(list_aggregate(list_transform(kids, lambda k: CASE WHEN k.i = w.idx THEN folded ELSE k.h END), 'string_agg', ''))
  FROM over w JOIN b_fam f ON f.level = w.level AND f.up = w.idx // {FAN} WHERE cnt > 1)
SELECT item AS {order}, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM over, top WHERE cnt = 1"""
