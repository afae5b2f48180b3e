"""Per-group ranking, top-k and normalisation windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def top_n(df: DataFrame, partition: list[str] | str, order: list[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """``row_number() over (partition order by …) <= n``.

    The order must be total (end it with an id). Spark plans the rank filter as
    a WindowGroupLimit below the shuffle, so each task keeps only its local top
    n rows per key before the exchange.
    """
    parts = [partition] if isinstance(partition, str) else list(partition)
    w = Window.partitionBy(*parts).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return ranked.withColumn(rank_col, F.col("_rn").cast("bigint")).drop("_rn")


def minmax_normalise(df: DataFrame, partition: str, value: str, out: str,
                     eps: float = 1e-9) -> DataFrame:
    """Per-group min-max scaling; all zero when the range is below ``eps``.

    The bounds are one aggregation joined back, so no task holds a whole group.
    """
    bounds = df.groupBy(F.col(partition).alias("_g")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    scaled = F.when(hi - lo < eps, F.lit(0.0)).otherwise((F.col(value) - lo) / (hi - lo))
    return (df.join(bounds, F.col(partition).eqNullSafe(F.col("_g"))).withColumn(out, scaled)
            .drop("_g", "_lo", "_hi"))


def running_sums(df: DataFrame, order: str, sums: dict[str, str]) -> DataFrame:
    """``df`` (``order`` distinct) with the running sum of each column of ``sums``, from the
    largest ``order`` down, under its new name, and its total as ``all_<column>``.

    Rows are dealt out by range and written, so that ranges are the same for both
    readers: sums within each range, and one row a range for the offsets.
    """
    dealt = materialize(df.repartitionByRange(F.desc(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_range").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    ranges = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ranges.select("_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums],
                            *[F.sum(f"_{c}").over(every).alias(f"all_{c}") for c in sums])
    inner = dealt.select("*", *[F.sum(c).over(within).alias(f"_in_{c}") for c in sums])
    out = inner.join(offsets, "_range")
    return out.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_{c}")).alias(name) for c, name in sums.items()],
                      *[f"all_{c}" for c in sums])


def hits_at_k(df: DataFrame, user: str, order: list[Column], k: int, relevant: Column) -> DataFrame:
    """Per user ``n_rec`` (rows shown: at most ``k``), ``n_rel`` (relevant rows) and ``n_hit``
    (relevant among the first ``k``). Only the first ``k`` rows of a user are ranked; the
    counts are plain aggregates."""
    counts = df.groupBy(user).agg(F.least(F.lit(k).cast("bigint"), F.count(F.lit(1))).alias("n_rec"),
                                  F.count_if(relevant).alias("n_rel"))
    hits = top_n(df, user, order, k, "rn").where(relevant).groupBy(user).agg(F.count(F.lit(1)).alias("n_hit"))
    return counts.join(hits, user, "left").fillna(0, ["n_hit"])


def positions(df: DataFrame, group: str, order: list[Column], what: str, pos: str = "pos", total: str | None = None) -> DataFrame:
    """``df`` with the number, from 0, of each row in its ``group`` by ``order`` (made total by the
    order of the scan), and the group's size as ``total`` if named. Null groups are one group.

    Unlike a window over the group, no task sorts a hot group: the rows are dealt by
    ranges of (group, order), each range is sorted and written, and one row a (group,
    range) carries the counts over.
    """
    keys = [F.col(group), *order, F.col("_own")]
    dealt = df.withColumn("_own", F.monotonically_increasing_id()).repartitionByRange(*keys)
    rows = materialize(dealt.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).drop("_own"),
                       what).withColumn("_part", F.shiftright("_at", 33))  # the upper bits number the range
    runs = rows.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    every = Window.partitionBy("_g")
    runs = runs.select("_g", "_p", "_first", F.sum("_size").over(every).alias("_total"),
                       (F.sum("_size").over(every.orderBy("_p")) - F.col("_size")).alias("_start"))
    out = rows.join(runs, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return out.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_start")).alias(pos),
                      *([F.col("_total").alias(total)] if total else []))
