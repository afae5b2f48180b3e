"""Train/test splits expressed as windows (no sampling, no driver loops)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_split(df: DataFrame, test_fraction: float = 0.2, user: str = "user_id",
               ts: str = "ts", tiebreak: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """Per user, the latest ``max(1, int(n * f))`` rows are the test set.

    One shuffle on the user key; the count and the rank share the window.
    A user with a single row goes wholly to test.
    """
    w = Window.partitionBy(user)
    ranked = (df.withColumn("_rn_desc", F.row_number().over(w.orderBy(F.desc(ts), F.desc(tiebreak))))
                .withColumn("_n", F.count(F.lit(1)).over(w)))
    n_test = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(test_fraction)).cast("bigint"))
    is_test = F.col("_rn_desc") <= n_test
    test = ranked.where(is_test).drop("_rn_desc", "_n")
    train = ranked.where(~is_test).drop("_rn_desc", "_n")
    return train, test


def hash_order(key: Column | str, seed: int = 42) -> Column:
    """Deterministic pseudo-random order: md5 of seed and key (same in DuckDB)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.25,
                     seed: int = 42) -> DataFrame:
    """Per label, the first ``ceil(f * n)`` rows in hash order are test.

    Adds a boolean ``is_test``. Falls back to an unstratified split when some
    class has fewer than two rows (as the reference does).

    No task ranks a whole label: rows are counted by (label, first 16 bits of the
    hash), running sums over these at most 65,536 counts a label give the bucket
    where the test set ends, and ranks are taken within (label, bucket).
    """
    ordered = df.withColumn("_h", hash_order(key, seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    least = df.groupBy(label).count().select(F.min("count")).scalar()
    ordered = ordered.withColumn("_s", F.when(least >= 2, F.col(label)))
    counts = ordered.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_s")
    upto = counts.select("_s", "_b", F.sum("_c").over(w.orderBy("_b")).alias("_upto"), "_c",
                         F.ceil(F.sum("_c").over(w) * F.lit(test_fraction)).alias("_n"))
    edge = (upto.where(F.col("_upto") >= F.col("_n")).groupBy(F.col("_s").alias("_es"))
            .agg(F.min(F.struct("_b", (F.col("_n") - F.col("_upto") + F.col("_c")).alias("left"))).alias("_e")))
    rank = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", key))
    placed = ordered.withColumn("_rn", rank).join(edge, F.col("_s").eqNullSafe(F.col("_es")))
    is_test = (F.col("_b") < F.col("_e._b")) | ((F.col("_b") == F.col("_e._b")) & (F.col("_rn") <= F.col("_e.left")))
    return placed.withColumn("is_test", is_test).drop("_h", "_b", "_s", "_rn", "_es", "_e")
