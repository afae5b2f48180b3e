"""Keyed last-write-wins state (S12) on plain parquet tables.

``MERGE INTO`` needs a table format with row-level writes; on parquet the
upsert is ``union(old, new)`` reduced per key to the latest row with
``max_by(struct, order)``. The reduction is a hash aggregate with map-side
partial maxima, so a hot key is pre-reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{c}") for c in others])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m._v_{c}").alias(c) for c in others])


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write wins per key over the old state and a new batch."""
    return latest_per_key(old.unionByName(new, allowMissingColumns=True), keys, order)
