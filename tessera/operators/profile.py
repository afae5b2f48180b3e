"""Interaction weighting, time decay and per-(user, item) engagement profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import EVENT_TYPE_ROLES, INTERACTION_WEIGHTS


def weight_of(type_col: Column | str, weights: dict[str, float] | None = None,
              roles: dict[str, str] | None = None, default: float = 1.0) -> Column:
    """Dictionary map of the interaction type with a default (map literal, no join)."""
    weights = INTERACTION_WEIGHTS if weights is None else weights
    roles = EVENT_TYPE_ROLES if roles is None else roles
    table = {src: weights[dst] for src, dst in roles.items() if dst in weights}
    for k, v in weights.items():
        table.setdefault(k, v)
    kv = []
    for k, v in table.items():
        kv += [F.lit(k), F.lit(float(v))]
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.coalesce(F.try_element_at(F.create_map(*kv), c), F.lit(float(default)))


def age_days(ts: Column | str, ref: Column) -> Column:
    """age in fractional days (microsecond precision), clipped at 0."""
    t = F.col(ts) if isinstance(ts, str) else ts
    micros = F.timestamp_diff("MICROSECOND", t, ref)
    return F.greatest(F.lit(0.0), micros / F.lit(86400e6))


def decay(ts: Column | str, ref: Column, half_life_days: float = 14.0) -> Column:
    """half-life decay ``0.5 ** (age / half_life)``."""
    return F.pow(F.lit(0.5), age_days(ts, ref) / F.lit(float(half_life_days)))


def reference_time(interactions: DataFrame, ts: str = "ts") -> Column:
    """Latest timestamp as a scalar subquery (computed once, no join)."""
    return interactions.select(F.max(ts)).scalar()


def weighted_interactions(interactions: DataFrame, ref: Column | None = None,
                          half_life_days: float = 14.0, type_col: str = "interaction_type",
                          ts: str = "ts") -> DataFrame:
    """Adds ``weight``, ``decay`` and ``score = weight * decay`` per event."""
    ref = reference_time(interactions, ts) if ref is None else ref
    w = weight_of(type_col)
    d = decay(ts, ref, half_life_days)
    return interactions.withColumn("weight", w).withColumn("decay", d) \
        .withColumn("score", F.col("weight") * F.col("decay"))


def user_item_scores(interactions: DataFrame, ref: Column | None = None,
                     half_life_days: float = 14.0, catalog: DataFrame | None = None,
                     user: str = "user_id", item: str = "item_id") -> DataFrame:
    """A1: ``sum(weight * decay)`` per (user, item).

    One shuffle on (user, item) with map-side partial sums, so a hot user or
    item is pre-aggregated before it moves. When a catalogue is given, items
    outside it are dropped (semi-join), as the reference ignores them.
    """
    scored = weighted_interactions(interactions, ref, half_life_days)
    agg = scored.groupBy(user, item).agg(F.sum("score").alias("score"))
    if catalog is not None:
        agg = agg.join(catalog.select(F.col("item_id").alias(item)), item, "left_semi")
    return agg
