"""Interaction-log queries: weights, decayed profiles, splits, A/B buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lexicon import AB_GROUPS
from ..functions.scalar import md5_bucket, pick_by_index
from ..operators import profile, ranking, splits
from ..sources.tables import Tables, interactions
from . import _sql as S
from ..functions.scalar import round_half_away as rnd
from . import register


def _inter(spark, sf):
    return interactions(Tables(spark, sf).events)


@register("interaction_weight", f"""
WITH {S.INTER}
SELECT event_id, user_id, item_id, interaction_type, {S.weight_case()} AS weight FROM inter""")
def interaction_weight(spark, sf):
    return _inter(spark, sf).select("event_id", "user_id", "item_id", "interaction_type",
                                    profile.weight_of("interaction_type").alias("weight"))


@register("user_item_decay", f"""
WITH {S.INTER}
SELECT user_id, item_id, round(sum({S.weight_case()} * {S.decay_expr()}), 6) AS score
FROM inter GROUP BY user_id, item_id""")
def user_item_decay(spark, sf):
    return (profile.user_item_scores(_inter(spark, sf))
            .select("user_id", "item_id", rnd("score", 6).alias("score")))


TOP_ITEMS_SQL = f"""
WITH {S.INTER},
s AS (SELECT user_id, item_id, round(sum({S.weight_case()} * {S.decay_expr()}), 6) AS score
      FROM inter GROUP BY user_id, item_id)
SELECT user_id, item_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id DESC) AS rank FROM s)
WHERE rank <= 5"""


def top_items(spark, sf, n: int = 5):
    """Top-n items per user by decayed engagement (ties: higher item id first)."""
    s = (profile.user_item_scores(_inter(spark, sf))
         .select("user_id", "item_id", rnd("score", 6).alias("score")))
    return ranking.top_n(s, "user_id", [F.desc("score"), F.desc("item_id")], n) \
        .select("user_id", "item_id", "score", "rank")


register("top_items_decay", TOP_ITEMS_SQL)(top_items)


@register("event_type_counts", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def event_type_counts(spark, sf):
    return Tables(spark, sf).events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


SPLIT_SQL = f"""
WITH {S.INTER},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_desc,
             count(*) OVER (PARTITION BY user_id) AS n FROM inter)
SELECT event_id, user_id, item_id, interaction_type FROM r
WHERE {{cond}}"""


@register("time_split_train", SPLIT_SQL.format(cond="rn_desc > greatest(1, CAST(floor(n * 0.2) AS BIGINT))"))
def time_split_train(spark, sf):
    train, _ = splits.time_split(_inter(spark, sf), 0.2)
    return train.select("event_id", "user_id", "item_id", "interaction_type")


@register("time_split_test", SPLIT_SQL.format(cond="rn_desc <= greatest(1, CAST(floor(n * 0.2) AS BIGINT))"))
def time_split_test(spark, sf):
    _, test = splits.time_split(_inter(spark, sf), 0.2)
    return test.select("event_id", "user_id", "item_id", "interaction_type")


@register("ab_assignment", f"""
SELECT user_id, {S.group_name(S.md5_bucket('user_id', len(AB_GROUPS)))} AS group_name
FROM (SELECT DISTINCT user_id FROM events)""")
def ab_assignment(spark, sf):
    users = Tables(spark, sf).events.select("user_id").distinct()
    names = [g for g, _, _ in AB_GROUPS]
    return users.select("user_id", pick_by_index(names, md5_bucket("user_id", len(names))).alias("group_name"))


@register("union_interactions", f"""
WITH {S.INTER}
SELECT 'events' AS src, user_id, item_id, interaction_type FROM inter
UNION ALL
SELECT 'orders' AS src, o_custkey AS user_id, l_partkey AS item_id, 'like' AS interaction_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def union_interactions(spark, sf):
    """Union by name of two interaction logs (events and purchases)."""
    t = Tables(spark, sf)
    a = interactions(t.events).select(F.lit("events").alias("src"), "user_id", "item_id", "interaction_type")
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id"))
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item_id"))
    b = li.join(o, "o_orderkey").select(F.lit("orders").alias("src"), "user_id", "item_id",
                                        F.lit("like").alias("interaction_type"))
    return a.unionByName(b)


@register("distinct_users_items", f"""
WITH {S.INTER}
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       count(*) AS n_rows FROM inter""")
def distinct_users_items(spark, sf):
    return _inter(spark, sf).agg(F.count_distinct("user_id").alias("n_users"),
                                 F.count_distinct("item_id").alias("n_items"),
                                 F.count(F.lit(1)).alias("n_rows"))
