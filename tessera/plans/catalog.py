"""Catalogue, content-feature and feed queries (part + events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lexicon import AB_GROUPS
from ..functions.scalar import md5_bucket, pick_by_index
from ..functions.text import RE_WS_RUN, remove_stop, stop_list_sql, word_tokens
from ..operators import profile, ranking, recommend, similarity, splits, tfidf
from ..session import materialize
from ..sources.tables import Tables, catalog, interactions
from . import _sql as S
from ..functions.scalar import round_half_away as rnd
from . import register

FEATURES_SQL = f"""
f AS (SELECT DISTINCT item_id, feature FROM (
        SELECT item_id, 'cat:' || category AS feature FROM cat WHERE category IS NOT NULL
        UNION ALL
        SELECT item_id, 'tag:' || t AS feature FROM (
          SELECT item_id, unnest(regexp_split_to_array(coalesce(tags, ''), '{RE_WS_RUN}')) AS t FROM cat)
        WHERE t <> '')),
nf AS (SELECT item_id, count(*) AS nf FROM f GROUP BY item_id)"""

PROFILE_SQL = f"""
prof AS (SELECT user_id, item_id, sum({S.weight_case()} * {S.decay_expr()}) AS score
         FROM inter WHERE item_id IN (SELECT item_id FROM cat) GROUP BY user_id, item_id)"""

SIM_SQL = """
sim AS (SELECT a.item_id AS i, b.item_id AS j, count(*) / sqrt(na.nf * nb.nf) AS sim
        FROM f a JOIN f b ON a.feature = b.feature
        JOIN nf na ON na.item_id = a.item_id JOIN nf nb ON nb.item_id = b.item_id
        GROUP BY a.item_id, b.item_id, na.nf, nb.nf)"""

CS_SQL = """
cs AS (SELECT p.user_id, s.j AS item_id, sum(p.score * s.sim) AS score
       FROM prof p JOIN sim s ON s.i = p.item_id GROUP BY p.user_id, s.j)"""


def _cat(spark, sf):
    return catalog(Tables(spark, sf).part)


@register("content_features", f"""
WITH {S.CATALOG}, {FEATURES_SQL}
SELECT item_id, feature FROM f""")
def content_features_q(spark, sf):
    return recommend.content_features(_cat(spark, sf))


@register("tag_cosine", f"""
WITH {S.CATALOG}, {FEATURES_SQL},
dot AS (SELECT a.item_id AS id_a, b.item_id AS id_b, count(*) AS shared
        FROM f a JOIN f b ON a.feature = b.feature AND a.item_id <> b.item_id GROUP BY 1, 2),
pairs AS (SELECT a.item_id AS id_a, b.item_id AS id_b FROM cat a, cat b WHERE a.item_id <> b.item_id),
s AS (SELECT p.id_a, p.id_b,
             round(CASE WHEN na.nf IS NULL OR nb.nf IS NULL THEN 0.0
                        ELSE coalesce(d.shared, 0) / sqrt(na.nf * nb.nf) END, 6) AS sim
      FROM pairs p LEFT JOIN dot d USING (id_a, id_b)
      LEFT JOIN nf na ON na.item_id = p.id_a LEFT JOIN nf nb ON nb.item_id = p.id_b)
SELECT id_a AS item_id, id_b AS similar_id, sim, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY sim DESC, id_b ASC) AS rank FROM s)
WHERE rank <= 5""")
def tag_cosine(spark, sf):
    """Top-5 most similar items by one-hot category+tag cosine."""
    cat = _cat(spark, sf)
    feats = recommend.content_features(cat).select(F.col("item_id").alias("id"), "feature",
                                                   F.lit(1.0).alias("weight"))
    edges = similarity.cosine_edges(feats, ids=cat.select(F.col("item_id").alias("id")), n=5)
    return edges.select(F.col("id_a").alias("item_id"), F.col("id_b").alias("similar_id"), "sim", "rank")


@register("content_scores", f"""
WITH {S.INTER}, {S.CATALOG}, {FEATURES_SQL}, {PROFILE_SQL}, {SIM_SQL}, {CS_SQL}
SELECT user_id, item_id, round(score, 6) AS score FROM cs""")
def content_scores_q(spark, sf):
    t = Tables(spark, sf)
    cat = catalog(t.part)
    prof = profile.user_item_scores(interactions(t.events), catalog=cat)
    cs = recommend.content_scores(prof, recommend.content_features(cat))
    return cs.select("user_id", "item_id", rnd("score", 6).alias("score"))


@register("minmax_scores", f"""
WITH {S.INTER}, {S.CATALOG}, {PROFILE_SQL}
SELECT user_id, item_id,
       round(CASE WHEN max(score) OVER w - min(score) OVER w < 1e-9 THEN 0.0
                  ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END, 6) AS norm_score
FROM prof WINDOW w AS (PARTITION BY user_id)""")
def minmax_scores(spark, sf):
    """W4 on the explicit profile rows of each user."""
    t = Tables(spark, sf)
    prof = profile.user_item_scores(interactions(t.events), catalog=catalog(t.part))
    out = ranking.minmax_normalise(prof, "user_id", "score", "norm_score")
    return out.select("user_id", "item_id", rnd("norm_score", 6).alias("norm_score"))


def _feed_sql(inter_cte: str, ref: str, users_sql: str) -> str:
    return f"""
{inter_cte}, {S.CATALOG}, {FEATURES_SQL},
prof AS (SELECT user_id, item_id, sum({S.weight_case()} * {S.decay_expr(ref=ref)}) AS score
         FROM inter WHERE item_id IN (SELECT item_id FROM cat) GROUP BY user_id, item_id),
{SIM_SQL}, {CS_SQL},
u AS ({users_sql}),
dense AS (SELECT u.user_id, c.item_id, coalesce(cs.score, 0.0) AS score
          FROM u CROSS JOIN cat c LEFT JOIN cs ON cs.user_id = u.user_id AND cs.item_id = c.item_id),
nrm AS (SELECT user_id, item_id,
               round(CASE WHEN max(score) OVER w - min(score) OVER w < 1e-9 THEN 0.0
                          ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END, 6) AS value
        FROM dense WINDOW w AS (PARTITION BY user_id)),
unseen AS (SELECT * FROM nrm n WHERE NOT EXISTS (
             SELECT 1 FROM prof p WHERE p.user_id = n.user_id AND p.item_id = n.item_id)),
feed AS (SELECT user_id, item_id, value, rank FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, item_id DESC) AS rank
           FROM unseen) WHERE rank <= 5)"""


FEED_SQL = "WITH " + _feed_sql(S.INTER, "(SELECT max(ts) FROM events)",
                               "SELECT DISTINCT user_id FROM inter") + """
SELECT user_id, item_id, round(value, 4) AS score, rank FROM feed"""


def content_feed(inter, cat, n: int = 5, ref=None, users=None):
    """R9 with the content strategy for every known user: (user_id, item_id, value, rank)."""
    prof = profile.user_item_scores(inter, ref=ref, catalog=cat)
    prof = materialize(prof.select("user_id", "item_id", "score"), "feed-profile")
    users = inter.select("user_id").distinct() if users is None else users
    features = materialize(recommend.content_features(cat), "feed-features")
    items, sets = recommend.feature_sets(features)
    scores = recommend.set_scores(prof, features, sets)
    return recommend.rank_sets(scores, items, cat.select("item_id"), prof.select("user_id", "item_id"), users, n=n)


@register("feed_content", FEED_SQL)
def feed_content(spark, sf):
    t = Tables(spark, sf)
    feed = content_feed(interactions(t.events), catalog(t.part))
    return feed.select("user_id", "item_id", rnd("value", 4).alias("score"), "rank")


@register("feed_impressions", "WITH " + _feed_sql(S.INTER, "(SELECT max(ts) FROM events)",
                                                   "SELECT DISTINCT user_id FROM inter") + f""",
grp AS (SELECT user_id, {S.group_name(S.md5_bucket('user_id', len(AB_GROUPS)))} AS group_name FROM u)
SELECT f.user_id, f.item_id, f.rank, round(f.value, 4) AS score, g.group_name, 'content' AS strategy,
       c.name AS title, c.category
FROM feed f JOIN grp g USING (user_id) JOIN cat c USING (item_id)""")
def feed_impressions(spark, sf):
    """Ranked feed rows enriched with item attributes and the A/B group."""
    t = Tables(spark, sf)
    cat = catalog(t.part)
    feed = content_feed(interactions(t.events), cat)
    names = [g for g, _, _ in AB_GROUPS]
    return (feed.join(cat.select("item_id", F.col("name").alias("title"), "category"), "item_id")
            .select("user_id", "item_id", "rank", rnd("value", 4).alias("score"),
                    pick_by_index(names, md5_bucket("user_id", len(names))).alias("group_name"),
                    F.lit("content").alias("strategy"), "title", "category"))


@register("exclude_seen", f"""
WITH {S.INTER}, {S.CATALOG}, {FEATURES_SQL}, {PROFILE_SQL}, {SIM_SQL}, {CS_SQL}
SELECT user_id, item_id, round(score, 6) AS score FROM cs c
WHERE NOT EXISTS (SELECT 1 FROM prof p WHERE p.user_id = c.user_id AND p.item_id = c.item_id)""")
def exclude_seen(spark, sf):
    """Content candidates minus the items each user already interacted with."""
    t = Tables(spark, sf)
    cat = catalog(t.part)
    prof = profile.user_item_scores(interactions(t.events), catalog=cat)
    prof = materialize(prof, "seen-profile")
    cs = recommend.content_scores(prof, recommend.content_features(cat), prof.select("user_id", "item_id"))
    return cs.select("user_id", "item_id", rnd("score", 6).alias("score"))


AB_SQL = f"""
WITH {S.INTER.replace('inter AS', 'allx AS')},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_desc,
             count(*) OVER (PARTITION BY user_id) AS n FROM allx),
inter AS (SELECT event_id, user_id, item_id, interaction_type, ts FROM r
          WHERE rn_desc > greatest(1, CAST(floor(n * 0.2) AS BIGINT))),
test AS (SELECT DISTINCT user_id, item_id FROM r WHERE rn_desc <= greatest(1, CAST(floor(n * 0.2) AS BIGINT))),
""" + _feed_sql("x AS (SELECT 1)", "(SELECT max(ts) FROM inter)",
                "SELECT DISTINCT user_id FROM inter WHERE user_id IN (SELECT user_id FROM test)").lstrip() + f""",
per_user AS (
  SELECT u.user_id, {S.group_name(S.md5_bucket('u.user_id', len(AB_GROUPS)))} AS group_name,
         (SELECT count(*) FROM feed f JOIN test t ON t.user_id = f.user_id AND t.item_id = f.item_id
          WHERE f.user_id = u.user_id) AS hits,
         (SELECT count(*) FROM test t WHERE t.user_id = u.user_id) AS n_relevant
  FROM u)
SELECT group_name, 'content' AS strategy, count(*) AS n_users,
       round(avg(hits / 5.0), 6) AS avg_precision_at_k, round(avg(hits / n_relevant), 6) AS avg_recall_at_k
FROM per_user GROUP BY group_name"""


def ab_evaluation(inter, cat, n: int = 5, test_fraction: float = 0.2, half_life: float = 14.0):
    """R18 on the content strategy: per-user hits against held-out distinct items."""
    train, test = splits.time_split(inter, test_fraction)
    ref = profile.reference_time(train)
    relevant = test.select("user_id", "item_id").distinct()
    users = train.select("user_id").distinct().join(relevant.select("user_id").distinct(), "user_id")
    feed = content_feed(train, cat, n=n, ref=ref, users=users)
    hits = feed.join(relevant, ["user_id", "item_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))
    n_rel = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    names = [g for g, _, _ in AB_GROUPS]
    per_user = (users.join(n_rel, "user_id").join(hits, "user_id", "left").fillna(0, ["hits"])
                .withColumn("group_name", pick_by_index(names, md5_bucket("user_id", len(names))))
                .withColumn("precision_at_k", F.col("hits") / F.lit(float(n)))
                .withColumn("recall_at_k", F.col("hits") / F.col("n_relevant")))
    return per_user


@register("ab_eval_content", AB_SQL)
def ab_eval_content(spark, sf):
    t = Tables(spark, sf)
    per_user = ab_evaluation(interactions(t.events), catalog(t.part))
    return (per_user.groupBy("group_name")
            .agg(F.count(F.lit(1)).alias("n_users"),
                 rnd(F.avg("precision_at_k"), 6).alias("avg_precision_at_k"),
                 rnd(F.avg("recall_at_k"), 6).alias("avg_recall_at_k"))
            .select("group_name", F.lit("content").alias("strategy"), "n_users",
                    "avg_precision_at_k", "avg_recall_at_k"))


@register("catalog_filter", """
SELECT p_partkey AS item_id, p_name AS name, p_type AS category, p_retailprice AS price
FROM part WHERE lower(p_type) = lower('Economy') AND p_retailprice >= 920.0 AND p_retailprice <= 960.0""")
def catalog_filter(spark, sf, category: str | None = "Economy", min_price: float | None = 920.0,
                   max_price: float | None = 960.0):
    """Conjunction of the predicates that are present; price bounds reach the scan."""
    cat = _cat(spark, sf)
    cond = F.lit(True)
    if category is not None:
        cond = cond & (F.lower(F.col("category")) == F.lower(F.lit(category)))
    if min_price is not None:
        cond = cond & (F.col("price") >= min_price)
    if max_price is not None:
        cond = cond & (F.col("price") <= max_price)
    return cat.where(cond).select("item_id", "name", "category", "price")


def _tfidf_item_sql(table_cte: str = "cat") -> str:
    stop = stop_list_sql()
    return f"""
tok AS (SELECT item_id, unnest(regexp_extract_all(lower(features), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {table_cte}),
tf AS (SELECT item_id, term, count(*) AS tf FROM tok WHERE NOT list_contains({stop}, term) GROUP BY 1, 2),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w0 AS (SELECT tf.item_id, tf.term, tf.tf * (ln((1.0 + (SELECT count(*) FROM {table_cte})) / (1.0 + df)) + 1.0) AS w
       FROM tf JOIN dfs USING (term)),
w AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM w0)"""


def _item_tfidf(cat):
    toks = remove_stop(word_tokens("features"))
    tf = tfidf.term_counts(cat, "item_id", toks)
    n = cat.select(F.count(F.lit(1))).scalar()
    return tfidf.tfidf(tf, n_docs=n)


SIMILAR_SQL = """
dot AS (SELECT a.item_id AS id_a, b.item_id AS id_b, sum(a.w * b.w) AS d
        FROM w a JOIN w b ON a.term = b.term AND a.item_id <> b.item_id GROUP BY 1, 2),
pairs AS (SELECT a.item_id AS id_a, b.item_id AS id_b FROM cat a, cand b WHERE a.item_id <> b.item_id),
s AS (SELECT p.id_a, p.id_b, round(coalesce(d.d, 0.0), 6) AS sim FROM pairs p LEFT JOIN dot d USING (id_a, id_b))
SELECT id_a AS item_id, id_b AS similar_id, sim, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY sim DESC, id_b ASC) AS rank FROM s)
WHERE rank <= 5"""


@register("similar_parts", f"""
WITH {S.CATALOG}, {_tfidf_item_sql()}, cand AS (SELECT * FROM cat), {SIMILAR_SQL}""")
def similar_parts(spark, sf):
    """Top-5 items by TF-IDF cosine of name+brand+type, zeros included."""
    cat = _cat(spark, sf)
    w = _item_tfidf(cat).select(F.col("doc").alias("id"), F.col("term").alias("feature"), "weight")
    edges = similarity.cosine_edges(w, ids=cat.select(F.col("item_id").alias("id")), n=5, normalised=True)
    return edges.select(F.col("id_a").alias("item_id"), F.col("id_b").alias("similar_id"), "sim", "rank")


@register("similar_items_filtered", f"""
WITH {S.CATALOG}, {_tfidf_item_sql()},
cand AS (SELECT * FROM cat WHERE lower(category) = lower('small') AND price >= 950.0 AND price <= 990.0),
{SIMILAR_SQL}""")
def similar_items_filtered(spark, sf):
    """P10: category/price filter on the candidates, applied before the top-5."""
    cat = _cat(spark, sf)
    w = _item_tfidf(cat).select(F.col("doc").alias("id"), F.col("term").alias("feature"), "weight")
    cand = cat.where((F.lower("category") == F.lower(F.lit("small"))) & (F.col("price") >= 950.0)
                     & (F.col("price") <= 990.0)).select(F.col("item_id").alias("id"))
    edges = similarity.cosine_edges(w, ids=cat.select(F.col("item_id").alias("id")), n=5, normalised=True,
                                    right_ids=cand)
    return edges.select(F.col("id_a").alias("item_id"), F.col("id_b").alias("similar_id"), "sim", "rank")


@register("events_by_category", f"""
WITH {S.INTER}, {S.CATALOG}
SELECT c.category, i.interaction_type, count(*) AS n FROM inter i JOIN cat c USING (item_id)
GROUP BY c.category, i.interaction_type""")
def events_by_category(spark, sf):
    """Facts ⋈ dimension, then counts (AQE broadcasts the dimension when small)."""
    t = Tables(spark, sf)
    return (interactions(t.events).join(catalog(t.part).select("item_id", "category"), "item_id")
            .groupBy("category", "interaction_type").agg(F.count(F.lit(1)).alias("n")))


@register("avg_by_tag", f"""
WITH {S.RATINGS}, {S.CATALOG},
tags AS (SELECT DISTINCT item_id, t AS tag FROM (
           SELECT item_id, unnest(regexp_split_to_array(tags, '{RE_WS_RUN}')) AS t FROM cat) WHERE t <> '')
SELECT tag, round(avg(rating), 6) AS avg_rating, count(*) AS n_ratings
FROM ratings JOIN tags USING (item_id) GROUP BY tag""")
def avg_by_tag(spark, sf):
    """Mean rating over an exploded multi-value column."""
    from ..sources.tables import ratings
    t = Tables(spark, sf)
    tags = (catalog(t.part).select("item_id", F.explode(F.split("tags", RE_WS_RUN)).alias("tag"))
            .where(F.col("tag") != "").distinct())
    r = ratings(t.orders, t.lineitem)
    return (r.join(tags, "item_id").groupBy("tag")
            .agg(rnd(F.avg("rating"), 6).alias("avg_rating"), F.count(F.lit(1)).alias("n_ratings")))


@register("distinct_tags", f"""
WITH {S.CATALOG}
SELECT DISTINCT t AS tag FROM (SELECT unnest(regexp_split_to_array(tags, '{RE_WS_RUN}')) AS t FROM cat) WHERE t <> ''""")
def distinct_tags(spark, sf):
    """Union of the distinct values of a delimited column."""
    return (_cat(spark, sf).select(F.explode(F.split("tags", RE_WS_RUN)).alias("tag"))
            .where(F.col("tag") != "").distinct())
