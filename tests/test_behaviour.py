"""Feed, split and automaton semantics against brute-force Python."""
import random

from pyspark.sql import functions as F

from tessera.operators import chat, recommend, splits
from tessera.operators.ranking import top_n


def test_time_split_last_fraction(spark):
    rows = [(u, i, i, f"2024-01-01 00:00:{i:02d}") for u, n in ((1, 1), (2, 5), (3, 11)) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, item_id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    train, test = splits.time_split(df, 0.2)
    t = {(r.user_id, r.event_id) for r in test.collect()}
    assert t == {(1, 0), (2, 4), (3, 9), (3, 10)}
    assert train.count() + test.count() == df.count()


def test_top_n_tie_rule(spark):
    df = spark.createDataFrame([(1, 25, 0.5), (1, 37, 0.5), (1, 3, 0.9)], "u long, item long, s double")
    got = [r.item for r in top_n(df, "u", [F.desc("s"), F.desc("item")], 2).orderBy("rank").collect()]
    assert got == [3, 37]


def _feed_brute(scores, catalog, seen, users, n):
    out = {}
    for u in users:
        vec = {i: scores.get((u, i), 0.0) for i in catalog}
        lo, hi = min(vec.values()), max(vec.values())
        norm = {i: 0.0 if hi - lo < 1e-9 else (v - lo) / (hi - lo) for i, v in vec.items()}
        cand = [(round(v, 6), i) for i, v in norm.items() if (u, i) not in seen]
        cand.sort(key=lambda x: (-x[0], -x[1]))
        out[u] = [i for _, i in cand[:n]]
    return out


def test_rank_feed_implicit_zeros_match_dense(spark):
    rnd = random.Random(7)
    catalog = list(range(40))
    users = [1, 2, 3, 4]
    scores = {}
    for i in range(30):   # user 1 dense
        scores[(1, i)] = rnd.random()
    for i in (3, 5, 7):   # user 2 sparse: needs zero-score fill
        scores[(2, i)] = rnd.random()
    for i in catalog:     # user 3 covers the whole catalogue
        scores[(3, i)] = rnd.random() + 0.5
    seen = {(1, 0), (1, 1), (2, 39), (2, 3), (3, 5), (4, 38)}   # user 4: no scores
    sdf = spark.createDataFrame([(u, i, s) for (u, i), s in scores.items()], "user_id long, item_id long, score double")
    cdf = spark.createDataFrame([(i,) for i in catalog], "item_id long")
    seen_df = spark.createDataFrame(list(seen), "user_id long, item_id long")
    udf_ = spark.createDataFrame([(u,) for u in users], "user_id long")
    got = recommend.rank_feed(sdf, cdf, seen_df, udf_, n=5)
    res = {}
    for r in got.orderBy("user_id", "rank").collect():
        res.setdefault(r.user_id, []).append(r.item_id)
    assert res == _feed_brute(scores, catalog, seen, users, 5)


def test_set_feed_equals_item_feed(spark):
    """Feeds by feature sets against the dense ranking: ties in a set, users who saw a whole set, no taste."""
    rnd = random.Random(11)
    feats = {i: {f"cat:{i % 3}"} | {f"tag:{rnd.randrange(4)}" for _ in range(rnd.randrange(3))} for i in range(60)}
    feats[60], feats[61] = set(), set()  # items without features
    scores_of = {u: {i: rnd.random() for i in rnd.sample(range(60), rnd.randrange(1, 25))} for u in range(8)}
    scores_of[8] = {i: 1.0 for i in range(0, 60, 3)}
    scores_of[9] = {}
    fdf = spark.createDataFrame([(i, f) for i, fs in feats.items() for f in fs], "item_id long, feature string")
    prof = spark.createDataFrame([(u, i, s) for u, v in scores_of.items() for i, s in v.items()], "user_id long, item_id long, score double")
    cdf = spark.createDataFrame([(i,) for i in feats], "item_id long")
    users = spark.createDataFrame([(u,) for u in scores_of], "user_id long")
    cos = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5 if a and b else 0.0
    dense = {(u, j): sum(s * cos(feats[i], feats[j]) for i, s in v.items()) for u, v in scores_of.items() for j in feats}
    dense = {k: v for k, v in dense.items() if v > 0}
    items, sets = recommend.feature_sets(fdf)
    got = recommend.rank_sets(recommend.set_scores(prof, fdf, sets), items, cdf, prof, users, n=5)
    res = {}
    for r in got.orderBy("user_id", "rank").collect():
        res.setdefault(r.user_id, []).append(r.item_id)
    assert res == _feed_brute(dense, list(feats), {(u, i) for u, v in scores_of.items() for i in v}, list(scores_of), 5)
    explicit = {(r.user_id, r.item_id): r.score for r in recommend.content_scores(prof, fdf).collect()}
    assert explicit.keys() == dense.keys() and all(abs(explicit[k] - v) < 1e-9 for k, v in dense.items())


def test_context_automaton_matches_loop(spark):
    rnd = random.Random(3)
    rows = []
    eid = 0
    for u in range(6):
        for k in range(60):
            lab = rnd.choice(["weather", "weather", "greet", "book"])
            conf = rnd.random() > 0.2
            rows.append((eid, u, f"2024-01-01 {k // 10:02d}:{k % 60:02d}:00", lab, conf))
            eid += 1
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts string, lab string, conf boolean") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for chunk in (None, F.date_trunc("hour", F.col("ts"))):
        got = {r.event_id: r.intent for r in chat.context_intents(
            df, "user_id", ["ts", "event_id"], F.col("lab"), F.col("conf"), chunk=chunk).collect()}
        for u in range(6):
            seq = sorted([r for r in rows if r[1] == u], key=lambda r: (r[2], r[0]))
            want = context_intents_loop([(r[3], r[4]) for r in seq])
            assert [got[r[0]] for r in seq] == want


def context_intents_loop(rows, trigger="weather"):
    """The automaton turn by turn: rows are (label, confident) in turn order."""
    pending, out = False, []
    for label, sure in rows:
        out.append(f"{trigger}_followup" if pending else label if sure else "unknown")
        pending = (pending, sure, label) == (False, True, trigger)
    return out


def test_seen_items_are_left_out_without_an_anti_join(spark):
    """the rows of users and items are filtered where they arise, not joined with the seen pairs."""
    feats = spark.createDataFrame([(i, f"f{k}") for i in range(40) for k in (i % 4, 4 + i % 3)], "item_id long, feature string")
    prof = spark.createDataFrame([(u, (u * 7 + k) % 45, float(k + 1)) for u in range(9) for k in range(5)] + [(None, 3, 1.0)],
                                 "user_id long, item_id long, score double")
    seen = prof.select("user_id", "item_id")
    got = recommend.content_scores(prof, feats, seen)
    want = recommend.content_scores(prof, feats).join(seen, ["user_id", "item_id"], "left_anti")
    rows = lambda df: sorted((str(r.user_id), r.item_id, round(r.score, 9)) for r in df.collect())
    assert rows(got) == rows(want) and any(r.user_id is None for r in got.collect())
    assert "LeftAnti" not in got._jdf.queryExecution().toString()


def test_set_scores_stay_with_their_users(spark):
    """a set is named by an item, not by 32 characters, and scores of users and sets aren't shuffled."""
    feats = spark.createDataFrame([(i, f"f{k}") for i in range(40) for k in (i % 4, 4 + i % 3)], "item_id long, feature string")
    prof = spark.createDataFrame([(u, (u * 7 + k) % 45, float(k + 1)) for u in range(9) for k in range(5)], "user_id long, item_id long, score double")
    cdf, users = spark.range(45).toDF("item_id"), prof.select("user_id").distinct()
    items, sets = recommend.feature_sets(feats)
    assert dict(items.dtypes)["set_id"] == "bigint" and {r.set_id for r in items.collect()} == {r.item_id for r in items.where("pos = 1").collect()}
    values = recommend.set_values(recommend.set_scores(prof, feats, sets), items, cdf, users)
    assert values.count() > 9
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and not any("Exchange hashpartitioning" in line and "set_id" in line and "user_id" in line for line in plan.split("\n"))


def test_blend_by_sets_equals_blend_by_items(spark):
    """the hybrid feed without content rows of users and items; a user without factors, one without
    taste, one who saw all items with a factor, items without features."""
    rnd = random.Random(5)
    feats = {i: {f"cat:{i % 3}"} | {f"tag:{rnd.randrange(4)}" for _ in range(rnd.randrange(3))} for i in range(50)}
    feats[50], feats[51] = set(), set()
    fdf = spark.createDataFrame([(i, f) for i, fs in feats.items() for f in fs], "item_id long, feature string")
    scores_of = {u: {i: rnd.random() for i in rnd.sample(range(50), rnd.randrange(1, 20))} for u in range(6)}
    scores_of[6] = {i: 1.0 for i in range(0, 24, 2)}
    scores_of[7] = {50: 1.0}
    scores_of[8] = {}
    prof = spark.createDataFrame([(u, i, s) for u, v in scores_of.items() for i, s in v.items()], "user_id long, item_id long, score double")
    cdf = spark.createDataFrame([(i,) for i in feats], "item_id long")
    users = spark.createDataFrame([(u,) for u in scores_of], "user_id long")
    latent = spark.createDataFrame([(u, i, rnd.random()) for u in range(1, 8) for i in [*range(0, 24, 2), 50]], "user_id long, item_id long, score double")
    seen = prof.select("user_id", "item_id")
    items, sets = recommend.feature_sets(fdf)
    rows = lambda df: sorted((r.user_id, r["rank"], r.item_id, round(r.value, 6)) for r in df.collect())
    got = recommend.blend_sets(recommend.set_scores(prof, fdf, sets), items, latent, 0.5, cdf, seen, users, n=5)
    want = recommend.blend_feed([(recommend.content_scores(prof, fdf), 0.5), (latent, 0.5)], cdf, seen, users, 5)
    assert rows(got) == rows(want) and len(rows(got)) == 45


def test_scores_meet_packed_items_where_they_lie(spark):
    """scores of users and sets aren't shuffled to the sets' items, with seen pairs or without."""
    feats = spark.createDataFrame([(i, f"f{k}") for i in range(40) for k in (i % 4, 4 + i % 3)], "item_id long, feature string")
    prof = spark.createDataFrame([(u, (u * 7 + k) % 45, float(k + 1)) for u in range(9) for k in range(5)], "user_id long, item_id long, score double")
    for seen in (None, prof.select("user_id", "item_id")):
        out = recommend.content_scores(prof, feats, seen)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with more items than that
        plan = out._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "hashpartitioning(set_id" not in plan and "hashpartitioning(user_id#" in plan
        assert "set_id#" not in "".join(x for x in plan.split("\n") if "hashpartitioning(user_id" in x and "score" in x)
