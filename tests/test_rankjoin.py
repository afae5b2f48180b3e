"""The rank join against every pair, on catalogues with ties, hot terms, cold items and users."""
import math
import random

import pytest

from tessera.operators import ranking, rankjoin


def tables(spark, rng, n_users, n_items, n_terms, per_item=4):
    items = [(i, None if rng.random() < 0.2 else round(rng.uniform(-1, 1), rng.choice([1, 3]))) for i in range(n_items)]
    vectors = []
    for i in range(n_items):
        if rng.random() < 0.05:
            continue  # an item without terms
        own = {f"t{int(rng.paretovariate(0.8)) % n_terms}": rng.choice([1.0, 2.0]) for _ in range(per_item)}
        norm = math.sqrt(sum(v * v for v in own.values()))
        vectors += [(i, t, v / norm) for t, v in own.items()]
    users = [(u, None if u % 5 == 0 else round(rng.uniform(2, 4), 2)) for u in range(n_users)]
    profile, seen = [], []
    for u, base in users:
        if u % 7 != 3:  # some have no profile
            own = {f"t{rng.randrange(n_terms)}": rng.random() for _ in range(rng.randrange(1, 12))}
            norm = math.sqrt(sum(v * v for v in own.values()))
            profile += [(u, t, v / norm) for t, v in own.items()]
        if base is not None:
            seen += [(u, rng.randrange(n_items)) for _ in range(rng.randrange(n_items // 2))]
    return (spark.createDataFrame(users, "user_id long, base double"), spark.createDataFrame(items, "item_id long, b double"),
            spark.createDataFrame(vectors, "item_id long, term string, x double"),
            spark.createDataFrame(profile, "user_id long, term string, q double"),
            spark.createDataFrame(seen, "user_id long, item_id long")), (users, items, vectors, profile, seen)


def brute(users, items, vectors, profile, seen, n, alpha=0.7):
    rows, q, out = {}, {}, []
    for i, t, x in vectors:
        rows.setdefault(i, {})[t] = x
    for u, t, x in profile:
        q.setdefault(u, {})[t] = x
    for u, base in users:
        scored = []
        for i, b in items:
            if (u, i) in seen:
                continue
            cos = sum(x * q.get(u, {}).get(t, 0.0) for t, x in rows.get(i, {}).items())
            s = 1 + 4 * min(1.0, cos)
            if base is not None and b is not None:
                s = alpha * max(1.0, min(5.0, base + b)) + (1 - alpha) * s
            scored.append((-round(s, 6), i))
        out += [(u, i, -s, k + 1) for k, (s, i) in enumerate(sorted(scored)[:n])]
    return sorted(out)


@pytest.mark.parametrize("shape", [(25, 120, 15), (10, 8, 4)])
def test_equals_every_pair(spark, shape):
    rng = random.Random(shape[1])
    frames, rows = tables(spark, rng, *shape)
    trace: list[int] = []
    got = rankjoin.threshold_topn(*frames, 5, depth=4, growth=3, trace=trace)
    got = sorted((r.user_id, r.item_id, round(r.score, 6), r.rank) for r in got.collect())
    want = brute(*rows[:4], set(rows[4]), 5)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert max(abs(g[2] - w[2]) for g, w in zip(got, want, strict=True)) <= 1.01e-6


def test_clear_tastes_stop_early(spark):
    """Falling biases that outweigh the content part: users stop long before the lists end."""
    n = 3000
    items = spark.range(n).selectExpr("id AS item_id", "1.5 - id / 1000.0 AS b").selectExpr("item_id", "CAST(b AS DOUBLE) AS b")
    vectors = spark.range(n).selectExpr("id AS item_id", "concat('t', id % 10) AS term", "CAST(1 AS DOUBLE) AS x")
    users = spark.range(20).selectExpr("id AS user_id", "CAST(3 AS DOUBLE) AS base")
    profile = spark.range(20).selectExpr("id AS user_id", "concat('t', id % 10) AS term", "CAST(1 AS DOUBLE) AS q")
    seen = spark.createDataFrame([], "user_id long, item_id long")
    trace: list[int] = []
    got = rankjoin.threshold_topn(users, items, vectors, profile, seen, 5, trace=trace).collect()
    assert len(got) == 100 and sum(trace) < 0.1 * 20 * n
    assert {(r.item_id, r.rank) for r in got if r.user_id == 0} == {(10 * k, k + 1) for k in range(5)}


def test_positions_of_a_hot_group_with_ties(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN NULL ELSE 'g' || id % 5 END AS g", "id % 100 AS o", "id")
    got = ranking.positions(df.repartition(7), "g", [df["o"].desc()], "test-positions", total="n").collect()
    groups: dict = {}
    for r in got:
        groups.setdefault(r.g, []).append(r)
    assert len(got) == 3000
    for rows in groups.values():
        rows.sort(key=lambda r: r.pos)
        assert [r.pos for r in rows] == list(range(len(rows))) and {r.n for r in rows} == {len(rows)}
        assert [r.o for r in rows] == sorted((r.o for r in rows), reverse=True)
