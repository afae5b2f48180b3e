import math
import random
import re

from tessera.llm import decontaminate as dc

from .util import ODD_TEXTS, docs, words


def shingles(t, size=5):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}


def brute(rows, items):
    out = {}
    for i, t in rows:
        for j, u in items:
            size = min(5, len(re.findall(r"[^\W_]+", (u or "").lower())))
            s = shingles(u, size) if size else set()
            if i is not None and j is not None and s:
                m = len(s & shingles(t, size))
                if m >= math.ceil(0.8 * len(s) - 1e-9) and m:
                    out[i, j] = max(out.get((i, j), 0), m / len(s))
    return out


def corpus(seed):
    rng = random.Random(seed)
    items = [(j, " ".join(words(rng, n, 500))) for j, n in enumerate([3, 5, 6, 9, 14, 20, 31, 60, 1, 4])]
    rows = []
    for i in range(120):
        w = words(rng, rng.choice([0, 3, 30, 300, 2000]), 500)
        if rng.random() < 0.6:
            own = rng.choice(items)[1].split()
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = "changed"
            k = rng.randrange(len(w) + 1)
            w[k:k] = own
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(w).title()))
    return rows, items


def test_against_all_pairs(spark):
    rows, items = corpus(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for bound in (dc.BROADCAST_ROWS, 0):
        got = dc.find(docs(spark, rows), bench, broadcast_rows=bound).collect()
        assert {(r.doc_id, r.item_id): r.containment for r in got} == brute(rows, items)
        assert len(got) > 20


def test_short_items_inside_long_texts(spark):
    rng = random.Random(9)
    long = lambda n: " ".join(words(rng, n, 5000))
    items = [(0, "the quick brown fox"), (1, "lone"), (2, "two words"), (3, "日本語の文"), (4, "quick brown fox jumps over")]
    rows = [(0, f"{long(10_000)} the quick, brown FOX {long(10_000)}"), (1, "the quick brown fox"), (2, "Lone"), (3, f"x {long(5)} two words"),
            (4, "日本語の文"), (5, "the quick brown"), (6, long(50)), (7, "words two lone two"), (8, "quick brown fox jumps over")]
    for some in (items, items[:1], items[4:]):
        got = dc.find(docs(spark, rows), spark.createDataFrame(some, "item_id long, text string")).collect()
        assert {(r.doc_id, r.item_id): r.containment for r in got} == brute(rows, some)
    assert brute(rows, items).keys() == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (7, 1), (8, 4)}


def test_sketch_is_smaller_than_the_item_but_misses_nothing(spark):
    items = [(j, " ".join(f"i{j}x{k}" for k in range(n))) for j, n in enumerate(range(5, 60))]
    s = dc.item_shingles(spark.createDataFrame(items, "item long, text string"))
    for r in s.groupBy("item").agg({"probe": "count_if", "n": "max", "need": "max"}).collect():
        kept, n, need = r["count_if(probe)"], r["max(n)"], r["max(need)"]
        assert kept > n - need and (n < 16 or kept < n / 2)


def test_remove_and_edge_cases(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, item), (50, item), (50, item), (51, "x " * 40_000 + item)]
    items = [(1, item), (1, "other text of the same item id here"), (None, item), (2, None), (3, ""), (4, item)]
    df = docs(spark, rows).selectExpr("*", "1 AS item_id", "2 AS h", "3 AS _leak", "4 AS doc")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS s")
    got = {(r.doc_id, r.item_id): r.containment for r in dc.find(df, bench).collect()}
    assert got == brute(rows, items) == {(50, 1): 1, (50, 4): 1, (51, 1): 1, (51, 4): 1}
    left = dc.remove(df, bench)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in (50, 51))
    none = bench.where("false")
    assert dc.find(docs(spark, []), bench).count() == 0 and dc.find(df, none).count() == 0
    assert dc.remove(df, none).count() == len(rows)
