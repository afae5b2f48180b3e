import math
import random
import re
from collections import Counter

import numpy as np

from tessera.llm import ranked_search as search

from .util import ODD_TEXTS, docs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, top=10):
    bags = [(d, Counter(terms(t))) for d, t in rows]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    big_n, big_l = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in own.items():
        scored = []
        for d, b, n in bags:
            m = 100 - 90 + 90 * n * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in ts if t in b)
            if s > 0:
                scored.append((-s, d is not None, d))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def run(spark, rows, items, **kw):
    d = docs(spark, rows).repartition(6).selectExpr("*", "1 AS doc", "2 AS n", "3 AS item", "4 AS rank")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 AS doc_id", "6 AS item", "7 AS score")
    got = search.search(d, q, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(n=400, vocabulary=60, seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % vocabulary}"
    return [(i, " ".join(word() for _ in range(rng.choice([3, 10, 60, 300])))) for i in range(n)], rng, word


def test_terms():
    for t in [*ODD_TEXTS, "Ab-c_d`e{f}\x7fÉé A1", "\x80ä b", "日本語、x"]:
        assert [x.decode() for x in search.terms(t or "")] == terms(t)


def test_against_brute_force(spark):
    rows, rng, word = corpus()
    rows += [rows[3]] * 30 + [(None, rows[3][1])] * 2 + [(1000 + k, t) for k, t in enumerate(ODD_TEXTS)]  # ties and repeats
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 30, 100])))) for i in range(25)]
    items += [(3, "w1 W2"), (90, None), (91, "!?"), (92, "nowhere"), (None, "w5 w5 w7"), (93, "Ünïcode ä")]
    want = brute(rows, items)
    assert run(spark, rows, items) == want and len(want) > 200
    assert run(spark, rows, items, block_terms=20) == want  # several blocks of items


def test_masks_of_more_than_64_terms_and_long_texts(spark):
    rows, rng, _ = corpus(vocabulary=150, seed=2)
    rows = [(i, " ".join(f"t{rng.randrange(150)}" for _ in range(len(t)))) for i, t in rows] + [(999, "t1 t2 " * 200_000)]
    items = [(0, " ".join(f"t{k}" for k in range(0, 150, 2))), (1, " ".join(f"t{k}" for k in range(150)))]
    assert run(spark, rows, items, top=7) == brute(rows, items, 7)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == run(spark, [(1, "a")], []) == run(spark, [(1, None)], [(1, "a")]) == []


def test_masks_are_passed_over_only_when_safe():
    rng = np.random.default_rng(0)
    impact = np.where(rng.random((40, 3000)) < 0.2, rng.integers(1, 1000, (40, 3000)), 0).astype(np.int32)
    impact[:, 100:2000] = impact[:, [100]]  # one large group of equal masks and scores
    weights, queries = rng.integers(0, 50, 40), [np.arange(0, 5), np.arange(40), np.array([7])]
    best = [search._Best(10) for _ in queries]
    done = search._search_block(best, queries, weights, impact, list(range(3000, 0, -1)))
    for b, own in zip(best, queries, strict=True):
        scores = weights[own] @ impact[own].astype(np.int64)
        want = sorted((-s, 3000 - k) for k, s in enumerate(scores.tolist()) if s > 0)[:10]
        assert [(-s, d) for s, d in zip(b.scores.tolist(), b.docs, strict=True)] == want
    assert done < 3 * 3000
