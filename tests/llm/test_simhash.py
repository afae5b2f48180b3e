import random
import re

import numpy as np
import xxhash

from tessera.llm import simhash

from .util import ODD_TEXTS, docs, words


def fingerprint(text, size=4):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    s = [" ".join(w[k:k + size]) for k in range(max(1, len(w) - size + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, distance=4):
    fps = [fingerprint(t) for _, t in rows]
    label = {i: i for i, _ in rows if i is not None}
    of = [set() for _ in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and bin(fps[a] ^ fps[b]).count("1") <= distance:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    for k, (i, _) in enumerate(rows):
        if i is not None:
            of[root(k)].add(i)
    return sorted(map(str, ((i, f"{fps[k]:016x}", None if i is None else min(of[root(k)])) for k, (i, _) in enumerate(rows))))


def got(df, **kw):
    return sorted(map(str, ((r.doc_id, r.fingerprint, r.component_id) for r in simhash.components(df, **kw).collect())))


def corpus(seed, n):
    rng = random.Random(seed)
    base = [words(rng, rng.choice([2, 4, 30, 120]), 1000) for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"New{rng.randrange(50)}"
        rows.append((i * 3, " ".join(w)))
    rng.shuffle(rows)
    return rows


def test_against_all_pairs(spark):
    rows = corpus(1, 150)
    assert simhash.blocks_for(10 ** 5) == 5 < simhash.blocks_for(10 ** 9) < simhash.blocks_for(10 ** 11)
    for kw in ({}, {"chunk": 7, "blocks": 5}, {"chunk": 3}):
        assert got(docs(spark, rows), **kw) == brute(rows), kw


def test_links_find_every_pair_of_random_fingerprints(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= 4:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {frozenset(f for f in fps if root(f) == r) for r in {root(f) for f in fps}}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for kw in ({}, {"chunk": 5}, {"blocks": 9}):
        pairs = simhash.connected(simhash.links(df, **kw)).collect()
        group = {f: f % (1 << 64) for f in signed}
        for r in pairs:
            group[r.node] = r.root % (1 << 64)
        mine = {}
        for f, r in group.items():
            mine.setdefault(r, set()).add(f % (1 << 64))
        assert {frozenset(s) for s in mine.values()} == want, kw


def test_pivot_table_discards_most_and_never_a_link():
    rng = np.random.default_rng(0)
    fp = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = fp.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)
    refs = simhash.pivots()
    table = lambda x: np.bitwise_count(x[:, None] ^ refs[None, :]).astype(int)
    assert (np.abs(table(fp) - table(near)).max(1) <= 4).all()
    other = np.abs(table(fp) - table(np.roll(fp, 1))).max(1)
    assert (other > 4).mean() > 0.99


def test_large_group_of_near_copies_gives_a_forest(spark):
    rng = random.Random(9)
    base = rng.getrandbits(63)
    fps = sorted({base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(900)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(df, chunk=100)
    assert edges.count() < 200 * len(fps)  # all pairs would be some hundred thousand
    assert simhash.connected(edges).select("root").distinct().count() == 1


def test_dedup_and_edge_cases(spark):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "one"), (None, "one"), (50, "one"), (50, "One"), (60, "x " * 70_000)]
    df = docs(spark, rows).selectExpr("*", "1 AS fp", "2 AS fingerprint", "3 AS component_id", "4 AS _copy")
    assert got(df) == brute(rows)
    left = simhash.dedup(df)
    assert left.columns == df.columns
    kept = sorted(str(r.doc_id) for r in left.collect())
    assert kept == sorted(["0", "5", "6", "7", "8", "9", "60", "None", "None"])
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(1, long), (2, "alpha beta gamma delta epsilon zeta"), (2, long + " more"), (2, "alpha beta gamma delta epsilon zeta"),
            (3, "theta iota kappa lambda mu nu"), (3, "xi omicron pi rho sigma tau"), (3, "xi omicron pi rho sigma tau")]
    kept = sorted((r.doc_id, r.text) for r in simhash.dedup(docs(spark, rows)).collect())
    assert kept == sorted({rows[0], rows[1], rows[4], rows[5]})  # of an id with several texts only the copies go
    assert got(docs(spark, [])) == [] and simhash.dedup(docs(spark, [])).count() == 0


def test_long_chain(spark):
    fps = [0]
    for k in range(60):
        fps.append(fps[-1] ^ (0b1111 << (k % 15 * 4)) if k < 15 else fps[-1] ^ (0b101 << (k % 20 * 3)))
    df = spark.createDataFrame([(k, k + 1) for k in range(120)], "a long, b long")
    assert {r.root for r in simhash.connected(df).collect()} == {0}
