from collections import Counter

import pytest

from tessera.llm import sharding

from .util import docs

NAMES = [f"s{k}" for k in range(12)]


def brute(names, slots):
    """Turn by turn, with each shard's permutation written out."""
    import hashlib
    perms = []
    for s in names:
        d = hashlib.md5(s.encode()).digest()
        o, k = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        perm = [(o + j * k) % slots for j in range(slots)]
        assert sorted(perm) == list(range(slots))
        perms.append(iter(perm))
    owner = {}
    while True:
        for i, p in enumerate(perms):
            if len(owner) == slots:
                return [owner[s] for s in range(slots)]
            owner[next(s for s in p if s not in owner)] = i


def test_table_against_brute_force():
    assert sharding.fill_table(NAMES, 251) == brute(NAMES, 251)
    assert sharding.fill_table(["one"], 7) == [0] * 7


def test_even_and_stable():
    a = sharding.fill_table(NAMES)
    sizes = Counter(a)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    b = sharding.fill_table(NAMES[:-1])
    moved = sum(x != y for x, y in zip(a, b) if x != 11)
    assert moved < 0.2 * len(a)  # far fewer than by hash modulo


def test_wrong_parameters():
    for names, slots in ((NAMES, 250), ([], 7), (["a", "a"], 7), (NAMES, 11)):
        with pytest.raises(ValueError):
            sharding.fill_table(names, slots)


def test_place_and_edge_cases(spark, tmp_path):
    df = docs(spark, [(1, "a"), (1, "b"), (None, None), (2, "")]).selectExpr("*", "7 AS slot", "8 AS _at", "9 AS id")
    got = sharding.place(df, "doc_id", NAMES)
    assert set(got.columns) == set(df.columns) | {"shard"} and got.count() == 4
    assert len({r.shard for r in got.where("doc_id = 1").collect()}) == 1
    assert sharding.place(docs(spark, []), "doc_id", NAMES).count() == 0
    big = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    sharding.write_shards(big, "k", NAMES, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 2000
    hot = back.where("k = 0").selectExpr("input_file_name() AS f").distinct().count()
    assert hot > 1  # one key's rows are in several files of one shard
    assert back.where("k = 0").select("shard").distinct().count() == 1
