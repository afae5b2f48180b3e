import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tessera.llm import merkle
from tessera.llm.queries import MERKLE_COLUMNS, op13_merkle

from .util import ODD_TEXTS, docs

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """(root, the [left, right] siblings of each node up to the root)."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        at = [i // 3 for i in at]
        nodes = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text) to the query's rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, *climb([leaf(r) for r in own])
    root, tops = climb([trees[s][1] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths, strict=True):
            path = path + top
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            h = leaf((*r[:4], r[4].replace("\n", "")) if cut else r)
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), subroot, root, sha("".join(a + b for a, b in path)), h, h == root))
    return out


def run(spark, tmp_path, rows, name="d"):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.selectExpr("*", "1 AS grp", "2 AS item", "3 AS h").repartition(5).write.parquet(str(tmp_path / name / "documents.parquet"))
    return [tuple(r) for r in op13_merkle(spark, str(tmp_path / name)).collect()]


key = lambda r: tuple(str(x) for x in r)


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "B", "ä", "😀", "", None]), rng.choice(["en", None]), rng.choice([None, i]),
             rng.choice(["x\ny", "", None, f"t{i}\n", "ü"])) for i in range(300)]
    rows += [rows[7]] * 40 + [(None, None, None, None, None)] * 3 + [(7, "hot", "en", 1, "other\ntext"), (-5, "hot", "z", 0, "\n")]
    for n, some in enumerate((rows, rows[:1], rows[:4])):
        assert sorted(run(spark, tmp_path, some, f"d{n}"), key=key) == sorted(brute(some), key=key)


def test_runs_of_every_length(spark):
    sizes = (1, 2, 3, 4, 9, 10, 27, 28, 82)
    df = docs(spark, [(i, "t", None, f"s{n:02d}", 0) for n in sizes for i in range(n)])
    made = merkle.manifest(df, "source", ["doc_id"], MERKLE_COLUMNS, F.struct("source"))
    got = made.proofs.select(merkle.fold(F.col("leaf"), F.col("path")).alias("r"), "root").distinct().collect()
    assert len(got) == 1 and got[0].r == got[0].root  # every leaf folds to the one root
    top = {r.grp: (r.level, r.hi) for r in made.nodes.where("lo = 0 AND hi = n AND grp IS NOT NULL").collect()}
    assert {int(g[2:]): v for g, v in top.items()} == {n: (next(k for k in range(9) if 3 ** k >= n), n) for n in sizes}


def test_written_nodes_and_empty_table(spark, tmp_path):
    made = merkle.manifest(docs(spark, [(1, "a"), (2, "b")]), "source", ["doc_id"], MERKLE_COLUMNS, F.col("doc_id"))
    made.write(str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).where("level = 1 AND lo = 0 AND hi = 2").count() == 1
    assert run(spark, tmp_path, []) == []


def test_odd_and_long_texts(spark, tmp_path):
    rows = [(i, "s", "x", None, t) for i, t in enumerate(ODD_TEXTS + ["w " * 400_000, "a\n" * 300_000])]
    assert sorted(run(spark, tmp_path, rows), key=key) == sorted(brute(rows), key=key)
