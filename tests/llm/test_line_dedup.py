import random

from tessera.llm import line_dedup

from .util import ODD_TEXTS, docs, words


def one_edit(a, b, least):
    if max(len(a), len(b)) < least or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, least=line_dedup.MIN_UNITS):
    """The definition, pair by pair."""
    lines = [((i, k), line) for i, t in rows if t is not None and i is not None for k, line in enumerate(t.split("\n"))]
    lines = [(p, x) for p, x in lines if x.strip(" \t\n\x0b\x0c\r")]

    def near(a, b):
        v, w = a.split(" "), b.split(" ")
        return a == b or one_edit(v, w, least) or (max(len(v), len(w)) < least and one_edit(list(a), list(b), least))
    gone = {p for p, x in lines for q, y in lines if q < p and near(x, y)}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
            for i, t in rows}


def corpus(seed, n):
    rng = random.Random(seed)
    base = [words(rng, rng.choice([3, 4, 5, 6, 9])) for _ in range(8)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            line = list(rng.choice(base))
            kind = rng.randrange(5)
            k = rng.randrange(len(line))
            if kind == 1:
                del line[k]
            elif kind == 2:
                line.insert(k, "x")
            elif kind == 3:
                line[k] = f"y{rng.randrange(3)}"
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    return rows


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed, 40)
        for least in (line_dedup.MIN_UNITS, 4, 7):
            got = {r.doc_id: r.text for r in line_dedup.apply(docs(spark, rows), min_units=least).collect()}
            assert got == brute(rows, least)


def test_short_lines_and_scripts_without_spaces(spark):
    lines = ["a b c d e", "a b c d", "a b c", "a b c d f", "a b d e", "one two", "one twos", "one to", "日本語の文章です", "日本語の文です",
             "日本語の文書です", "日本語", "ab", "abcd", "abcde", "abce", "abc", "😀😀😀😀x", "😀😀😀😀", "x 1 2 3 4 5 6 7 8", "x 1 2 3 4 5 6 7 8 9",
             "Anheerat by in ofonthhahe er. Erin.", "Anheerat, by in ofonthhahe er. Erin."]
    rng = random.Random(5)
    for _ in range(3):
        rng.shuffle(lines)
        rows = [(i, "\n".join(lines[i::7])) for i in range(7)]
        got = {r.doc_id: r.text for r in line_dedup.apply(docs(spark, rows)).collect()}
        assert got == brute(rows) and got != dict(rows)


def test_same_by_shuffle_as_by_broadcast(spark):
    rows = corpus(3, 30)
    a = line_dedup.apply(docs(spark, rows), min_units=4, broadcast_rows=0).select("doc_id", "text").collect()
    assert dict(map(tuple, a)) == brute(rows, 4)


def test_large_group_of_near_lines_is_linear_and_whole(spark):
    rows = [(i, f"the same line of more than ten words with number {i} in it at last") for i in range(500)]
    variants = line_dedup._variants(spark.createDataFrame(
        [(i, 0, i, t) for i, t in rows], "doc long, line int, version long, text string"))
    assert line_dedup._links(variants).distinct().count() == 499
    got = line_dedup.apply(docs(spark, rows)).where("text <> ''").collect()
    assert [r.doc_id for r in got] == [0]


def test_long_line(spark):
    line = [f"w{k % 977}" for k in range(30_000)]
    changed = list(line)
    changed[17_000] = "other"
    rows = [(1, " ".join(line)), (2, " ".join(changed)), (3, " ".join(line[1:] + ["end"]))]
    got = {r.doc_id: r.text for r in line_dedup.apply(docs(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[2] == "" and got[3] == rows[2][1]


def test_edge_cases(spark):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "one"), (None, None), (50, "one"), (50, "one")]
    df = docs(spark, rows).selectExpr("*", "1 AS line", "2 AS version", "3 AS dropped", "4 AS _doc", "5 AS key")
    out = line_dedup.apply(df, counts=("n_lines", "n_kept"))
    assert out.columns == df.columns + ["n_lines", "n_kept"]
    got = sorted(((r.doc_id is None, r.doc_id, str(r.text)) for r in out.collect()), key=str)
    want = [(i is None, i, str("" if i == 50 else t)) for i, t in rows]
    assert got == sorted(want, key=str)
    assert line_dedup.apply(docs(spark, [])).count() == 0


def test_empty_and_blank_lines_stay(spark):
    got = line_dedup.apply(docs(spark, [(1, "a\n\n \na\n\n"), (2, "\n")])).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["a\n\n \n\n", "\n"]
