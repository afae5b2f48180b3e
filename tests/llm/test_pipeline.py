import corpus_pipeline as cp
from tessera.llm import sentencepiece

from .test_decontaminate import brute as leaks
from .test_line_dedup import brute as cut
from .test_simhash import brute as groups
from .util import ODD_TEXTS, docs


def corpus():
    base = "the man of the house and the other one went to see what was there for him in the morning of that day"
    bench = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(k, f"{base} with {k} more lines\nline number {k * 7} of this text", "en") for k in range(20)]
    rows += [(30 + k, f"der Mann und das Haus von nebenan {k * 11} {'sehr ' * k}schön", "de") for k in range(20)]
    rows += [(60, rows[0][1], "en"), (61, f"some words in front {bench} and some behind", "en"), (62, "12 34 !!", "en")]
    rows += [(70 + k, t, None) for k, t in enumerate(ODD_TEXTS)] + [(None, "a row without an id", "en"), (5, rows[5][1], "en")]
    return rows, [(1, bench)]


def test_every_stage_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs(spark, rows).selectExpr("*", "1 AS line", "2 AS fp", "3 AS _lang").cache()
    columns = now.columns
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                         "sentencepiece"]
    for k, (name, stage) in enumerate(cp.STAGES):
        before = [(r.doc_id, r.text) for r in now.collect()]
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        now = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < 4:
            assert now.columns == columns
            after = sorted(map(str, ((r.doc_id, r.text) for r in now.collect())))
        if name == "language_id":
            want = [(i, t) for i, t in before if t and any(map(str.isalpha, t))]
        elif name == "line_dedup":
            named = cut(before)
            want = [(i, t if i is None else named[i]) for i, t in before]
            assert all(r.n_chars == len(r.text) for r in now.collect())
        elif name == "simhash_near_dedup":
            comp = {c[0]: c[2] for c in map(eval, groups(before))}
            want = [(i, t) for i, t in before if i is None] + list({(i, t) for i, t in before if i is not None and comp[i] == i})
        elif name == "benchmark_decontamination":
            bad = {i for i, _ in leaks(before, items)}
            assert bad == {61}
            want = [(i, t) for i, t in before if i not in bad]
        else:
            p = sentencepiece.load()
            assert sorted(map(str, ((r.doc_id, sentencepiece.decode_ids(p, r.ids)) for r in now.collect()))) == sorted(
                map(str, ((i, t.replace("▁", " ")) for i, t in before)))
            continue
        assert after == sorted(map(str, want)), name


def test_run_is_the_stages_in_a_row(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        now = spark.read.parquet(str(tmp_path / f"s{k}"))
    assert sorted(cp.run(spark, str(tmp_path)).collect(), key=str) == sorted(now.collect(), key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
