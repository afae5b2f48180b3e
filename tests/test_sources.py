"""Sources, sinks, the versioned state table and the chat and blend rules."""
import json

from pyspark.sql import functions as F

from tessera.operators import chat, ranking, splits
from tessera.plans import hybrid
from tessera.sources import buckets, files


def test_csv_round_trip_and_append(spark, tmp_path):
    rows = [("a,b", 'say "hi"'), ("line\nbreak", None), ("", "x")]
    df = spark.createDataFrame(rows, "text string, label string")
    path = str(tmp_path / "t")
    files.write_csv(df.where("label IS NOT NULL OR text <> ''"), path)
    files.write_csv(spark.createDataFrame([("more", "y")], df.schema), path, append=True)
    got = {tuple(r) for r in files.read_csv(spark, path, "text string, label string").collect()}
    assert ("a,b", 'say "hi"') in got and ("more", "y") in got and len(got) == 4
    files.write_csv(df.limit(0), path)
    assert files.read_csv(spark, path, "text string, label string").count() == 0


def test_intents_metrics_and_texts(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps({"greet": {"examples": ["hi", "hello"], "responses": ["Hey"]},
                                                 "bye": {"examples": ["bye"], "responses": ["See you", "Bye"]}}, indent=1))
    got = {r.intent: (r.examples, r.responses) for r in files.read_intents(spark, str(tmp_path / "i.json")).collect()}
    assert got == {"greet": (["hi", "hello"], ["Hey"]), "bye": (["bye"], ["See you", "Bye"])}
    files.write_metrics(spark, {"accuracy": 0.5, "f1": 0.25}, str(tmp_path / "m"))
    assert {r.metric: r.value for r in files.read_metrics(spark, str(tmp_path / "m")).collect()} == {"accuracy": 0.5, "f1": 0.25}
    (tmp_path / "a.txt").write_text("one\ntwo")
    assert files.read_texts(spark, str(tmp_path / "a.txt")).first().text == "one\ntwo"


def test_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "b")
    for n, batch in ((3, 0), (2, 1), (2, 1)):
        files.put_batch(spark.range(n), path, batch)
    assert spark.read.parquet(path).count() == 5
    assert files.lookup(spark.read.parquet(path), spark.range(1), "id").count() == 2


def test_state_table_keeps_what_a_broken_upsert_left(spark, tmp_path):
    path = str(tmp_path / "s")
    put = lambda rows, v: buckets.upsert(spark.createDataFrame(rows, "u long, i long, x double"), path, ["u", "i"], "u", v, 4)
    state = lambda: {(r.u, r.i): r.x for r in buckets.read(spark, path).collect()}
    assert buckets.read(spark, path) is None
    put([(k, 1, 1.0) for k in range(20)], 0)
    put([(3, 1, 5.0), (3, 2, 6.0)], 1)
    want = {(k, 1): 1.0 for k in range(20)} | {(3, 1): 5.0, (3, 2): 6.0}
    assert state() == want
    before = spark.read.parquet(f"{path}/data").where("version = 1").select("bucket").distinct().count()
    assert before == 1  # one bucket was written anew
    # data of version 2 without its manifest: as if the job broke in between
    spark.createDataFrame([(3, 1, 9.0, 0, 2)], "u long, i long, x double, bucket int, version long").write.mode("append").partitionBy(
        "bucket", "version").parquet(f"{path}/data")
    assert state() == want
    put([(4, 1, 7.0)], 2)
    put([(4, 1, 7.0)], 2)
    assert state() == want | {(4, 1): 7.0}


def test_load_or_train(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Tokenizer
    calls = []

    def train():
        calls.append(1)
        return Pipeline(stages=[Tokenizer(inputCol="t", outputCol="w")]).fit(spark.createDataFrame([("a",)], "t string"))
    for _ in range(2):
        model = files.load_or_train(spark, str(tmp_path / "m"), train)
    assert len(calls) == 1 and model.transform(spark.createDataFrame([("a b",)], "t string")).first().w == ["a", "b"]


def test_entities_and_first_place(spark):
    df = spark.createDataFrame([(1, "A comparison of LONDON and Paris"), (2, None), (3, "")], "k long, text string")
    got = {r.k: r.e for r in df.select("k", chat.first_entity(chat.gazetteer_entities("text")).alias("e")).collect()}
    assert got == {1: "Paris", 2: None, 3: None}  # "comparison" holds it
    places = spark.createDataFrame([("paris",), ("Paris",), ("on",), ("parison of london",), ("",), (None,)], "place string")
    hits = {(r.k, r.entity): r.pos for r in chat.gazetteer_hits(df, "text", ["k"], places).collect()}
    assert hits == {(1, "paris"): 6, (1, "on"): 11, (1, "parison of london"): 6}


def test_each_blend_rule(spark):
    rows = [(False, True, False), (False, False, True), (True, True, True), (True, False, False)]
    df = spark.createDataFrame(rows, "known boolean, profiled boolean, cold boolean")
    score, reason = hybrid.cold_start(F.col("known"), F.col("profiled"), F.col("cold"), F.lit(2.0), F.lit(3.0), F.lit(4.0), 0.5)
    got = [(r.s, r.r) for r in df.select(score.alias("s"), reason.alias("r")).collect()]
    assert got == [(2.0, hybrid.REASONS[0]), (3.0, hybrid.REASONS[1]), (2.0, hybrid.REASONS[2]), (3.0, "hybrid (alpha=0.5)")]


def test_running_sums_and_hits(spark):
    df = spark.createDataFrame([(float(k), k % 3) for k in range(50)], "s double, n long")
    got = {r.s: (r.up, r.all_n) for r in ranking.running_sums(df, "s", {"n": "up"}).collect()}
    assert got == {float(k): (sum(j % 3 for j in range(k, 50)), 49) for k in range(50)}
    rows = spark.createDataFrame([(1, k, k % 2) for k in range(7)] + [(2, 0, 0)], "u long, k long, rel long")
    hit = {r.u: (r.n_rec, r.n_rel, r.n_hit) for r in ranking.hits_at_k(rows, "u", [F.asc("k")], 4, F.col("rel") == 1).collect()}
    assert hit == {1: (4, 3, 2), 2: (1, 0, 0)}


def test_stratified_split_ranks_exactly_and_falls_back(spark):
    df = spark.range(500).selectExpr("id", "CASE WHEN id % 5 = 0 THEN 'a' WHEN id % 7 = 0 THEN NULL ELSE 'b' END AS label")
    out = splits.stratified_split(df, "label", "id").withColumn("h", splits.hash_order("id"))
    for label, rows in out.toPandas().groupby("label", dropna=False):
        rows = rows.sort_values("h")
        n = -(-len(rows) // 4)
        assert rows.is_test.tolist() == [True] * n + [False] * (len(rows) - n), label
    one = spark.range(9).selectExpr("id", "CASE WHEN id = 0 THEN 'a' ELSE 'b' END AS label")
    assert splits.stratified_split(one, "label", "id").where("is_test").count() == 3  # ceil of a quarter of all nine
