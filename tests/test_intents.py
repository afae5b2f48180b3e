"""Intents file, classifier, confidence gate, replies; the stream equals the batch."""
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import word_tokens
from tessera.operators import chat, classify
from tessera.sources import files
from tessera.streaming import jobs

INTENTS = {
    "weather": {"examples": ["weather today", "is it hot outside", "will it rain"], "responses": ["Which city?"]},
    "greeting": {"examples": ["hello there", "good morning", "hey"], "responses": ["Hello!", "Hi!", "Hey!"]},
    "thanks": ["thanks a lot", "thank you", "appreciate it"],
}


GATE = 0.6


def intents_of(spark, tmp_path, content):
    path = str(tmp_path / "intents.json")
    with open(path, "w") as f:
        json.dump(content, f, indent=1)
    return files.read_intents(spark, path)


def test_both_forms_in_one_file(spark, tmp_path):
    got = {r.intent: (r.examples, r.responses) for r in intents_of(spark, tmp_path, INTENTS).collect()}
    assert got == {k: (v, []) if isinstance(v, list) else (v["examples"], v["responses"]) for k, v in INTENTS.items()}


@pytest.mark.parametrize("bad", [{"a": "text"}, {"a": 5}, {"a": {"responses": ["x"]}}, {"a": None}])
def test_other_forms_fail(spark, tmp_path, bad):
    with pytest.raises(Exception):
        intents_of(spark, tmp_path, {**INTENTS, **bad}).collect()


def fitted(spark, tmp_path):
    intents = intents_of(spark, tmp_path, INTENTS)
    rows = chat.intent_rows(intents, word_tokens)
    return intents, classify.text_pipeline("logreg", n_rows=rows.count(), c=100.0).fit(rows)


TURNS = [(1, 7, "2024-01-01 10:00:00", "is it hot"), (2, 7, "2024-01-01 10:01:00", "in Lahore please"),
         (3, 7, "2024-01-01 10:02:00", "thanks"), (4, 8, "2024-01-01 10:00:00", "xyzzy"), (5, 8, "2024-01-01 10:05:00", "good morning"),
         (6, 9, "2024-01-01 10:00:00", "weather"), (7, 9, "2024-01-01 10:01:00", "weather today"), (8, 9, "2024-01-01 10:02:00", None)]


def turns_of(spark):
    return (spark.createDataFrame(TURNS, "event_id long, user_id long, ts string, text string")
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def batch_intents(spark, model, threshold):
    scored = chat.classify_turns(turns_of(spark), model, word_tokens, threshold=threshold)
    return chat.context_intents(scored, "user_id", ["ts", "event_id"], F.col("lab"), F.col("conf"))


def test_gate_automaton_and_replies(spark, tmp_path):
    intents, model = fitted(spark, tmp_path)
    # an unknown word gets little more than 1/3 with three classes: the gate stands higher here
    told = batch_intents(spark, model, GATE)
    place = chat.first_entity(chat.gazetteer_entities("text"))
    rows = chat.replies(told.withColumn("place", place), intents, F.col("event_id")).collect()
    got = {r.event_id: (r.intent, r.reply) for r in rows}
    before, after = chat.FOLLOWUP_REPLY
    assert got[1] == ("weather", "Which city?") and got[2] == ("weather_followup", f"{before}Lahore{after}")
    assert got[3] == ("thanks", chat.DEFAULT_REPLY) and got[4] == ("unknown", chat.UNKNOWN_REPLY)
    assert got[5][0] == "greeting" and got[5][1] in INTENTS["greeting"]["responses"]
    assert got[7] == ("weather_followup", f"{before}weather today{after}") and got[8][0] == "unknown"


def test_stream_equals_batch(spark, tmp_path):
    _, model = fitted(spark, tmp_path)
    src = tempfile.mkdtemp(prefix="tessera-turns-")
    turns_of(spark).orderBy("ts", "event_id").coalesce(1).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(turns_of(spark).schema).parquet(src)
    q = (jobs.intent_stream(stream, model, word_tokens, threshold=GATE).writeStream.outputMode("append").format("memory")
         .queryName("intent_out").option("checkpointLocation", tempfile.mkdtemp(prefix="tessera-ckpt-"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_id: r.intent for r in spark.table("intent_out").collect()}
    assert got == {r.event_id: r.intent for r in batch_intents(spark, model, GATE).collect()} and len(got) == len(TURNS)


def test_confidence_pick_and_json(spark):
    df = spark.createDataFrame([(0.25, ["a", "b", "c"]), (0.2499, []), (None, None)], "c double, r array<string>")
    assert [r[0] for r in df.select(chat.confident(F.col("c"))).collect()] == [True, False, False]
    assert [r[0] is not None for r in df.select(chat.pick(F.col("r"), F.lit("k"))).collect()] == [True, False, False]
    picked = {r[0] for r in spark.range(200).select(chat.pick(F.array(F.lit("x"), F.lit("y"), F.lit("z")), F.col("id"))).collect()}
    assert picked == {"x", "y", "z"}
    found = spark.sql("SELECT array(named_struct('text', 'Ä \"q\"', 'label', 'GPE'), named_struct('text', 'b', 'label', 'GPE')) AS e")
    text = found.select(chat.entities_json(F.col("e"))).first()[0]
    assert text.startswith('[{"text": "') and json.loads(text) == [{"text": 'Ä "q"', "label": "GPE"}, {"text": "b", "label": "GPE"}]
