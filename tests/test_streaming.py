"""Streaming jobs equal their batch operators on the same events."""
import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tessera.operators import chat, profile
from tessera.plans.conversation import context_turns
from tessera.sources import buckets
from tessera.sources.tables import interactions
from tessera.streaming import jobs


def _split_events(sf, parts=4):
    """Write the events table as several files ordered by time (a replayable source)."""
    d = tempfile.mkdtemp(prefix="tessera-stream-src-")
    t = pq.read_table(f"{sf}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    step = -(-t.num_rows // parts)
    for k in range(parts):
        pq.write_table(t.slice(k * step, step), os.path.join(d, f"part-{k:03d}.parquet"))
    return d


def test_profile_stream_equals_batch(spark, sf):
    src = _split_events(sf)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (jobs.profile_stream(stream).writeStream.outputMode("complete").format("memory")
         .queryName("st1_state").option("checkpointLocation", tempfile.mkdtemp(prefix="tessera-ckpt-"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    events = spark.read.parquet(f"{sf}/events.parquet")
    ref = events.select(F.max("ts")).scalar()
    got = jobs.profile_at(spark.table("st1_state"), ref)
    want = profile.user_item_scores(interactions(events))
    diff = (got.join(want.withColumnRenamed("score", "want"), ["user_id", "item_id"], "full")
            .where((F.abs(F.col("score") - F.col("want")) > 1e-9 * F.greatest(F.lit(1.0), F.abs("want")))
                   | F.col("score").isNull() | F.col("want").isNull()))
    assert diff.count() == 0


def test_context_stream_equals_batch(spark, sf):
    src = _split_events(sf, parts=3)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (jobs.context_stream(context_turns(stream)).writeStream.outputMode("append").format("memory")
         .queryName("st2_out").option("checkpointLocation", tempfile.mkdtemp(prefix="tessera-ckpt-"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_id: r.intent for r in spark.table("st2_out").collect()}
    turns = context_turns(spark.read.parquet(f"{sf}/events.parquet"))
    want = {r.event_id: r.intent for r in chat.context_intents(
        turns, "user_id", ["ts", "event_id"], F.col("lab"), F.col("conf")).collect()}
    assert got == want


def test_rating_validation(spark):
    cat = spark.createDataFrame([(1,), (2,)], "item_id long")
    r = spark.createDataFrame([(10, 1, 4.0), (10, 3, 5.0), (11, 2, 7.0)], "user_id long, item_id long, rating double")
    valid, rejected = jobs.validate_ratings(r, cat)
    assert [(x.user_id, x.item_id) for x in valid.collect()] == [(10, 1)]
    assert sorted(x.reason for x in rejected.collect()) == ["rating out of range", "unknown item"]


def test_null_rating_is_rejected_and_replays_replace(spark, tmp_path):
    cat = spark.createDataFrame([(1,), (2,)], "item_id long")
    rows = [(10, 1, 4.0), (10, 2, None), (11, 9, None)]
    src = str(tmp_path / "src")
    spark.createDataFrame(rows, "user_id long, item_id long, rating double").write.parquet(src)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for k in range(2):  # two fresh checkpoints: batch 0 is run twice
        stream = spark.readStream.schema("user_id long, item_id long, rating double").parquet(src)
        jobs.start_rating_ingest(stream, cat, out, bad, str(tmp_path / f"ck{k}")).awaitTermination()
    assert [r.item_id for r in spark.read.parquet(out).collect()] == [1]
    assert sorted((r.item_id, r.reason) for r in spark.read.parquet(bad).collect()) == [
        (2, "rating out of range"), (9, "unknown item")]


def test_profile_upserts_and_refits(spark, sf, tmp_path):
    src = _split_events(sf)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    table = str(tmp_path / "state")
    jobs.start_profile_upserts(stream, table, str(tmp_path / "ck")).awaitTermination()
    events = spark.read.parquet(f"{sf}/events.parquet")
    ref = events.select(F.max("ts")).scalar()
    got = {(r.user_id, r.item_id): r.score for r in jobs.profile_at(buckets.read(spark, table), ref).collect()}
    want = {(r.user_id, r.item_id): r.score for r in profile.user_item_scores(interactions(events)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    calls = []
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    jobs.start_refits(stream, 400, lambda _, n: calls.append(n), str(tmp_path / "n"), str(tmp_path / "ck2")).awaitTermination()
    total = events.count()
    assert calls and calls[-1] <= total and len(calls) == len({n // 400 for n in calls})


def test_context_state_expires(spark, tmp_path):
    """A question asked long before the next turn no longer makes it a follow-up."""
    schema = "event_id long, user_id long, ts timestamp_ntz, lab string, conf boolean"
    src = tmp_path / "src"
    for k, (ts, lab, user) in enumerate([("2024-01-01 00:00:00", "weather", 1), ("2024-01-09 00:00:00", "greet", 2),
                                         ("2024-01-17 00:00:00", "greet", 3), ("2024-01-17 01:00:00", "greet", 1)]):
        (spark.createDataFrame([(k, user, ts, lab, True)], "event_id long, user_id long, ts string, lab string, conf boolean")
         .withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(src)))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = (jobs.context_stream(stream, ttl_hours=24).writeStream.outputMode("append").format("memory").queryName("st2_ttl")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert {r.event_id: r.intent for r in spark.table("st2_ttl").collect()}[3] == "greet"
