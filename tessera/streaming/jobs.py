"""Structured Streaming jobs: running decayed profiles, the chat context state
machine, validated rating ingest and append-only logs.

Every job takes a streaming DataFrame and a checkpoint location (shared
storage on a cluster), so a lost executor or a restarted driver resumes from
the last committed offsets. Repeated events are dropped with a watermark plus
``dropDuplicatesWithinWatermark`` on the event id; sinks are keyed by the batch number, so
a batch that is run again replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import chat
from ..operators.profile import weight_of
from ..sources import buckets
from ..sources.files import path_exists, put_batch
from ..sources.tables import interactions

EPOCH = "2024-01-01 00:00:00"


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need a zoned TIMESTAMP; the zone-less ``ts`` is read as UTC."""
    return df.withColumn("event_time", F.to_utc_timestamp(F.col(ts).cast("timestamp"), "UTC"))


def scaled_score(ts: str, epoch: str = EPOCH, half_life_days: float = 14.0):
    """``weight * 2^((ts - epoch)/hl)``: an event's weight on a fixed-epoch scale.

    ``Σ w·0.5^((ref - ts)/hl) = 0.5^((ref - epoch)/hl) · Σ w·2^((ts - epoch)/hl)``,
    so the running sum never needs re-ageing and is order independent; readers
    multiply by the decay of ``ref`` (see ``profile_at``). Move the epoch forward
    (rescaling the state once) before ``(ts - epoch)/hl`` nears 1000.
    """
    days = F.timestamp_diff("MICROSECOND", F.lit(epoch).cast("timestamp_ntz"), F.col(ts)) / F.lit(86400e6)
    return weight_of("interaction_type") * F.pow(F.lit(2.0), days / F.lit(half_life_days))


def profile_stream(events: DataFrame, watermark: str = "1 day", half_life_days: float = 14.0) -> DataFrame:
    """ST1: running ``(user, item) → Σ scaled weight`` over an event stream (update mode)."""
    inter = (with_event_time(interactions(events)).withWatermark("event_time", watermark)
             .dropDuplicatesWithinWatermark(["event_id"]))
    return (inter.withColumn("s", scaled_score("ts", half_life_days=half_life_days))
            .groupBy("user_id", "item_id").agg(F.sum("s").alias("scaled")))


def profile_at(state: DataFrame, ref, epoch: str = EPOCH, half_life_days: float = 14.0) -> DataFrame:
    """Read side of ST1: decayed scores at reference time ``ref`` (a Column)."""
    days = F.timestamp_diff("MICROSECOND", F.lit(epoch).cast("timestamp_ntz"), ref) / F.lit(86400e6)
    return state.select("user_id", "item_id",
                        (F.col("scaled") * F.pow(F.lit(0.5), days / F.lit(half_life_days))).alias("score"))


def start_profile_upserts(events: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None):
    """ST1 sink: each micro-batch's changed keys go into a versioned bucket table
    (``sources.buckets``): only the buckets that the batch touches are written anew, and
    readers see a batch when its manifest is there, so a crash loses nothing."""
    w = (profile_stream(events).writeStream.outputMode("update")
         .foreachBatch(lambda batch, epoch: buckets.upsert(batch, table_path, ["user_id", "item_id"], "user_id", epoch))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_refits(events: DataFrame, every: int, refit: Callable[[SparkSession, int], None], count_path: str,
                 checkpoint: str, trigger: dict | None = None):
    """ST1/R19: call ``refit(spark, n_events)`` whenever ``every`` further events have arrived.

    Each batch's count is a row of its own under the batch's number, so a replayed batch
    counts once. ``refit`` may be called again after a crash and has to be repeatable.
    """
    def count(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        before = (spark.read.parquet(count_path).where(F.col("batch_id") < epoch).agg(F.sum("n")).first()[0] or 0
                  if path_exists(spark, count_path) else 0)
        n = batch.count()
        if (before + n) // every > before // every:
            refit(spark, before + n)
        put_batch(spark.createDataFrame([(n,)], "n long"), count_path, epoch)

    w = events.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


CONTEXT_OUT = "event_id long, user_id long, intent string"
CONTEXT_STATE = "pending boolean, last_ts timestamp_ntz, last_event_id long"


def _context_step(key, pdfs: Iterator[pd.DataFrame], state: GroupState, trigger: str = "weather",
                  ttl_ms: int = 86_400_000):
    if state.hasTimedOut:
        state.remove()
        return
    pending = bool(state.get[0]) if state.exists else False
    frames = list(pdfs)  # one user's turns of one micro-batch
    if not frames:
        return
    pdf = pd.concat(frames).sort_values(["ts", "event_id"], kind="mergesort")
    out = []
    for eid, lab, conf in zip(pdf["event_id"], pdf["lab"], pdf["conf"]):
        if pending:
            out.append(f"{trigger}_followup")
            pending = False
        elif not conf:
            out.append("unknown")
        else:
            out.append(lab)
            pending = lab == trigger
    last = pdf.iloc[-1]
    state.update((pending, last["ts"], int(last["event_id"])))
    seen = int(pd.Timestamp(last["event_time"]).timestamp() * 1000)
    state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), seen) + ttl_ms)
    yield pd.DataFrame({"event_id": pdf["event_id"].astype("int64").to_numpy(),
                        "user_id": [key[0]] * len(pdf), "intent": out})


def context_stream(turns: DataFrame, watermark: str = "1 day", ttl_hours: float = 24.0) -> DataFrame:
    """ST2: the context automaton as keyed state (one bit per user).

    ``turns``: streaming ``(event_id, user_id, ts, lab, conf)``. Within a
    micro-batch each user's turns are ordered by (ts, event_id); across batches
    the state carries whether the last answer asked for a follow-up.
    Duplicate deliveries are dropped by event id inside the watermark. A user's
    state is removed ``ttl_hours`` of event time after the last turn.
    """
    dedup = with_event_time(turns).withWatermark("event_time", watermark) \
        .dropDuplicatesWithinWatermark(["event_id"])
    return dedup.groupBy("user_id").applyInPandasWithState(
        partial(_context_step, ttl_ms=int(ttl_hours * 3_600_000)), outputStructType=CONTEXT_OUT,
        stateStructType=CONTEXT_STATE, outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


def intent_stream(turns: DataFrame, model, tokens, threshold: float = chat.MIN_CONFIDENCE, **kw) -> DataFrame:
    """ST2 fed by predictions (C7, P14): ``turns`` (event_id, user_id, ts, text) of a stream are
    classified by a fitted text pipeline, micro-batch by micro-batch, gated by
    ``threshold``, and go through the context automaton."""
    scored = chat.classify_turns(turns, model, tokens, threshold=threshold)
    return context_stream(scored.select("event_id", "user_id", "ts", "lab", "conf"), **kw)


def validate_ratings(ratings: DataFrame, catalog_items: DataFrame, lo: float = 1.0, hi: float = 5.0):
    """ST3: stream-static join to the catalogue plus the rating-range predicate.

    Returns ``(valid, rejected)``; rejected rows carry a ``reason``. The
    catalogue side is static, so Spark joins each micro-batch against it
    (broadcast when AQE sees it is small).
    """
    known = ratings.join(catalog_items.select("item_id", F.lit(True).alias("_known")), "item_id", "left")
    ok_range = F.coalesce(F.col("rating").between(lo, hi), F.lit(False))  # a null rating is out of range
    is_known = F.coalesce(F.col("_known"), F.lit(False))
    valid = known.where(is_known & ok_range).drop("_known")
    rejected = (known.where(~(is_known & ok_range))
                .withColumn("reason", F.when(~is_known, "unknown item").otherwise("rating out of range"))
                .drop("_known"))
    return valid, rejected


def start_rating_ingest(ratings: DataFrame, catalog_items: DataFrame, out_path: str, reject_path: str,
                        checkpoint: str, trigger: dict | None = None):
    """ST3/ST4: validated ratings appended to one parquet table, rejects to a side table. Each
    batch has a partition of its own, so a replay writes it again instead of twice."""
    def write(batch: DataFrame, epoch_id: int):
        batch = batch.persist()  # read for both tables
        valid, rejected = validate_ratings(batch, catalog_items)
        put_batch(valid, out_path, epoch_id)
        put_batch(rejected, reject_path, epoch_id)
        batch.unpersist()

    w = ratings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_append_log(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                     trigger: dict | None = None):
    """ST4: append-only message / impression log with exactly-once file commits."""
    w = stream.writeStream.format("parquet").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(**(trigger or {"availableNow": True})).start()
