"""Driver queries: per-session stateful behaviours (W1-W5), batch and stream forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry.plans import adapters as ad
from quarry.plans import q_answer as QA
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register
from quarry.plans.q_history import HISTORY_SQL
from quarry.plans.q_text import MSG_PAIRS
from quarry.session import scratch_path
from quarry.streaming import answers as SA
from quarry.streaming import event_time as ET
from quarry.streaming import operators as W

TTL_S = 2 * 86400.0     # driver TTL: two days (events span a month)
GAP_S = 3600.0          # driver limiter: one call per hour per user


def _events(spark, sf):
    e = ad.table(spark, sf, "events")
    return _submits(e)


def _submits(e):
    """Every seventh event is a blank message."""
    return e.withColumn("history_key", F.floor(F.col("value") / 10).cast("string")).withColumn(
        "message", F.when(F.col("event_id") % 7 == 0, F.lit(" ")).otherwise(F.col("event_type")))


DUP_SQL = """
SELECT event_id, user_id,
  coalesce(s = last_value(s IGNORE NULLS) OVER w, false) AS is_duplicate
FROM (SELECT *, CASE WHEN event_id % 7 <> 0 AND trim(event_type) <> ''
                     THEN event_type || '|' || CAST(floor(value / 10) AS BIGINT)::VARCHAR END AS s FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _ttl_sql(key: str) -> str:
    """W2 twin: a recursive walk over each key's requests in time order; the computed-at time
    is carried from row to row and reset on a miss."""
    return f"""WITH RECURSIVE ev AS (
  SELECT {key} AS k, event_id, epoch_us(ts) / 1e6 AS t,
         row_number() OVER (PARTITION BY {key} ORDER BY epoch_us(ts) / 1e6, event_id) AS rn FROM events),
chain(k, rn, c, hit) AS (
  SELECT k, rn, t, false FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, CASE WHEN e.t - ch.c <= {TTL_S} THEN ch.c ELSE e.t END, e.t - ch.c <= {TTL_S}
  FROM chain ch JOIN ev e ON e.k = ch.k AND e.rn = ch.rn + 1)
SELECT e.event_id, ch.hit, round(ch.c, 6) AS computed_at FROM ev e JOIN chain ch ON e.k = ch.k AND e.rn = ch.rn"""


@register("dup_submit", DUP_SQL)
def q_dup_submit(spark, sf):
    """Same message (event type) with the same history key as the user's previous submit."""
    d = W.duplicate_submits_split(_events(spark, sf), "user_id", ["ts", "event_id"], "message", "history_key")
    return d.select("event_id", "user_id", "is_duplicate")


@register("dup_submit_stream", DUP_SQL)
def q_dup_submit_stream(spark, sf):
    s = _submits(SA.table_stream(spark, sf, "events"))
    r = SA.run_available(W.duplicate_submits_stream(s, "user_id", "ts", "message", "history_key", "event_id"),
                         "dup-submit")
    return r.select("event_id", "user_id", "is_duplicate")


SLICES, LATE_S = 3, 86400      # micro-batches of a replay, and how late its rows are at most


def _out_of_order(df, ts: str, key: str, id_col: str):
    """A file stream of the rows in an order of arrival up to LATE_S after their event, by a hash; a closing row of key -1, a year
    on, moves the watermark past all others.  Returns (stream, the watermark's delay)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"replay-{uuid.uuid4().hex}")
    at = W.epoch_seconds(df, ts)
    first, last = df.select(F.min(at), F.max(at)).first()
    first, last = first or 0.0, last or 0.0
    length = (last + LATE_S - first) / SLICES + 1
    arrival = F.floor((at + F.pmod(F.xxhash64(key, id_col), F.lit(LATE_S)) - first) / length)
    closing = spark.range(1).select(*[
        (F.lit(-1) if c.name == key else F.lit(0) if c.name == id_col else F.timestamp_seconds(F.lit(last + 366 * 86400)) if c.name == ts
         else F.lit(None)).cast(c.dataType).alias(c.name) for c in df.schema])
    files = spark.sparkContext.defaultParallelism
    for k in range(SLICES):
        rows = df.where(arrival == k)
        (rows.unionByName(closing) if k == SLICES - 1 else rows).repartition(files).write.mode("append").parquet(path)
    return SA.file_stream(spark, path, df.schema, max_files_per_trigger=files), f"{int(length + LATE_S) + 1} seconds"


@register("dup_submit_late", DUP_SQL)
def q_dup_submit_late(spark, sf):
    """W1 by event time, on events that come up to a day late: the flags are those of the batch form."""
    stream, delay = _out_of_order(_events(spark, sf).select("event_id", "user_id", "ts", "message", "history_key"), "ts", "user_id",
                                  "event_id")
    r = ET.run_in_order(ET.duplicate_submits_in_order(stream, "user_id", "ts", "message", "history_key", "event_id", delay), "dup-late")
    return r.select("event_id", "user_id", "is_duplicate")


@register("ttl_reuse", _ttl_sql("user_id || '/' || event_type"))
def q_ttl_reuse(spark, sf):
    """Per (user, event type) result reuse within the TTL of when it was computed."""
    r = W.ttl_reuse_split(ad.table(spark, sf, "events"), ["user_id", "event_type"], "ts", "event_id", TTL_S)
    return r.select("event_id", "hit", F.round("computed_at", 6).alias("computed_at"))


@register("ttl_reuse_stream", _ttl_sql("CAST(user_id AS VARCHAR) || '/' || event_type"))
def q_ttl_reuse_stream(spark, sf):
    s = SA.table_stream(spark, sf, "events") \
        .withColumn("key", F.concat_ws("/", F.col("user_id").cast("string"), "event_type"))
    r = SA.run_available(W.ttl_reuse_stream(s, "key", "ts", "event_id", TTL_S), "ttl-reuse")
    return r.select("event_id", "hit", F.round("computed_at", 6).alias("computed_at"))


@register("stream_history", S.with_(MSG_PAIRS) + HISTORY_SQL)
def q_stream_history(spark, sf):
    """Conversation messages arriving as a stream; each new (user, assistant) pair sees its
    session's last turns (same result as the batch ``history_window``)."""
    conv = SA.table_stream(spark, sf, "conversations")
    h = SA.run_available(W.history_stream(conv), "history")
    return h.select("conv_id", "pair_no", "n_history", "history_text")


@register("stream_history_late", S.with_(MSG_PAIRS) + HISTORY_SQL)
def q_stream_history_late(spark, sf):
    """W3 by event time, on messages (an hour between turns) that come up to a day late."""
    conv = ad.table(spark, sf, "conversations")
    conv = conv.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn") * 3600 + F.col("conv_id") % 3600))
    stream, delay = _out_of_order(conv, "ts", "conv_id", "turn")
    h = ET.run_in_order(ET.history_in_order(stream, "conv_id", "ts", delay=delay), "history-late")
    return h.select("conv_id", "pair_no", "n_history", "history_text")


@register("stream_answers", QA._STREAM_SQL)
def q_stream_answers(spark, sf):
    """Benchmark questions arriving as a stream, answered per micro-batch."""
    b = SA.table_stream(spark, sf, "benchmark")
    e = ad.table(spark, sf, "embeddings").select("vec_id", "embedding")
    qs = b.join(e, b.item_id == e.vec_id).select(F.col("item_id").alias("qid"), F.col("text").alias("question"),
                                                   F.col("embedding").alias("qvec"))
    out = SA.answer_stream(qs, ad.corpus(spark, sf), ad.judge_scores(spark, sf), scope_groups=L.LATIN_SCOPE_GROUPS,
                           rerank_words=QA.WORDS, min_relevance=QA.MIN_REL)
    return out.drop("batch_id")


@register("rate_schedule", f"""
SELECT user_id, event_id, round(arrive_s, 6) AS arrive_s, round(start_s, 6) AS start_s,
       round(start_s - arrive_s, 6) AS wait_s
FROM (SELECT *, i * {GAP_S}::DOUBLE + max(arrive_s - i * {GAP_S}::DOUBLE) OVER (
          PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_s
      FROM (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS arrive_s,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events))""")
def q_rate_schedule(spark, sf):
    """Per-user start times under a minimum interval between calls."""
    r = W.rate_schedule_split(ad.table(spark, sf, "events"), "user_id", "ts", "event_id", GAP_S)
    return r.select("user_id", "event_id", *[F.round(c, 6).alias(c) for c in ["arrive_s", "start_s", "wait_s"]])
