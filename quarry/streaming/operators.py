"""Per-session stateful behaviours (W1-W5) as batch window operators and Structured
Streaming operators.

Plain batch forms use windows partitioned by the session key (``lag``, running ``max``) —
sort-based, O(1) memory per row.  The ``*_split`` forms (used by the registered queries)
first range-partition by (session, time) so that one very busy session is spread over
many tasks, and carry values across chunk boundaries through small per-chunk tables.
Stream forms keep O(1) (W1, W2) or bounded (W3: 15 pairs) state per key in
``applyInPandasWithState``; for a stream in time order their output equals the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params


def epoch_seconds(df: DataFrame, ts: str) -> F.Column:
    """Event time as double seconds since the epoch: a TIMESTAMP is an instant; a
    TIMESTAMP_NTZ is read as UTC wall time, independent of the session time zone."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)") / 1e6
    return F.unix_micros(F.col(ts).cast("timestamp")) / 1e6


def in_order(batches: Iterator[pd.DataFrame], by: list) -> Iterator[pd.DataFrame]:
    """A key's rows of one micro-batch, sorted as a whole: they may come in several Arrow batches."""
    parts = [pdf for pdf in batches if len(pdf)]
    if parts:
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        yield pdf if len(pdf) == 1 else pdf.sort_values(by, kind="stable")


# ---- W1: duplicate-submit guard -------------------------------------------------------------
def duplicate_submits(df: DataFrame, key: str, order, message: str, history: str) -> DataFrame:
    """W1 batch: a submit equal to the session's previous one (same message, same history
    key) is a duplicate; blank messages never are, and leave the guard as it is.  Null histories are equal."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(_submit(message, history), ignorenulls=True).over(w)
    return df.withColumn("is_duplicate", F.coalesce(_submit(message, history) == prev, F.lit(False)))


def _submit(message: str, history: str) -> F.Column:
    """What the guard remembers of a submit; null for a blank message."""
    return F.when(F.trim(F.coalesce(F.col(message), F.lit(""))) != "", F.struct(
        F.col(message).alias("m"), F.col(history).isNull().alias("none"), F.coalesce(F.col(history).cast("string"), F.lit("")).alias("h")))


NO_SUBMIT = (None, None)


def guard(last: tuple, message, history) -> tuple[tuple, bool]:
    """W1 for one submit: (what is remembered after it, whether it repeats the one before)."""
    if message is None or not str(message).strip():
        return last, False
    submit = (message, "null" if history is None or history != history else f"={history}")
    return submit, submit == tuple(last)


def duplicate_submits_stream(stream: DataFrame, key: str, ts: str, message: str, history: str,
                             id_col: str) -> DataFrame:
    """W1 stream: state = the session's last (message, history)."""
    key_type = stream.schema[key].dataType
    id_type = stream.schema[id_col].dataType
    out = T.StructType([T.StructField(key, key_type), T.StructField(id_col, id_type),
                        T.StructField("is_duplicate", T.BooleanType())])
    state_schema = T.StructType([T.StructField("message", T.StringType()), T.StructField("history", T.StringType())])
    stream = stream.select(key, id_col, ts, message, history)       # each column of each key is converted by itself

    def step(k, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else NO_SUBMIT
        for pdf in in_order(batches, [ts, id_col]):
            flags = []
            for m, h in zip(pdf[message].tolist(), pdf[history].tolist()):
                last, dup = guard(last, m, h)
                flags.append(dup)
            yield pd.DataFrame({key: [k[0]] * len(pdf), id_col: pdf[id_col].tolist(), "is_duplicate": flags})
        state.update(last)

    return stream.groupBy(key).applyInPandasWithState(step, out, state_schema, "append", "NoTimeout")


# ---- W2: result reuse with a TTL ---------------------------------------------------------------
def _ttl_fold(times, ttl, c=None):
    """Hits for sorted event times: a result computed at c serves every request at t with
    t - c <= ttl; a miss recomputes (c = t).  A hit does not refresh c, the time before the first of them."""
    out = []
    for t in times:
        if c is not None and t - c <= ttl:
            out.append((True, c))
        else:
            c = t
            out.append((False, c))
    return out


def ttl_reuse(df: DataFrame, keys, ts: str, id_col: str, ttl_s: float = params.CACHE_TTL_SECONDS) -> DataFrame:
    """W2 batch: per key, mark requests served from a cached result (hit) or recomputed.

    Rows are hash-partitioned by key and sorted by time within partitions; one
    ``mapInPandas`` pass folds each key's run with O(1) state (the current key's
    computed-at time).  Output: id, hit, computed_at."""
    keys = list(keys)
    d = (df.select(*keys, id_col, epoch_seconds(df, ts).alias("_t")).repartition(*keys)
         .sortWithinPartitions(*keys, "_t", id_col))
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("hit", T.BooleanType()),
                           T.StructField("computed_at", T.DoubleType())])

    def run(batches):
        cur_key, c = None, None
        for pdf in batches:
            ks = list(zip(*[pdf[k].tolist() for k in keys]))
            hits, cs = [], []
            for kk, t in zip(ks, pdf["_t"].tolist()):
                if kk != cur_key:
                    cur_key, c = kk, None
                if c is not None and t - c <= ttl_s:
                    hits.append(True)
                else:
                    c = t
                    hits.append(False)
                cs.append(c)
            yield pd.DataFrame({id_col: pdf[id_col].tolist(), "hit": hits, "computed_at": cs})

    return d.mapInPandas(run, schema)


def ttl_reuse_stream(stream: DataFrame, key: str, ts: str, id_col: str,
                     ttl_s: float = params.CACHE_TTL_SECONDS) -> DataFrame:
    """W2 stream: state = time the key's cached result was computed."""
    id_type = stream.schema[id_col].dataType
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("hit", T.BooleanType()),
                        T.StructField("computed_at", T.DoubleType())])
    state_schema = T.StructType([T.StructField("computed_at", T.DoubleType())])
    # the least that a key's rows need: most keys have few, and each column of each key is converted by itself
    s = stream.select(key, F.col(id_col).alias("_id"), epoch_seconds(stream, ts).alias("_t"))

    def step(k, batches, state):
        c = state.get[0] if state.exists else None
        parts = [(pdf["_t"].to_numpy(), pdf["_id"].to_numpy()) for pdf in batches if len(pdf)]
        if parts:
            times, ids = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
            order = (pd.DataFrame({"t": times, "i": ids}).sort_values(["t", "i"], kind="stable").index.to_numpy()
                     if ids.dtype == object else np.lexsort((ids, times)))
            made = _ttl_fold(times[order].tolist(), ttl_s, c)
            c = made[-1][1]
            state.update((c,))
            yield pd.DataFrame({id_col: ids[order], "hit": [h for h, _ in made], "computed_at": [at for _, at in made]})

    return s.groupBy(key).applyInPandasWithState(step, out, state_schema, "append", "NoTimeout")


# ---- W3: per-session history on a message stream ------------------------------------------------
NO_PAIRS = (None, 0, [], [])
PAIRS_STATE = "pending string, n bigint, users array<string>, answers array<string>"


def render_history(users: list, answers: list, text_turns: int = params.HISTORY_TEXT_TURNS) -> str:
    """A4's text of a list of pairs."""
    from quarry.operators.answer import ASSISTANT_LABEL, NO_HISTORY, USER_LABEL
    if not users:
        return NO_HISTORY
    lines = []
    for u, a in list(zip(users, answers))[-text_turns:]:
        lines += [f"{USER_LABEL}{(u or '')[:params.HISTORY_USER_CHARS]}...", f"{ASSISTANT_LABEL}{(a or '')[:params.HISTORY_ASSISTANT_CHARS]}..."]
    return "\n".join(lines)


def pair_up(carry: tuple, role, text, max_turns: int, text_turns: int) -> tuple[tuple, tuple | None]:
    """W3 for one message: (carry after it, the finished pair's (pair_no, n_history, history_text) or None)."""
    pending, n, users, answers = carry
    if role == "user":
        return (text, int(n), list(users), list(answers)), None
    if role not in ("assistant", "ai", "bot") or pending is None:
        return carry, None
    users, answers = list(users), list(answers)
    pair = (int(n) + 1, len(users), render_history(users, answers, text_turns))
    return (None, int(n) + 1, (users + [pending])[-max_turns:], (answers + [text])[-max_turns:]), pair


def history_stream(messages: DataFrame, key: str = "conv_id", order: str = "turn",
                   max_turns: int = params.MAX_HISTORY_TURNS, text_turns: int = params.HISTORY_TEXT_TURNS
                   ) -> DataFrame:
    """Messages of each session arrive as a stream; they are paired as in A5 (latest user
    turn answered by the next assistant turn) and every new pair sees the session's previous
    pairs (at most ``max_turns`` kept in state) rendered as in A4.
    Output: key, pair_no, turn, n_history, history_text."""
    key_type = messages.schema[key].dataType
    out = T.StructType([T.StructField(key, key_type), T.StructField("pair_no", T.LongType()),
                        T.StructField(order, T.LongType()), T.StructField("n_history", T.LongType()),
                        T.StructField("history_text", T.StringType())])
    state_schema = PAIRS_STATE

    def step(k, batches, state):
        carry = state.get if state.exists else NO_PAIRS
        for pdf in in_order(batches, [order]):
            rows = []
            for t, role, text in zip(pdf[order].tolist(), pdf["role"].tolist(), pdf["text"].tolist()):
                carry, pair = pair_up(carry, role, text, max_turns, text_turns)
                if pair:
                    rows.append((k[0], pair[0], int(t), *pair[1:]))
            yield pd.DataFrame(rows, columns=[key, "pair_no", order, "n_history", "history_text"])
        state.update(carry)

    return messages.groupBy(key).applyInPandasWithState(step, out, state_schema, "append", "NoTimeout")


# ---- W5: throughput limiter ---------------------------------------------------------------------------
def rate_schedule(df: DataFrame, key: str, ts: str, id_col: str, gap_s: float = 60.0 / params.LLM_RPM) -> DataFrame:
    """Start time t_i = max(arrive_i, t_{i-1} + gap) per key, computed in closed form
    t_i = i*gap + max_{j<=i}(arrive_j - j*gap) with a running-max window."""
    w = Window.partitionBy(key).orderBy(ts, id_col)
    d = df.select(key, id_col, epoch_seconds(df, ts).alias("arrive_s"), (F.row_number().over(w) - 1).alias("_i"))
    run = Window.partitionBy(key).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("start_s", F.col("_i") * gap_s + F.max(F.col("arrive_s") - F.col("_i") * gap_s).over(run))
    return d.withColumn("wait_s", F.col("start_s") - F.col("arrive_s")).drop("_i")


# ---- skew-safe forms: a session split across range partitions ---------------------------------------
def _range_chunks(df: DataFrame, key: str, order, n_parts: int | None) -> DataFrame:
    """Range-partition by (key, order...) and tag rows with the partition id ``_pid``: a
    session holding a large share of all rows is spread over consecutive partitions."""
    from quarry.session import ensure_checkpoint_dir
    n = n_parts or df.sparkSession.sparkContext.defaultParallelism
    ensure_checkpoint_dir(df.sparkSession)
    # range bounds come from a sample; checkpointing fixes one assignment of rows to chunks
    # for every branch that reads it (and survives executor loss without re-sampling)
    return df.repartitionByRange(n, key, *order).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)


def rate_schedule_split(df: DataFrame, key: str, ts: str, id_col: str, gap_s: float = 60.0 / params.LLM_RPM,
                        n_parts: int | None = None) -> DataFrame:
    """W5 for skewed sessions; same result as ``rate_schedule``.

    Rows are range-partitioned by (key, ts, id); each (key, partition) chunk numbers its rows
    and takes its running max locally; the global row index adds the row counts of the key's
    earlier chunks, and the running max starts from the max of the earlier chunks (both from
    small per-chunk tables with at most partitions-many rows per key)."""
    d = _range_chunks(df.select(key, id_col, epoch_seconds(df, ts).alias("arrive_s"), F.col(ts).alias("_ts")),
                      key, ["_ts", id_col], n_parts)
    wl = Window.partitionBy(key, "_pid").orderBy("_ts", id_col)
    d = d.withColumn("_li", F.row_number().over(wl) - 1)
    cnt = d.groupBy(key, "_pid").agg(F.count("*").alias("_n"))
    off = cnt.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(off.select(key, "_pid", "_off"), [key, "_pid"]).withColumn("_i", F.col("_off") + F.col("_li"))
    d = d.withColumn("_v", F.col("arrive_s") - F.col("_i") * gap_s)
    mx = d.groupBy(key, "_pid").agg(F.max("_v").alias("_m"))
    carry = mx.withColumn("_c", F.max("_m").over(
        Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).select(key, "_pid", "_c")
    d = d.join(carry, [key, "_pid"]).withColumn(
        "_run", F.max("_v").over(wl.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.when(F.col("_c").isNull(), F.col("_run")).otherwise(F.greatest("_c", "_run"))
    out = d.withColumn("start_s", F.col("_i") * gap_s + best)
    return out.select(key, id_col, "arrive_s", "start_s", (F.col("start_s") - F.col("arrive_s")).alias("wait_s"))


def duplicate_submits_split(df: DataFrame, key: str, order, message: str, history: str,
                            n_parts: int | None = None) -> DataFrame:
    """W1 for skewed sessions; same result as ``duplicate_submits``.  The previous submit of a
    chunk's first rows is the last one of the key's earlier chunks."""
    order = list(order)
    d = _range_chunks(df, key, order, n_parts)
    d = d.withColumn("_s", _submit(message, history))
    before = Window.partitionBy(key, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.last("_s", ignorenulls=True).over(before))
    last = d.where(F.col("_s").isNotNull()).groupBy(key, "_pid").agg(F.max_by("_s", F.struct(*order)).alias("_last"))
    chunks = d.select(key, "_pid").distinct().join(last, [key, "_pid"], "left")
    earlier = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    prev = chunks.withColumn("_prev", F.last("_last", ignorenulls=True).over(earlier)).select(key, "_pid", "_prev")
    d = d.join(prev, [key, "_pid"], "left")
    dup = F.col("_s") == F.coalesce("_in", "_prev")
    return d.withColumn("is_duplicate", F.coalesce(dup, F.lit(False))).drop("_s", "_in", "_prev", "_pid")


def dedup_within_delay(stream: DataFrame, keys, ts: str, delay: str = "10 minutes") -> DataFrame:
    """W1, time-bounded variant: keep one row per key among repeats arriving within the
    watermark delay (``dropDuplicatesWithinWatermark``; state is evicted once the watermark
    passes; which repeat of one micro-batch survives is not specified).
    Unlike the exact guard above it may also drop repeats that are somewhat further apart,
    so it is not used where exact results are checked."""
    t = stream.withColumn("_ets", F.col(ts).cast("timestamp"))
    return t.withWatermark("_ets", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_ets")


def ttl_reuse_split(df: DataFrame, keys, ts: str, id_col: str, ttl_s: float = params.CACHE_TTL_SECONDS,
                    n_parts: int | None = None) -> DataFrame:
    """W2 for skewed keys; same result as ``ttl_reuse``.

    A gap longer than the TTL always starts afresh (the cached result has expired), so each
    key's timeline is cut at such gaps into independent segments.  The previous request of a
    chunk's first row comes from the key's previous range chunk, and segment numbers are a
    running count carried across chunks; the fold then runs per (key, segment), hash-spread
    over tasks, so a busy key's segments are folded in parallel."""
    keys = list(keys)
    kcol = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]) if len(keys) > 1 else F.col(keys[0])
    base = df.select(kcol.alias("_key"), id_col, epoch_seconds(df, ts).alias("_t"))
    d = _range_chunks(base, "_key", ["_t", id_col], n_parts)
    wl = Window.partitionBy("_key", "_pid").orderBy("_t", id_col)
    d = d.withColumn("_prev", F.lag("_t").over(wl)).withColumn("_first", F.row_number().over(wl) == 1)
    last = d.groupBy("_key", "_pid").agg(F.max("_t").alias("_last"))   # chunks are time-ordered per key
    prev_last = last.withColumn("_pl", F.lag("_last").over(Window.partitionBy("_key").orderBy("_pid"))) \
        .select("_key", "_pid", "_pl")
    d = d.join(prev_last, ["_key", "_pid"], "left").withColumn(
        "_prev", F.when(F.col("_first"), F.col("_pl")).otherwise(F.col("_prev")))
    d = d.withColumn("_new", (F.col("_prev").isNull() | (F.col("_t") - F.col("_prev") > ttl_s)).cast("int"))
    d = d.withColumn("_lseg", F.sum("_new").over(wl.rowsBetween(Window.unboundedPreceding, 0)))
    cnt = d.groupBy("_key", "_pid").agg(F.sum("_new").alias("_n"))
    off = cnt.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(off.select("_key", "_pid", "_off"), ["_key", "_pid"]).withColumn("_seg", F.col("_off") + F.col("_lseg"))
    seg = (d.select("_key", "_seg", id_col, "_t").repartition("_key", "_seg")
           .sortWithinPartitions("_key", "_seg", "_t", id_col))
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("hit", T.BooleanType()),
                           T.StructField("computed_at", T.DoubleType())])

    def run(batches):
        cur, c = None, None
        for pdf in batches:
            hits, cs = [], []
            for kk, sg, t in zip(pdf["_key"].tolist(), pdf["_seg"].tolist(), pdf["_t"].tolist()):
                if (kk, sg) != cur:
                    cur, c = (kk, sg), None
                if c is not None and t - c <= ttl_s:
                    hits.append(True)
                else:
                    c = t
                    hits.append(False)
                cs.append(c)
            yield pd.DataFrame({id_col: pdf[id_col].tolist(), "hit": hits, "computed_at": cs})

    return seg.mapInPandas(run, schema)
