"""Stream forms equal batch forms (Trigger.AvailableNow over the same rows)."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators.answer import history_window, message_pairs
from quarry.streaming import answers as SA
from quarry.streaming import operators as W


def _events(spark, d):
    rows = [(i, i % 3, ["view", "click"][(i // 6) % 2], i * 60, str((i // 12) % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, t long, hk string") \
        .withColumn("ts", F.timestamp_seconds("t")).drop("t")
    # a stream sees events in arrival order: one file in time order, as the events table is
    df.orderBy("ts").coalesce(1).write.mode("overwrite").parquet(d)
    return df


def test_duplicate_and_ttl_stream_equal_batch(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-events-")
    df = _events(spark, os.path.join(d, "events"))
    stream = SA.file_stream(spark, os.path.join(d, "events"), df.schema)
    batch = {r.event_id: r.is_duplicate for r in
             W.duplicate_submits(df, "user_id", ["ts", "event_id"], "event_type", "hk").collect()}
    got = {r.event_id: r.is_duplicate for r in SA.run_available(
        W.duplicate_submits_stream(stream, "user_id", "ts", "event_type", "hk", "event_id"), "t-dup").collect()}
    assert got == batch and any(batch.values())
    batch = {r.event_id: r.hit for r in W.ttl_reuse(df, ["user_id"], "ts", "event_id", 400).collect()}
    got = {r.event_id: r.hit for r in SA.run_available(
        W.ttl_reuse_stream(stream, "user_id", "ts", "event_id", 400), "t-ttl").collect()}
    assert got == batch and any(batch.values()) and not all(batch.values())


def test_history_stream_equals_batch(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "system", "s"), (1, 3, "user", "q2"),
            (1, 4, "user", "q3"), (1, 5, "assistant", "a3"), (2, 0, "assistant", "x"), (2, 1, "user", "q"),
            (2, 2, "assistant", "a"), (2, 3, "user", "dangling")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    d = tempfile.mkdtemp(prefix="quarry-test-conv-")
    df.orderBy("conv_id", "turn").coalesce(1).write.mode("overwrite").parquet(os.path.join(d, "c"))
    batch = {(r.conv_id, r.pair_no): r.history_text for r in history_window(message_pairs(df)).collect()}
    stream = SA.file_stream(spark, os.path.join(d, "c"), df.schema)
    got = {(r.conv_id, r.pair_no): r.history_text for r in SA.run_available(W.history_stream(stream), "t-h").collect()}
    assert got == batch
    pairs = {(r.conv_id, r.user, r.assistant) for r in message_pairs(df).collect()}
    assert pairs == {(1, "q1", "a1"), (1, "q3", "a3"), (2, "q", "a")}


def test_split_forms_equal_window_forms_on_a_hot_key(spark):
    from pyspark.sql import functions as F
    # one user holds most events, so its rows span several range partitions
    rows = [(i, 0 if i % 4 else 1 + i % 3, ["view", "click"][(i // 5) % 2], i * 37 % 5000, str((i // 7) % 2))
            for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, t long, hk string") \
        .withColumn("ts", F.timestamp_seconds("t")).drop("t")
    a = {r.event_id: r.is_duplicate for r in
         W.duplicate_submits(df, "user_id", ["ts", "event_id"], "event_type", "hk").collect()}
    b = {r.event_id: r.is_duplicate for r in
         W.duplicate_submits_split(df, "user_id", ["ts", "event_id"], "event_type", "hk", n_parts=6).collect()}
    assert a == b and any(a.values())
    a = {r.event_id: (r.start_s, r.wait_s) for r in W.rate_schedule(df, "user_id", "ts", "event_id", 90.0).collect()}
    b = {r.event_id: (r.start_s, r.wait_s) for r in
         W.rate_schedule_split(df, "user_id", "ts", "event_id", 90.0, n_parts=6).collect()}
    assert a == b and any(w > 0 for _, w in a.values())


def test_dedup_within_delay_drops_close_repeats(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-wm-")
    rows = [(1, 7, "view", 0), (2, 7, "view", 30), (3, 7, "click", 40), (4, 8, "view", 50)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, t long") \
        .withColumn("ts", F.timestamp_seconds("t")).drop("t")
    df.orderBy("ts").coalesce(1).write.mode("overwrite").parquet(os.path.join(d, "e"))
    stream = SA.file_stream(spark, os.path.join(d, "e"), df.schema)
    got = {r.event_id for r in SA.run_available(W.dedup_within_delay(stream, ["user_id", "event_type"], "ts",
                                                                      "10 minutes"), "t-wm").collect()}
    assert {3, 4} <= got and len(got & {1, 2}) == 1 and len(got) == 3   # one of the two close repeats


def test_ttl_split_equals_fold_on_a_hot_key(spark):
    rows = [(i, 0 if i % 5 else 1 + i % 2, "view", (i * 53) % 9000) for i in range(500)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, t long") \
        .withColumn("ts", F.timestamp_seconds("t")).drop("t")
    a = {r.event_id: (r.hit, r.computed_at) for r in W.ttl_reuse(df, ["user_id", "event_type"], "ts", "event_id",
                                                                  120).collect()}
    b = {r.event_id: (r.hit, r.computed_at) for r in W.ttl_reuse_split(df, ["user_id", "event_type"], "ts", "event_id",
                                                                        120, n_parts=7).collect()}
    assert a == b and any(h for h, _ in a.values()) and not all(h for h, _ in a.values())


def test_blank_messages_leave_the_guard_as_it_is(spark):
    from quarry.streaming import operators as W
    rows = [(1, 1, "a", "h"), (1, 2, " ", "h"), (1, 3, "a", "h"), (1, 4, None, "h"), (1, 5, "a", None), (1, 6, "a", None), (1, 7, "b", "h")]
    df = spark.createDataFrame(rows, "k long, n long, m string, h string")
    for f in (W.duplicate_submits, W.duplicate_submits_split):
        got = {r.n: r.is_duplicate for r in f(df, "k", ["n"], "m", "h").collect()}
        assert got == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True, 7: False}


def test_rows_of_a_key_are_sorted_across_arrow_batches():
    import pandas as pd
    from quarry.streaming.operators import in_order
    parts = [pd.DataFrame({"t": t, "id": t}) for t in ([5, 4], [], [3, 1], [2])]
    assert [p["t"].tolist() for p in in_order(iter(parts), ["t", "id"])] == [[1, 2, 3, 4, 5]]
    assert list(in_order(iter([]), ["t"])) == []


def test_tables_that_are_folders_are_streamed_whole(spark):
    from quarry.plans.q_streaming import q_stream_history
    d = tempfile.mkdtemp(prefix="quarry-test-folder-")
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}-{t}") for c in range(6) for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.repartition(5).write.parquet(f"{d}/folder/conversations.parquet")     # a conversation's turns lie in several files, in any order
    df.coalesce(1).write.parquet(f"{d}/parts")
    os.makedirs(f"{d}/file")
    part = next(f for f in os.listdir(f"{d}/parts") if f.endswith(".parquet"))
    os.link(f"{d}/parts/{part}", f"{d}/file/conversations.parquet")
    want = {(r.conv_id, r.pair_no): (r.n_history, r.history_text) for r in history_window(message_pairs(df)).collect()}
    for kind in ("folder", "file"):
        got = q_stream_history(spark, f"{d}/{kind}").collect()
        assert len(got) == len(want) and {(r.conv_id, r.pair_no): (r.n_history, r.history_text) for r in got} == want


def test_ttl_stream_takes_only_the_columns_it_needs_and_ties_by_id(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-ttl-")
    rows = [(9 - i, "a" if i % 3 else "b", 1000 + i // 2 * 50, "x" * 10) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, k string, t long, other string").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    df.repartition(3).write.parquet(f"{d}/t.parquet")
    r = W.ttl_reuse_stream(SA.table_stream(spark, d, "t"), "k", "ts", "id", 60)
    plan = r._jdf.queryExecution().analyzed().toString()
    grouped = next(line for line in plan.split("\n") if "FlatMapGroupsInPandasWithState" in line)
    assert "other" not in grouped
    got = {x.id: (x.hit, x.computed_at) for x in SA.run_available(r, "t-ttl").collect()}
    assert got == {x.id: (x.hit, x.computed_at) for x in W.ttl_reuse(df, ["k"], "ts", "id", 60).collect()}
