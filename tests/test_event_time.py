"""Streams by event time: shuffled micro-batches give the batch form's output, idle sessions lose their state."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from quarry.operators.answer import history_window, message_pairs
from quarry.streaming import answers as SA
from quarry.streaming import event_time as ET
from quarry.streaming import operators as W

SUBMITS = "event_id long, user_id long, m string, h string, t double"


def _replay(spark, rows, schema, per_batch, closing):
    """A stream of the rows in the order given, ``per_batch`` to a micro-batch, and a closing row far ahead."""
    d = os.path.join(tempfile.mkdtemp(prefix="quarry-test-order-"), "rows")
    parts = [rows[i:i + per_batch] for i in range(0, len(rows), per_batch)] + [[closing]]
    for k, part in enumerate(parts):
        df = spark.createDataFrame(part, schema).withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("long")))
        df.coalesce(1).write.mode("append").parquet(d)
        for f in os.listdir(d):     # the source takes files by modification time
            path = os.path.join(d, f)
            if f.endswith(".parquet") and not os.path.exists(path + ".seen"):
                os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
                open(path + ".seen", "w").close()
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("long")))
    return df, SA.file_stream(spark, d, df.schema)


def _late_by(rows, at, most, seed):
    """Rows in an order of arrival up to ``most`` seconds after their event."""
    r = random.Random(seed)
    return sorted(rows, key=lambda row: row[at] + r.random() * most)


def test_submits_in_any_order_equal_the_batch_form(spark):
    rows = [(i, i % 3 if i % 4 else 0, [None, " ", "a", "b"][(i // 5) % 4] if i % 2 else "a", [None, "x"][(i // 8) % 2], 100 + 7.25 * i)
            for i in range(120)]
    rows[50] = (*rows[50][:4], rows[49][4])     # a tie in time
    shuffled = _late_by(rows, 4, 240, 1)
    df, stream = _replay(spark, shuffled, SUBMITS, 40, (10 ** 6, -1, "end", None, 10.0 ** 7))
    want = {r.event_id: r.is_duplicate for r in W.duplicate_submits(df, "user_id", ["ts", "event_id"], "m", "h").collect()}
    got = ET.run_in_order(ET.duplicate_submits_in_order(stream, "user_id", "ts", "m", "h", "event_id", "5 minutes"), "t-order")
    got = [(r.event_id, r.is_duplicate) for r in got.collect()]
    assert len(got) == len(dict(got)) and dict(got) == want and any(want.values())


def test_history_in_any_order_equals_the_batch_form(spark):
    r = random.Random(3)
    rows, t = [], 100.0
    for turn in range(260):
        t += 5
        conv = 0 if turn % 3 else 1 + turn % 4      # one conversation holds two thirds
        rows.append((conv, turn, r.choice(["user", "assistant", "system", "bot"]), f"w{turn} " * 60, t))
    schema = "conv_id long, turn long, role string, text string, t double"
    df, stream = _replay(spark, _late_by(rows, 4, 200, 2), schema, 90, (-1, 0, "user", "end", 10.0 ** 7))
    want = {(x.conv_id, x.turn): (x.pair_no, x.n_history, x.history_text) for x in history_window(message_pairs(df)).collect()}
    got = ET.run_in_order(ET.history_in_order(stream, "conv_id", "ts", delay="5 minutes"), "t-order-h").collect()
    assert len(got) == len(want) and {(x.conv_id, x.turn): (x.pair_no, x.n_history, x.history_text) for x in got} == want
    assert max(n for _, n, _ in want.values()) == 15


def test_idle_sessions_lose_their_state(spark):
    # user 1 repeats "a" after a pause within the limit and after one beyond it; user 2 stays away
    rows = [(1, 1, "a", "h", 1.0), (2, 2, "a", "h", 10.0), (3, 1, "a", "h", 500.0), (4, 3, "z", "h", 3000.0),
            (5, 1, "a", "h", 4000.0), (6, 1, "a", "h", 4010.0)]
    _, stream = _replay(spark, rows, SUBMITS, 2, (99, -1, "end", None, 10.0 ** 5))
    got = ET.run_in_order(ET.duplicate_submits_in_order(stream, "user_id", "ts", "m", "h", "event_id", "1 minute", idle_s=1000), "t-idle")
    assert {r.event_id: r.is_duplicate for r in got.collect()} == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True}
    checkpoint = os.path.join(os.path.dirname(got.inputFiles()[0].replace("file://", "")), "..", "checkpoint")
    store = spark.read.format("statestore").option("path", os.path.abspath(checkpoint))
    for name in ("carry", "last"):
        assert store.option("stateVarName", name).load().count() == 0
    held = store.option("stateVarName", "held").load()
    assert [r.key.user_id for r in held.select("key").distinct().collect()] == [-1]
