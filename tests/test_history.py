"""Conversations in chunks equal the plain forms; a conversation of 100,000 turns is spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import answer as A
from quarry.operators import history as Y

SCHEMA = "conv_id long, turn long, role string, text string"


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def messages(spark):
    r = random.Random(5)
    rows = [(0 if i % 3 else 1 + i % 5, i, r.choice(["user", "user", "assistant", "ai", "system" if i < 500 else "tool"]),
             r.choice(["", None, f"t{i}", "long " * 90])) for i in range(900)]
    rows += [(70, 1, "assistant", "x"), (71, 1, "user", "alone"), (None, 1, "user", "n"), (None, 2, "bot", "m"), (72, 1, None, "no role")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("n_parts", [1, 7, 30])
def test_pairs_and_resets_equal_the_plain_forms(messages, n_parts):
    want = _rows(A.message_pairs(messages))
    assert len(want) > 150 and _rows(Y.message_pairs_split(messages, n_parts=n_parts)) == want
    assert _rows(Y.history_after_reset_split(messages, n_parts=n_parts)) == _rows(A.history_after_reset(messages))


@pytest.mark.parametrize("block", [15, 40, 1024])
def test_history_in_blocks_equals_the_plain_form(messages, block):
    pairs = A.message_pairs(messages).withColumn("conv_id_", F.lit("extra"))
    assert _rows(Y.history_window_split(pairs, block=block)) == _rows(A.history_window(pairs))
    with pytest.raises(ValueError):
        Y.history_window_split(pairs, block=14)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    pairs = Y.message_pairs_split(none)
    assert pairs.count() == Y.history_window_split(pairs).count() == Y.history_after_reset_split(none).count() == 0


def test_a_hot_conversation_is_spread_over_tasks(spark):
    turns = spark.range(100_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 30_000, "system").when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    pairs = Y.message_pairs_split(turns, n_parts=8)
    history = Y.history_window_split(pairs)
    plain = A.history_window(A.message_pairs(turns))
    assert history.count() == plain.count() == 49_999 and history.exceptAll(plain).count() == 0
    # no task holds more than a part of the 49 blocks of the conversation
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        by_task = Y.history_window_split(pairs).groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("count"), F.max("history_text")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(by_task) == 4 and max(r["count"] for r in by_task) <= 25_000
    rest = Y.history_after_reset_split(turns, n_parts=8)
    assert rest.agg(F.min("turn"), F.count("*")).first() == (30_001, 69_999)
