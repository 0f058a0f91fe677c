"""W1 and W3 by event time: a session's rows are held until the watermark has passed them and then taken in order.

Rows may come in any order within the watermark's delay, over any micro-batches: the output is that of the batch forms.  Held rows,
the session's carry and its last event time are state of ``transformWithState``; a timer at the earliest held row releases rows,
one at the last event plus the idle limit removes the session.  A pause longer than the limit starts the session afresh, which
depends on event times only, never on when a timer ran.

Rows that come later than the delay are dropped by the watermark, as are rows of 1970-01-01 00:00 and before (a stream's first
watermark) and rows without an event time or order.  Rows within the
delay of the stream's latest event stay held until a later event (of any session) moves the watermark on.  State is held in RocksDB,
which ``transformWithState`` asks for; ``run_in_order`` sets it for its query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quarry import params
from quarry.streaming.answers import run_available
from quarry.streaming.operators import NO_PAIRS, NO_SUBMIT, PAIRS_STATE, epoch_seconds, guard, pair_up

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IDLE_S = 30 * 86400.0


class InOrder(StatefulProcessor):
    """Steps through a session's rows by (event time, order) once the watermark has passed them.

    ``step(carry, *values) -> (carry, output values or None)``; input rows hold the key, then
    (event time in microseconds, order, *values), read by place: Spark renames computed columns on their way here."""

    def __init__(self, width: int, row_schema: str, carry_schema: str, start: tuple, step: Callable, out_columns: list[str],
                 idle_us: int):
        self.width, self.row_schema, self.carry_schema = width, row_schema, carry_schema
        self.start, self.step, self.out_columns, self.idle_us = start, step, out_columns, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.row_schema)
        self.carry = handle.getValueState("carry", self.carry_schema)
        self.last = handle.getValueState("last", "us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            if len(pdf):
                new = [tuple(None if v is None or v != v else v for v in r) for r in zip(*[pdf.iloc[:, i].tolist() for i in range(1, self.width + 1)])]
                self.held.appendList(new)
                earliest = min(r[0] for r in new)
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            self.handle.registerTimer(_ceil_ms(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((tuple(r) for r in self.held.get()), key=lambda r: r[:2])
        due = [r for r in held if r[0] <= passed]
        later = held[len(due):]
        known = self.last.get()         # each call to the state is a round trip; a session has both values or none
        last, carry = (known[0], tuple(self.carry.get())) if known is not None else (None, self.start)
        before = carry
        out = []
        for us, order, *values in due:
            if last is not None and us - last > self.idle_us:
                carry = self.start
            last = us
            carry, result = self.step(carry, *values)
            if result is not None:
                out.append((key[0], order, *result))
        if due and later:
            self.held.put(later)
            self.handle.registerTimer(_ceil_ms(later[0][0]))
        elif due:
            self.held.clear()
        if last is not None and last + self.idle_us <= passed:      # whatever comes now comes after the pause
            if known is not None:
                self.last.clear()
                self.carry.clear()
        elif due:
            self.last.update((last,))
            if known is None or carry != before:
                self.carry.update(carry)
            self.handle.registerTimer(_ceil_ms(last + self.idle_us))
        if out:
            yield pd.DataFrame(out, columns=self.out_columns)

    def close(self) -> None:
        pass


def _ceil_ms(us: int) -> int:
    return -(-us // 1000)


def _in_order(stream: DataFrame, key: str, ts: str, order: str, values: list[str], carry_schema: str, start: tuple, step: Callable,
              outputs: list[T.StructField], delay: str, idle_s: float) -> DataFrame:
    rows = stream.withColumn("_us", F.round(epoch_seconds(stream, ts) * 1e6).cast("bigint"))
    rows = (rows.where(F.col("_us").isNotNull() & F.col(order).isNotNull())
            .select(key, "_us", order, *values, F.timestamp_micros("_us").alias("_ets")).withWatermark("_ets", delay))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    row_schema = ", ".join(f"`{c}` {types[c]}" for c in ["_us", order, *values])
    out = T.StructType([rows.schema[key], T.StructField(order, rows.schema[order].dataType), *outputs])
    processor = InOrder(2 + len(values), row_schema, carry_schema, start, step, out.names, int(idle_s * 1e6))
    return rows.groupBy(key).transformWithStateInPandas(processor, out, "append", "eventtime")


def _guard_step(carry, message, history):
    carry, dup = guard(carry, message, history)
    return carry, (dup,)


def duplicate_submits_in_order(stream: DataFrame, key: str, ts: str, message: str, history: str, id_col: str,
                               delay: str = "10 minutes", idle_s: float = IDLE_S) -> DataFrame:
    """W1 by event time: (key, id, is_duplicate), equal to ``duplicate_submits`` ordered by (ts, id), whatever the order
    within ``delay`` in which rows come.  A pause of more than ``idle_s`` forgets the last submit."""
    return _in_order(stream, key, ts, id_col, [message, history], "message string, history string", NO_SUBMIT, _guard_step,
                     [T.StructField("is_duplicate", T.BooleanType())], delay, idle_s)


def history_in_order(messages: DataFrame, key: str, ts: str, order: str = "turn", delay: str = "10 minutes",
                     idle_s: float = IDLE_S, max_turns: int = params.MAX_HISTORY_TURNS,
                     text_turns: int = params.HISTORY_TEXT_TURNS) -> DataFrame:
    """W3 by event time: (key, order, pair_no, n_history, history_text), equal to ``history_window`` of ``message_pairs``
    ordered by (ts, order).  A pause of more than ``idle_s`` starts a session afresh, with pair 1 and no history."""

    def step(carry, role, text):
        return pair_up(carry, role, text, max_turns, text_turns)

    return _in_order(messages, key, ts, order, ["role", "text"], PAIRS_STATE, NO_PAIRS, step,
                     [T.StructField("pair_no", T.LongType()), T.StructField("n_history", T.LongType()),
                      T.StructField("history_text", T.StringType())], delay, idle_s)


def run_in_order(stream: DataFrame, name: str) -> DataFrame:
    """``run_available`` with the state store that ``transformWithState`` needs; the session's own setting is put back."""
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        return run_available(stream, name)
    finally:
        conf.set(STATE_STORE, before)
