"""Conversation history of an answer stream: generation in session order, and the turns kept between micro-batches (W3 in W4).

A turn is (session, question, answer).  Batch N writes its turns to ``turns/batch_id=N`` and reads only those of earlier batches, so
a replayed batch reads what it read before and replaces what it wrote.  Every ``SNAPSHOT_EVERY`` batches the last turns of each
session are written as one table; a batch reads the last such table and the turns since.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params
from quarry.operators import answer as A
from quarry.streaming.operators import render_history

SNAPSHOT_EVERY = 8
TURNS = "session string, batch_id bigint, ord bigint, qid bigint, question string, answer string"


def generate_in_sessions(turns: DataFrame, past: DataFrame, generate_fn: Callable, template: str = A.PROMPT_TEMPLATE,
                         max_turns: int = params.MAX_HISTORY_TURNS, text_turns: int = params.HISTORY_TEXT_TURNS) -> DataFrame:
    """(qid, prompt, answer): questions of a session answered in order, each prompt with the answers before it.

    ``turns``: qid, session, ord, question, context, answer (text of a refusal, null where the model is asked).  ``past``: session,
    batch_id, ord, qid, question, answer of earlier turns.  A question without a session has no history.  Rows are partitioned by
    session; in an Arrow batch the next questions of all its sessions go to the model in one call, in another one the session goes
    on where it stopped.  Memory holds one Arrow batch and ``max_turns`` turns a session of it."""
    asked = turns.select("session", F.lit(None).cast("bigint").alias("batch_id"), "ord", "qid", "question", "context", "answer", F.lit(True).alias("new"))
    old = past.join(asked.select("session").distinct(), "session", "left_semi").select(
        "session", "batch_id", "ord", "qid", "question", F.lit("").alias("context"), F.coalesce("answer", F.lit("")).alias("answer"), F.lit(False).alias("new"))
    rows = asked.unionByName(old).withColumn("key", F.coalesce(F.concat(F.lit("s"), "session"), F.concat(F.lit("q"), F.col("qid").cast("string"))))
    rows = rows.repartition("key").sortWithinPartitions("key", "new", "batch_id", "ord", "qid")
    out = T.StructType([turns.schema["qid"], T.StructField("prompt", T.StringType()), T.StructField("answer", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict = {}     # of the session that may go on in the next Arrow batch: (questions, answers)
        for pdf in batches:
            if not len(pdf):
                continue
            keys, questions, contexts = pdf["key"].tolist(), pdf["question"].tolist(), pdf["context"].tolist()
            answers, prompts, new = [a if isinstance(a, str) else None for a in pdf["answer"]], [None] * len(pdf), pdf["new"].tolist()
            waiting: dict = {}
            for i, k in enumerate(keys):
                waiting.setdefault(k, []).append(i)
            said = {k: last.get(k, ([], [])) for k in waiting}

            def tell(k, i):
                q, a = said[k]
                said[k] = ((q + [questions[i] or ""])[-max_turns:], (a + [answers[i]])[-max_turns:])

            open_ = {k: iter(rows) for k, rows in waiting.items()}
            while open_:
                wave = []
                for k in list(open_):
                    for i in open_[k]:
                        if answers[i] is None:
                            wave.append((k, i))
                            break
                        tell(k, i)
                    else:
                        del open_[k]
                for k, i in wave:
                    past_text = render_history(*said[k], text_turns)
                    parts = {"{context}": contexts[i] or "", "{question}": questions[i] or "", "{history}": past_text}
                    prompts[i] = _fill(template, parts)
                for (k, i), text in zip(wave, generate_fn([prompts[i] for _, i in wave]) if wave else [], strict=True):
                    answers[i] = text or ""
                    tell(k, i)
            last = {keys[-1]: said[keys[-1]]}
            yield pd.DataFrame({"qid": pdf["qid"], "prompt": prompts, "answer": answers})[[bool(x) for x in new]]

    return rows.mapInPandas(run, out)


def _fill(template: str, parts: dict) -> str:
    """The template with its placeholders filled at once, so that a text holding a placeholder stays as it is."""
    return re.sub("|".join(map(re.escape, parts)), lambda m: parts[m.group()], template)


class Turns:
    """The turns of a stream under ``path``, as of any batch."""

    def __init__(self, spark: SparkSession, path: str, keep: int = params.MAX_HISTORY_TURNS, every: int = SNAPSHOT_EVERY):
        self.spark, self.path, self.keep, self.every = spark, path, keep, every

    def before(self, batch_id: int) -> DataFrame:
        """At least the last ``keep`` turns of every session, of batches before ``batch_id``."""
        upto = batch_id // self.every * self.every      # batches below it are in the snapshot
        paths = [f"{self.path}/upto={upto}"] if upto else []
        paths += [f"{self.path}/turns/batch={b}" for b in range(upto, batch_id)]
        if not paths:
            return self.spark.createDataFrame([], TURNS)
        return self.spark.read.schema(TURNS).parquet(*paths)

    def write(self, batch_id: int, turns: DataFrame) -> None:
        """The turns of a batch; after every ``every`` batches the last ``keep`` turns of each session, too."""
        turns.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*[f.split()[0] for f in TURNS.split(", ")]) \
            .write.mode("overwrite").parquet(f"{self.path}/turns/batch={batch_id}")
        if (batch_id + 1) % self.every == 0:
            start = batch_id + 1 - self.every
            paths = ([f"{self.path}/upto={start}"] if start else []) + [f"{self.path}/turns/batch={b}" for b in range(start, batch_id + 1)]
            latest = Window.partitionBy("session").orderBy(F.desc("batch_id"), F.desc("ord"), F.desc("qid"))
            (self.spark.read.schema(TURNS).parquet(*paths).where("session IS NOT NULL").withColumn("_rank", F.row_number().over(latest))
             .where(F.col("_rank") <= self.keep).drop("_rank").write.mode("overwrite").parquet(f"{self.path}/upto={batch_id + 1}"))
