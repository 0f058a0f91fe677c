"""The answer pipeline on a stream of questions, and stream-run helpers.

Each micro-batch of questions runs the batch answer pipeline against a static index;
results are written per batch id with overwrite, so a replayed batch (after a failure)
replaces its own output — exactly-once at the sink.  Checkpoints live under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.pipeline import answer_pipeline
from quarry.session import scratch_path
from quarry.streaming.session_history import Turns


def file_stream(spark: SparkSession, directory: str, schema, glob: str = "*.parquet",
                max_files_per_trigger: int = 1) -> DataFrame:
    """A Parquet file stream over the files of ``directory`` matching ``glob`` (source rate
    limited by files per trigger, cf. W5)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .option("pathGlobFilter", glob).parquet(directory))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stream of the table ``name`` of ``sf_dir``, be it one Parquet file or a folder of files.  All its files come in one
    micro-batch: in a folder the files' times say nothing of the order of their rows.  The path is a glob since the source
    takes a plain one for a folder."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")


def run_available(stream: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming query over everything available, into a Parquet table in the shared
    scratch folder, and return that table."""
    spark = stream.sparkSession
    run = f"{name}-{uuid.uuid4().hex}"
    sink, ckpt = scratch_path(spark, f"{run}/data"), scratch_path(spark, f"{run}/checkpoint")
    q = (stream.writeStream.format("parquet").outputMode(output_mode).option("path", sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


def answer_batch(batch: DataFrame, batch_id: int, corpus: DataFrame, judge: DataFrame | None, sink: str, turns: Turns | None = None,
                 session: str | None = None, order: str = "qid", **pipeline_kw) -> None:
    """One micro-batch of the answer stream; running it again replaces what it wrote, and reads the same history."""
    path = f"{sink}/batch_id={batch_id}"
    if session is None:
        answer_pipeline(batch, corpus, judge, stream_policy=True, **pipeline_kw).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(path)
        return
    asked = batch.select("qid", F.col(session).cast("string").alias("session"), F.col(order).cast("bigint").alias("ord"), "question")
    answer_pipeline(batch, corpus, judge, stream_policy=True, sessions=asked, past=turns.before(batch_id), **pipeline_kw) \
        .withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(path)
    said = batch.sparkSession.read.parquet(path).select("qid", F.col("said").alias("answer"))
    turns.write(batch_id, asked.join(said, "qid"))


def answer_stream(questions: DataFrame, corpus: DataFrame, judge: DataFrame | None, name: str = "answers",
                  session: str | None = None, order: str = "qid", **pipeline_kw) -> DataFrame:
    """Answer every arriving question; returns the sink table (with ``batch_id``).

    With ``session``, a column of the questions, a prompt holds the session's earlier turns: those of earlier micro-batches and, by
    ``order``, of its own (W3); the table then has said, what later prompts hold of an answer."""
    spark = questions.sparkSession
    run = f"{name}-{uuid.uuid4().hex}"
    sink, ckpt = scratch_path(spark, f"{run}/data"), scratch_path(spark, f"{run}/checkpoint")

    turns = Turns(spark, scratch_path(spark, f"{run}/history")) if session else None

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        cached: list = []
        try:
            answer_batch(batch, batch_id, corpus, judge, sink, turns, session, order, cached=cached, **pipeline_kw)
        finally:
            for table in cached:
                table.unpersist()

    q = (questions.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
