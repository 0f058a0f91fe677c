"""Model batches (M1-M4): embedding and generation through user callables, batch plans and
the retry/backoff schedule.

The reference calls hosted models one batch at a time from a single process.  Here a
model is a plain Python callable run inside ``mapInPandas`` tasks, so batches of many
partitions run in parallel; a deterministic default (hashed bag of words, computed with
built-in column functions) keeps every result reproducible without a model.
"""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params

_RATE_LIMITED = re.compile(r"\b429\b|\brate[ _-]?limit|\btoo many requests\b|\b(requests|tokens|queries) per (second|minute|day)\b",
                           re.IGNORECASE)
_KNOWN_TOKENS = 500_000     # tokens whose bucket a task remembers
TOKEN_PATTERN = r"[^\p{L}\p{N}]+"


def global_index(df: DataFrame, order_col: str, n_parts: int | None = None) -> DataFrame:
    """Consecutive 0-based index in ``order_col`` order without a single-task window.

    Range-partition by the order column, number rows inside each partition, then add each
    partition's offset (a running sum over one row per partition)."""
    from quarry.session import ensure_checkpoint_dir
    n = n_parts or df.sparkSession.sparkContext.defaultParallelism
    ensure_checkpoint_dir(df.sparkSession)
    # range bounds come from a sample: checkpoint one assignment so that both branches below
    # (per-partition counts and the rows) see the same partition ids
    d = df.repartitionByRange(n, order_col).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    d = d.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(order_col)) - 1)
    counts = d.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return d.join(F.broadcast(offs.select("_pid", "_off")), "_pid").withColumn(
        "idx", (F.col("_off") + F.col("_local")).cast("bigint")).drop("_pid", "_local", "_off")


def batch_plan(df: DataFrame, order_col: str = "doc_id", content_col: str = "content",
               batch_size: int = params.EMBED_BATCH_SIZE, rpm: int = params.EMBED_RPM,
               tpm: int = params.EMBED_TPM, min_sleep: float = params.EMBED_MIN_SLEEP_S) -> DataFrame:
    """M2: batch number, docs, chars and wait = max(min sleep, 60/RPM, chars/TPM*60) per batch."""
    g = global_index(df.select(order_col, content_col), order_col)
    b = g.withColumn("batch", F.floor(F.col("idx") / batch_size).cast("bigint"))
    chars = F.sum(F.length(content_col))
    return b.groupBy("batch").agg(
        F.count("*").cast("bigint").alias("n_docs"), chars.cast("bigint").alias("n_chars"),
        F.greatest(F.lit(float(min_sleep)), F.lit(60.0 / rpm), chars / float(tpm) * 60.0).alias("wait_s"))


def backoff_schedule(max_retries: int = params.EMBED_MAX_RETRIES, base: float = params.EMBED_BACKOFF_S,
                     cap: float = params.EMBED_BACKOFF_MAX_S) -> list[float]:
    """M3: wait before retry r (1-based) = min(base * 2^(r-1), cap)."""
    return [min(base * 2 ** (r - 1), cap) for r in range(1, max_retries + 1)]


def is_rate_limited(err: BaseException) -> bool:
    return bool(_RATE_LIMITED.search(str(err)))


def hashed_embedding(text, dim: int = 64, token_pattern: str = TOKEN_PATTERN) -> F.Column:
    """M1 default: L2-normalised bag of lower-cased tokens hashed into ``dim`` buckets
    (bucket = first 8 hex digits of md5(token) mod dim).  Built-in functions only."""
    toks = F.filter(F.split(F.lower(text if not isinstance(text, str) else F.col(text)), token_pattern),
                    lambda t: F.length(t) > 0)
    buckets = F.transform(toks, lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % dim)
                          .cast("int"))
    counts = F.aggregate(buckets, F.array_repeat(F.lit(0.0), dim),
                         lambda acc, b: F.transform(acc, lambda x, i: F.when(i == b, x + 1.0).otherwise(x)))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(counts, lambda x: x / norm)).otherwise(counts)


def hashed_embeddings(df: DataFrame, id_col: str, text_col: str, dim: int = 64,
                      token_pattern: str = TOKEN_PATTERN) -> DataFrame:
    """M1 default for a table of texts: (id, n_tokens, embedding).

    Texts are lowered in the JVM and counted in Arrow batches, one text at a time: no shuffle, and rows with equal ids stay
    rows of their own.  Same values as ``hashed_embedding`` (the per-row column form, for short texts)."""
    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("embedding", T.ArrayType(T.DoubleType()))])

    def run(batches):
        split, known = regex.compile(token_pattern).split, {}
        for pdf in batches:
            sizes, vectors = [], []
            for text in pdf["_text"]:
                tokens = [t for t in split(text or "") if t]
                for t in set(tokens).difference(known):
                    if len(known) >= _KNOWN_TOKENS:
                        known.clear()
                        known.update((u, _bucket(u, dim)) for u in tokens)
                    known[t] = _bucket(t, dim)
                counts = np.bincount([known[t] for t in tokens], minlength=dim).astype(float) if tokens else np.zeros(dim)
                norm = np.sqrt(float((counts * counts).sum()))
                sizes.append(len(tokens))
                vectors.append(counts / norm if norm else counts)
            yield pd.DataFrame({id_col: pdf[id_col], "n_tokens": sizes, "embedding": vectors})

    return df.select(id_col, F.lower(F.col(text_col)).alias("_text")).mapInPandas(run, schema)


def _bucket(token: str, dim: int) -> int:
    return int(hashlib.md5(token.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % dim


def embed(df: DataFrame, text_col: str, embed_fn=None, out_col: str = "embedding", dim: int = 64,
          batch_size: int = params.EMBED_BATCH_SIZE, max_retries: int = params.EMBED_MAX_RETRIES) -> DataFrame:
    """M1/M3: add an embedding column.

    ``embed_fn(list[str]) -> list[list[float]]`` runs in ``mapInPandas`` tasks in batches of
    ``batch_size``; rate-limit errors are retried with the M3 backoff, other failures put
    the error text in ``embed_error`` (rows are never dropped).  Without ``embed_fn`` the
    hashed default is computed in the JVM."""
    if embed_fn is None:
        return df.withColumn(out_col, hashed_embedding(F.col(text_col), dim))
    waits = backoff_schedule(max_retries)
    schema = T.StructType(df.schema.fields + [
        T.StructField(out_col, T.ArrayType(T.DoubleType())), T.StructField("embed_error", T.StringType())])

    def run(batches):
        for pdf in batches:
            vecs, errs = [None] * len(pdf), [None] * len(pdf)
            texts = pdf[text_col].fillna("").tolist()
            for s in range(0, len(texts), batch_size):
                chunk = texts[s:s + batch_size]
                for attempt in range(max_retries + 1):
                    try:
                        out = embed_fn(chunk)
                        if len(out) != len(chunk):
                            raise ValueError(f"{len(out)} vectors for {len(chunk)} texts")
                        for j, v in enumerate(out):
                            vecs[s + j] = [float(x) for x in v]
                        break
                    except Exception as e:  # noqa: BLE001 - model errors are data here
                        if is_rate_limited(e) and attempt < max_retries:
                            time.sleep(waits[attempt])
                            continue
                        for j in range(len(chunk)):
                            errs[s + j] = f"{type(e).__name__}: {e}"
                        break
            yield pdf.assign(**{out_col: vecs, "embed_error": errs})

    return df.mapInPandas(run, schema)


def generate(prompts: DataFrame, prompt_col: str, generate_fn=None, out_col: str = "answer",
             default_col: str | None = None) -> DataFrame:
    """M4: batch text generation.  ``generate_fn(list[str]) -> list[str]`` runs in
    ``mapInPandas`` tasks; without it the extractive default copies ``default_col``."""
    if generate_fn is None:
        return prompts.withColumn(out_col, F.col(default_col) if default_col else F.lit(""))
    schema = T.StructType(prompts.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(batches):
        for pdf in batches:
            out = generate_fn(pdf[prompt_col].fillna("").tolist()) if len(pdf) else []
            yield pdf.assign(**{out_col: list(out)})

    return prompts.mapInPandas(run, schema)
