"""Helpers shared by the operators of this folder: stage tables in the shared folder, word shingles, grouped streams."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

WORD = r"[^\x20\x09-\x0D]+"     # a word: no space, tab, line feed, vertical tab, form feed, carriage return
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def tables(spark: SparkSession, sf_dir: str, *names: str):
    """The named tables of ``sf_dir``; one name gives one DataFrame."""
    out = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return out[0] if len(out) == 1 else out


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Only a local master may leave it unset (tests): then a folder is made."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quarry-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


class Stage:
    """Intermediate tables written to the shared folder.  They cut lineage and survive the loss of executors.

    ``keep`` writes a DataFrame and reads it back; ``drop`` removes tables that nothing reads any more.
    What is still there when the returned DataFrame is used stays, like checkpoint files do.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm.org.apache.hadoop.fs
        for name in names:
            path = jvm.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# --- 64-bit hashes of words and shingles -----------------------------------------------------------------------------
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLOCK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base, n):
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Shingler:
    """Hashes of the word shingles of texts: whole texts, in bounded blocks cut at white space.

    A word's hash is a polynomial of its UTF-8 bytes modulo 2^64, mixed; a shingle's hash is a mixed linear form of
    its words' hashes.  A text of fewer words than a shingle has one shingle of all its words; without words, none.
    """

    def __init__(self, width: int = SHINGLE_WORDS):
        self.width = width
        self.coef = _powers(np.uint64(0xD6E8FEB86659FD93), width + 1)[1:]
        self.pow, self.inv = _powers(_BASE, 4096), _powers(_INV, 4096)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def _words(self, b: np.ndarray) -> np.ndarray:
        n = len(b)
        if n + 1 > len(self.pow):
            size = 1 << int(n + 1).bit_length()
            self.pow, self.inv = _powers(_BASE, size), _powers(_INV, size)
        space = self.space[b]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        start, end = edge[0::2], edge[1::2]
        if not len(start):
            return np.empty(0, np.uint64)
        c = np.empty(n + 1, np.uint64)
        c[0] = 0
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.pow[:n], out=c[1:])
        return mix64((c[end] - c[start]) * self.inv[start] + (end - start).astype(np.uint64))

    def words(self, text: str | None) -> np.ndarray:
        """One hash per word, in order."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if len(data) <= _BLOCK:
            return self._words(np.frombuffer(data, np.uint8))
        b = np.frombuffer(data, np.uint8)
        parts, at = [], 0
        while at < len(b):
            to = min(len(b), at + _BLOCK)
            while to < len(b):      # a block ends before white space; a longer word stays whole
                gap = np.flatnonzero(self.space[b[to:to + _BLOCK]])
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(len(b), to + _BLOCK)
            parts.append(self._words(b[at:to]))
            at = to
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """The distinct shingle hashes of a text, ascending."""
        w = self.words(text)
        if not len(w):
            return w
        k = min(self.width, len(w))
        m = len(w) - k + 1
        acc = np.full(m, k, np.uint64)
        for j in range(k):
            acc += w[j:j + m] * self.coef[j]
        return np.unique(mix64(acc))


def groups(batches, keys: int):
    """(key, rows) of consecutive rows with equal first ``keys`` columns; rows as tuples, nothing but one group is held."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield key, rows
