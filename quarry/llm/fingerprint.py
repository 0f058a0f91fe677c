"""Document fingerprints: bottom-k sketches of shingle hashes (operator 2).

The sketch of a text is the k smallest of its distinct 63-bit hashes of five-word shingles, ascending.  The sketch of
a union is the k smallest of both sketches, so sketches of the parts of a text collection merge in any order.  Two
sketches estimate resemblance (share of the union's k smallest that both have), containment and distinct counts.

Null and empty texts have an empty sketch; two empty sketches resemble each other by 1, an empty and another one by 0.
Equal texts have equal sketches.  Repeated rows give repeated sketches; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import SHINGLE_WORDS, Shingler

K = 256
_RANGE = float(1 << 63)


class Sketcher:
    """Sketches of texts, and estimates from two sketches, inside a task."""

    def __init__(self, k: int = K, width: int = SHINGLE_WORDS):
        self.k, self.shingler = k, Shingler(width)

    def __call__(self, text: str | None) -> np.ndarray:
        return (self.shingler.shingles(text)[:self.k] >> np.uint64(1)).astype(np.int64)

    def resemblance(self, a: np.ndarray, b: np.ndarray) -> float:
        if not len(a) or not len(b):
            return float(len(a) == len(b))
        low = np.union1d(a, b)[:self.k]
        return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), low, assume_unique=True)) / len(low)


def as_string(sketch: np.ndarray) -> str:
    """The sketch's hashes, big-endian, in base 64."""
    return base64.b64encode(sketch.astype(">i8").tobytes()).decode()


def fingerprint(df: DataFrame, text_col: str = "text", keep=None, k: int = K, width: int = SHINGLE_WORDS) -> DataFrame:
    """Adds ``sketch``, an array of at most k longs, to the columns of ``keep`` (all if None), replacing a clashing one."""
    keep = [c for c in (df.columns if keep is None else keep) if c != "sketch"]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("sketch", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(k, width)
        for batch in batches:
            made = pa.array([sketcher(v.as_py()) for v in batch.column(len(keep))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], made], names=[f.name for f in schema])

    return df.select(*[df[c] for c in keep], df[text_col].alias("_sketched")).mapInArrow(run, schema)


def merge(df: DataFrame, by, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group: the k smallest of all its sketches' hashes.

    Distinct hashes are found before, and the k smallest of every task are picked before rows of a group meet.
    """
    by = [by] if isinstance(by, str) else list(by)
    one = df.select(*by, F.explode_outer(sketch).alias("_h")).distinct()
    low = one.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("_h").asc_nulls_last()))).filter(F.col("_r") <= k)
    return low.groupBy(*by).agg(F.array_sort(F.collect_list("_h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    low = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), low))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(both / F.size(low))


def distinct_count(a: Column, k: int = K) -> Column:
    """Exact below k shingles; else (k - 1) / (largest hash as a fraction)."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit((k - 1) * _RANGE) / F.array_max(a))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    j, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


# --- neighbours in the order of a key ----------------------------------------------------------------------------------
def next_in_order(df: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Rows (_part, _guest, key, text) dealt to ranges of descending ``key`` (nulls last, ties by the text's hash).

    Sorted inside each partition.  A range ends with a guest: a copy of the row that follows it in the whole order (after the
    last: the first), so whoever reads a range in order sees every own row's successor.  Texts are shuffled once; the driver
    gets one row for each range.  Rows with one and the same key share a range, but null keys are spread by hash.
    """
    cuts = df.select(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10_000).alias("c")).first()["c"] if parts > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    null_part = len(cuts) + 1 + F.floor((h / 2.0 ** 64 + 0.5) * parts)
    if cuts:
        heads = F.array(*[F.lit(g[0]) for g in groups])
        tails = F.array(*[F.array(*map(F.lit, g)) for g in groups])
        at = F.greatest(F.size(F.filter(heads, lambda c: c > F.col(key))), F.lit(1))     # the last group with a cut above the key
        inside = F.size(F.filter(F.element_at(tails, at), lambda c: c > F.col(key)))
        part = F.when(F.col(key).isNull(), null_part).otherwise((at - 1) * step + inside)
    else:
        part = F.when(F.col(key).isNull(), null_part).otherwise(0)
    rows = df.select(F.col(key), F.col(text), h.alias("_h"), part.cast("long").alias("_part"))
    ends = (rows.groupBy("_part").agg(F.min(F.struct(F.bitwise_not(key).alias("k"), "_h")).alias("first"))
            .select("_part", "first.k", "first._h").orderBy("_part").collect())
    if not ends:
        return rows.select("_part", F.lit(False).alias("_guest"), key, text)
    order = [e["_part"] for e in ends]
    before = F.create_map(*[F.lit(x) for p, q in zip(order, [order[-1], *order]) for x in (p, q)])
    first_k = F.create_map(*[F.lit(x) for e in ends for x in (e["_part"], e["k"])])
    first_h = F.create_map(*[F.lit(x) for e in ends for x in (e["_part"], e["_h"])])
    own = F.struct(F.col("_part"), F.lit(False).alias("_guest"))
    first = F.bitwise_not(key).eqNullSafe(first_k[F.col("_part")]) & (F.col("_h") == first_h[F.col("_part")])
    dealt = F.when(first, F.array(own, F.struct(before[F.col("_part")].alias("_part"), F.lit(True).alias("_guest")))).otherwise(F.array(own))
    return (rows.select(F.explode(dealt).alias("_to"), key, text, "_h").select("_to.*", key, text, "_h")
            .repartition("_part").sortWithinPartitions("_part", "_guest", F.col(key).desc_nulls_last(), "_h", text)
            .select("_part", "_guest", key, text))


def pairs_in_order(batches: Iterator[pa.RecordBatch], key: str, text: str):
    """((key, text), (key, text) that follows) of every own row in what ``next_in_order`` deals."""
    part = last = None
    for batch in batches:
        for p, guest, k, t in zip(*(batch.column(c) for c in ("_part", "_guest", key, text))):
            p, row = p.as_py(), (k.as_py(), t.as_py() or "")
            if p == part and last is not None:
                yield last, row
            part, last = p, None if guest.as_py() else row
