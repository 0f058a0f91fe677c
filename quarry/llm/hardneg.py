"""Hard-negative mining with length buckets and coordinate pruning (operator 11).

Rows are dealt to parts, anchors to chunks, and a task holds one part and one chunk.  The part's rows are sorted by length
and cut into buckets of like length, small enough for a processor's cache.  A bucket has, for every coordinate, the list of
its unit vectors' values in ascending order.  An anchor visits the buckets from the longest rows down and stops where length
alone rules out the score it needs.  In a bucket that score is an angle; for each of the anchor's focus coordinates, the
largest ones, the angle leaves a range of feasible values, which is a run of the sorted list.  The runs are intersected, and
what is left is scored exactly.  The score needed rises while better rows are found.

First every anchor's positives are searched among the rows of its label, then, for all its positives at once, the rows of
other labels whose score lies between ``low`` and ``high`` percent of the positive's.  Nothing is approximate: pruning only
drops rows that can't be in the result.

Components are whole numbers, floor(scale * x) of the doubles x; scores are exact integers.  Rows without id, label or vector,
and rows with a null or non-finite component take no part, nor do vectors so long that a score could pass 2^62.  Zero and empty
vectors take part; their scores are 0.  Vectors of different lengths never meet.  Repeated rows count once; rows that share an
id but differ are rows of their own, but none is its own id's positive or negative.  Copies of a vector with one label are one
node with their smallest ids, as many as a result can need.  Equal scores rank by id.  A positive below 0 has no negatives.
Empty tables and anchors without positives give no rows.  Columns other than id, label and vector are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stage

PART_ROWS, LEAST_ROWS = 65_536, 2_048   # rows of a part; smaller parts, of the second at least, give all cores some
CHUNK_ANCHORS = 16_384
BUCKET_ROWS = 4_096
LENGTH_RATIO = 0.9                      # shortest over longest of a bucket
FOCUS = 5
SALTS = 16
MAX_SQUARE = float(1 << 62)
_SLACK = 1e-6                           # far above the rounding of angles
_NONE = np.iinfo(np.int64).max


def prepare(df: DataFrame, id_col: str, label_col: str | Column, vector_col: str, scale: float = 1.0) -> DataFrame:
    """(id, label, vec): the rows that take part, once each; vec holds floor(scale * x) as longs."""
    x = df[vector_col].cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    label = (df[label_col] if isinstance(label_col, str) else label_col).cast("string")
    rows = df.select(df[id_col].cast("long").alias("id"), label.alias("label"), x.alias("x"), finite.alias("ok"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.col("ok"))
    scaled = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))))
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + F.pow(F.abs(v * F.lit(float(scale))) + 1, F.lit(2.0)))
    return rows.filter(square < MAX_SQUARE).select("id", "label", scaled.alias("vec")).distinct()


class Bucket:
    """Rows of like length: unit vectors' values per coordinate in ascending order, and each row's place in every list."""

    def __init__(self, rows: np.ndarray, norms: np.ndarray, at: np.ndarray):
        self.rows, self.at, self.top = rows, at, float(norms[0])
        unit = (rows / np.where(norms > 0, norms, 1.0)[:, None]).T
        self.order = np.argsort(unit, axis=1, kind="stable")
        self.values = np.take_along_axis(unit, self.order, 1)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(rows))[None, :], 1)

    def candidates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Rows that may have this cosine or more with a unit vector."""
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angle, own = np.arccos(min(1.0, cosine)), np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low, high = np.cos(np.minimum(np.pi, own + angle)) - _SLACK, np.cos(np.maximum(0.0, own - angle)) + _SLACK
        runs = []
        for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist()):
            first, last = self.values[f].searchsorted(a, "left"), self.values[f].searchsorted(b, "right")
            runs.append((last - first, f, first, last))
        runs.sort()
        _, f, first, last = runs[0]
        found = self.order[f, first:last]
        for _, f, first, last in runs[1:]:
            place = self.place[f, found]
            found = found[(place >= first) & (place < last)]
        return found


class Index:
    """One part's rows in buckets, the longest first."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, bucket_rows: int = BUCKET_ROWS):
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        by = np.argsort(-norms, kind="stable")
        self.ids, self.labels = ids[by], labels[by]
        vectors, norms = vectors[by], norms[by]
        self.exact = len(norms) == 0 or norms[0] < 2.0 ** 26        # then sums of products are whole in doubles
        if self.exact:
            vectors = vectors.astype(np.float64)
        self.buckets, start = [], 0
        while start < len(by):
            shorter = np.searchsorted(-norms, -LENGTH_RATIO * norms[start], "right") if norms[start] > 0 else len(by)
            end = min(start + bucket_rows, max(int(shorter), start + 1))
            self.buckets.append(Bucket(vectors[start:end], norms[start:end], np.arange(start, end)))
            start = end

    def search(self, own: int, vec: np.ndarray, windows: list[tuple[int | None, int | None]], k: int,
               not_label: str | None = None) -> list[list[tuple[int, int]]]:
        """For each (low, high) window of scores, both inclusive, the k best (score, id), best first."""
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        lows = [-_NONE if low is None else low for low, _ in windows]
        highs = [_NONE if high is None else high for _, high in windows]
        length = float(np.sqrt((vec.astype(np.float64) ** 2).sum()))
        fits = self.exact and length < 2.0 ** 26
        asked = vec.astype(np.float64) if fits else vec.astype(np.int64)
        unit = vec / length if length > 0 else None
        for bucket in self.buckets:
            need, reach = min(lows), length * bucket.top
            if need > reach * (1 + 1e-9):
                break
            if need > 0:
                found = bucket.candidates(unit, need / reach * (1 - 1e-9))
                rows = bucket.rows[found]
            else:
                found, rows = slice(None), bucket.rows
            score = (rows @ asked if fits else rows.astype(np.int64) @ asked).astype(np.int64)
            at = bucket.at[found]
            good = (score >= need) & (score <= max(highs))
            if not_label is not None:
                good &= self.labels[at] != not_label
            score, at = score[good], at[good]
            for i, (low, high) in enumerate(zip(lows, highs)):
                fit = (score >= low) & (score <= high)
                if fit.any():
                    best[i] = self._better(best[i], score[fit], at[fit], own, k)
                    if len(best[i]) == k:
                        lows[i] = max(low, best[i][-1][0])
        return best

    def _better(self, have: list, score: np.ndarray, at: np.ndarray, own: int, k: int) -> list:
        if len(score) > k + 1:
            first = np.where(self.ids[at, 0] == own, self.ids[at, 1], self.ids[at, 0])
            top = np.lexsort((first, -score))[:k + 1]
            score, at = score[top], at[top]
        more = [(-s, i) for s, a in zip(score.tolist(), at) for i in self.ids[a].tolist() if i != own and i != _NONE]
        return [(-s, i) for s, i in sorted([(-s, i) for s, i in have] + more)[:k]]


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """(label, vec, ids): distinct vectors of a label with the k + 1 smallest of their ids."""
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("label", "vec").orderBy("id"))).filter(F.col("r") <= k + 1)
    return first.groupBy("label", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(column), width)


def _search(nodes: DataFrame, queries: DataFrame, group: Column, k: int, low: int, high: int, stage: Stage, label: str) -> DataFrame:
    """(own, of, target, positive, positive_score, id, score): of each part the k best for every query and target.

    Queries that bring positives ask for other labels, the others for any row of their group.  Rows and queries meet under
    (group, part, chunk); a large group has many parts and chunks, and meets its row of the plan under salted keys.
    """
    nodes, queries = nodes.withColumn("g", group), queries.withColumn("g", group)
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    n = nodes.groupBy("g").agg(F.count("*").alias("n"))
    m = queries.groupBy("g").agg(F.count("*").alias("m"))
    parts = F.greatest(F.ceil(F.col("n") / PART_ROWS), F.least(F.lit(cores), F.floor(F.col("n") / LEAST_ROWS)))
    plan = n.join(m, "g").select("g", parts.cast("int").alias("parts"), F.ceil(F.col("m") / CHUNK_ANCHORS).cast("int").alias("chunks"))
    plan = stage.keep(plan, f"plan_{label}")
    total = plan.agg(F.sum(F.col("parts").cast("long") * F.col("chunks"))).first()[0] or 1
    tasks = int(min(total, max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // 16)))
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def salted(df: DataFrame, key: Column) -> DataFrame:
        return df.withColumn("salt", F.pmod(key, F.lit(SALTS)).cast("int")).join(plan, ["g", "salt"])

    row, asked = F.xxhash64("label", "vec"), F.xxhash64("own", "of")
    left = salted(nodes, row).select(
        "g", F.pmod(F.xxhash64(F.lit(1), "vec", "label"), F.col("parts").cast("long")).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).alias("chunk"), "label", "vec", "ids")
    right = salted(queries, asked).select(
        "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"),
        F.pmod(F.xxhash64(F.lit(2), "own", "of"), F.col("chunks").cast("long")).alias("chunk"), "own", "of", "label", "vec", "positives")
    names = ["own", "of", "target", "positive", "positive_score", "id", "score"]
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]

    def mine(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asks.num_rows:
            width = len(rows.column("vec")[0])
            ids = np.full((rows.num_rows, k + 2), _NONE, np.int64)
            for i, some in enumerate(rows.column("ids").to_pylist()):
                ids[i, :len(some)] = some
            index = Index(_matrix(rows.column("vec"), width), ids, np.array(rows.column("label").to_pylist(), object))
            vectors = _matrix(asks.column("vec"), width)
            for own, of, name, vec, positives in zip(*(asks.column(c).to_pylist() for c in ("own", "of", "label")), vectors,
                                                     asks.column("positives").to_pylist()):
                if positives is None:
                    targets, windows, other = [(0, None, None)], [(None, None)], None
                else:
                    windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
                    targets = [(i, p["id"], p["score"]) for i, (p, (a, b)) in enumerate(zip(positives, windows)) if a <= b]
                    windows, other = [w for w in windows if w[0] <= w[1]], name
                for target, got in zip(targets, index.search(own, vec, windows, k, other) if windows else []):
                    out.extend((own, of, *target, i, s) for s, i in got)
        columns = list(zip(*out)) or [()] * len(names)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    key = ["g", "part", "chunk"]
    found = left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)).applyInArrow(
        mine, "own long, of long, target int, positive long, positive_score long, id long, score long")
    best = Window.partitionBy("own", "of", "target").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for (id, label, vec) rows and anchors.

    An anchor's positives are its best ``positives`` rows of the same label; for each, the best ``negatives`` rows of other
    labels with ``low * positive_score <= 100 * score <= high * positive_score``.
    """
    stage = Stage(rows.sparkSession, "hardneg")
    k = max(positives, negatives)
    nodes = stage.keep(_nodes(rows, k), "nodes")
    kind = "array<struct<rank:int,id:long,score:long>>"
    asks = stage.keep(anchors.distinct().select(F.col("id").alias("own"), F.xxhash64("label", "vec").alias("of"), "label", "vec"), "anchors")
    size = F.size("vec").cast("string")
    near = _search(nodes, asks.withColumn("positives", F.lit(None).cast(kind)), F.concat_ws(" ", size, "label"), positives, low, high, stage,
                   "positives")
    listed = near.groupBy("own", "of").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    listed = stage.keep(asks.join(listed, ["own", "of"]).withColumn("positives", F.col("positives").cast(kind)), "listed")
    far = _search(nodes, listed, size, negatives, low, high, stage, "negatives")
    return far.select(F.col("own").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
