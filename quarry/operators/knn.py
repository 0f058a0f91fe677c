"""k-nearest-neighbour search of a query table against a corpus table, exact and by probed cells.

Both run on one engine (``_search``): every row of either side has a part, and queries meet the corpus rows of their
part.  Exact search deals the corpus to parts by hash and sends every query to all parts; cell search gives a corpus row
the part of its nearest centroid and sends a query to the parts of its nearest few.  So the cell search is an equi-join
on cells, and neither passes a query through the driver.

1. Queries are cut into blocks by hash, so that a block's vectors fit ``block_bytes``.
2. The two sides meet under (part, block).  A task streams them through numpy: first the block's vectors, then the
   corpus rows, one matrix product per (query chunk x batch), and keeps a top-k per (query, group).  It emits at
   most ``queries x groups x k`` rows for each part of ``part_rows`` corpus rows, never the distance matrix.
3. A window ``row_number() <= k`` over ``(query, group)`` ordered by ``(distance, id)`` finishes the top-k; Catalyst plans
   it as a partial ``WindowGroupLimit`` before the shuffle and a final one after it.

Distance is the squared Euclidean distance of the vectors as doubles; ties are broken by the corpus id so results do not
depend on partitioning.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params

# Bytes of one query-chunk x batch distance matrix inside a task.
_TILE_BYTES = 64 * 1024 * 1024


def _topk_sorted(qi: np.ndarray, g: np.ndarray, ids: np.ndarray, d: np.ndarray, key: np.ndarray, k: int):
    """Keep the k smallest (key, id) per (qi, g). Inputs are flat candidate arrays."""
    if len(d) == 0:
        return qi, g, ids, d, key
    order = np.lexsort((ids, key, g, qi))
    qi, g, ids, d, key = qi[order], g[order], ids[order], d[order], key[order]
    new_grp = np.ones(len(d), dtype=bool)
    new_grp[1:] = (qi[1:] != qi[:-1]) | (g[1:] != g[:-1])
    first = np.flatnonzero(new_grp)
    lengths = np.diff(np.append(first, len(d)))
    rank = np.arange(len(d)) - np.repeat(first, lengths)
    keep = rank < k
    return qi[keep], g[keep], ids[keep], d[keep], key[keep]


def _candidates(dist: np.ndarray, key: np.ndarray, q_offset: int, codes: np.ndarray, ids: np.ndarray, k: int):
    """Per-row, per-group candidates of a (queries x batch) distance tile (all ties of the
    k-th key are kept; the exact cut happens in ``_topk_sorted``)."""
    out_q, out_g, out_i, out_d, out_k = [], [], [], [], []
    for code in np.unique(codes):
        cols = np.flatnonzero(codes == code)
        sub = key[:, cols]
        if len(cols) > k:
            kth = np.partition(sub, k - 1, axis=1)[:, k - 1 : k]
            r, c = np.nonzero(sub <= kth)
        else:
            r, c = np.nonzero(np.isfinite(sub))
        kk = sub[r, c]
        fin = np.isfinite(kk)
        r, c, kk = r[fin], c[fin], kk[fin]
        out_q.append(r + q_offset)
        out_g.append(np.full(len(r), code, dtype=np.int64))
        out_i.append(ids[cols][c])
        out_d.append(dist[r, cols[c]])
        out_k.append(kk)
    if not out_q:
        return None
    return tuple(np.concatenate(x) for x in (out_q, out_g, out_i, out_d, out_k))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


class _TopK:
    """The best k corpus rows per (query, group) of one block of queries and one part of the corpus; or, with a radius, all
    rows that are near enough."""

    def __init__(self, k: int, n_by: int, excluding: bool, radius: float | None):
        self.k, self.n_by, self.excluding, self.radius = k, n_by, excluding, radius
        self.keys, self.vectors, self.Q = [], [], None
        self.groups: dict = {}
        self.buf, self.rows = [], 0

    def add_queries(self, pdf: pd.DataFrame) -> None:
        self.keys.append(pdf)
        self.vectors.append(_matrix(pdf["_vec"]))

    def add_corpus(self, pdf: pd.DataFrame) -> None:
        if not self.vectors:
            return
        if self.Q is None:
            self.Q, self.keys = np.concatenate(self.vectors), pd.concat(self.keys, ignore_index=True)
            self.qn = np.einsum("ij,ij->i", self.Q, self.Q)
        D, ids = _matrix(pdf["_vec"]), pdf["_c"].to_numpy()
        dn = np.einsum("ij,ij->i", D, D)
        if self.n_by:
            tuples = list(zip(*[pdf[f"_b{i}"].tolist() for i in range(self.n_by)]))
            codes = np.fromiter((self.groups.setdefault(t, len(self.groups)) for t in tuples), dtype=np.int64, count=len(tuples))
        else:
            codes = np.zeros(len(pdf), dtype=np.int64)
        step = max(1, _TILE_BYTES // (8 * max(1, len(pdf))))
        for s in range(0, len(self.Q), step):
            dist = self.qn[s:s + step, None] + dn[None, :] - 2.0 * (self.Q[s:s + step] @ D.T)
            np.maximum(dist, 0.0, out=dist)
            # ordering key on a 1e-9 grid: identical vectors tie exactly (a matrix product may differ in the last
            # bits), so the id tie-break decides; the distance itself is emitted unrounded
            key = np.round(dist, 9)
            if self.excluding:
                key[self.keys["_x"].to_numpy()[s:s + step, None] == pdf["_x"].to_numpy()[None, :]] = np.inf
            if self.radius is None:
                cand = _candidates(dist, key, s, codes, ids, self.k)
            else:
                r, c = np.nonzero(key <= self.radius)
                cand = (r + s, codes[c], ids[c], dist[r, c], key[r, c]) if len(r) else None
            if cand is not None:
                self.buf.append(cand)
                self.rows += len(cand[0])
        if self.radius is None and self.rows > 8 * len(self.Q) * self.k * max(1, len(self.groups)) + 100_000:
            self.buf = [_topk_sorted(*[np.concatenate(p) for p in zip(*self.buf)], self.k)]
            self.rows = len(self.buf[0][0])

    def result(self, q_cols: list) -> pd.DataFrame | None:
        if not self.buf:
            return None
        qi, g, ids, d, key = (np.concatenate(p) for p in zip(*self.buf))
        if self.radius is None:
            qi, g, ids, d, key = _topk_sorted(qi, g, ids, d, key, self.k)
        self.buf, self.rows = [], 0
        out = self.keys.loc[qi, q_cols].reset_index(drop=True)
        names = {code: t for t, code in self.groups.items()}
        for i in range(self.n_by):
            out[f"_b{i}"] = [names[x][i] for x in g.tolist()]
        out["_c"], out["distance"], out["_key"] = ids, d, key
        return out


def _search(corpus: DataFrame, queries: DataFrame, k: int, qid_cols, qvec_col, id_col, vec_col, by, exclude,
            n_parts: int, n_blocks: int, radius: float | None = None) -> DataFrame:
    """Top-k of the pairs that share a part, or all within a radius.  Both sides bring ``_part`` (a query once for each of its parts)."""
    q_excl, c_excl = exclude if exclude else (None, None)
    q_cols, b_cols = [f"_q{i}" for i in range(len(qid_cols))], [f"_b{i}" for i in range(len(by))]
    blocks = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    q = queries.select(
        "_part", F.pmod(F.xxhash64(*qid_cols), F.lit(n_blocks)).cast("int").alias("_block"), F.lit(0).alias("_kind"),
        *[F.col(c).alias(n) for c, n in zip(qid_cols, q_cols)],
        *[F.lit(None).cast(corpus.schema[c].dataType).alias(n) for c, n in zip(by, b_cols)],
        F.lit(None).cast(corpus.schema[id_col].dataType).alias("_c"),
        (F.col(q_excl) if q_excl else F.lit(None)).cast("string").alias("_x"), F.col(qvec_col).cast("array<double>").alias("_vec"))
    c = corpus.select(
        "_part", F.explode(blocks).alias("_block"), F.lit(1).alias("_kind"),
        *[F.lit(None).cast(queries.schema[c].dataType).alias(n) for c, n in zip(qid_cols, q_cols)],
        *[F.col(c).alias(n) for c, n in zip(by, b_cols)], F.col(id_col).alias("_c"),
        (F.col(c_excl) if c_excl else F.lit(None)).cast("string").alias("_x"), F.col(vec_col).cast("array<double>").alias("_vec"))
    out = T.StructType([T.StructField(n, queries.schema[c].dataType) for c, n in zip(qid_cols, q_cols)]
                       + [T.StructField(n, corpus.schema[c].dataType) for c, n in zip(by, b_cols)]
                       + [T.StructField("_c", corpus.schema[id_col].dataType), T.StructField("distance", T.DoubleType()),
                          T.StructField("_key", T.DoubleType())])
    n_by, excluding = len(by), exclude is not None

    def search(batches):
        at, top = None, None
        for pdf in batches:
            if not len(pdf):
                continue
            run = pdf[["_part", "_block", "_kind"]].to_numpy()
            cut = np.flatnonzero((run[1:] != run[:-1]).any(1)) + 1
            for low, high in zip([0, *cut], [*cut, len(pdf)]):
                part, block, kind = run[low]
                if (part, block) != at:
                    if top is not None and (done := top.result(q_cols)) is not None:
                        yield done
                    at, top = (part, block), _TopK(k, n_by, excluding, radius)
                (top.add_corpus if kind else top.add_queries)(pdf.iloc[low:high])
                if radius is not None and kind and (done := top.result(q_cols)) is not None:
                    yield done
        if top is not None and (done := top.result(q_cols)) is not None:
            yield done

    both = q.unionByName(c).repartition(n_parts * n_blocks, "_part", "_block").sortWithinPartitions("_part", "_block", "_kind")
    found = both.mapInPandas(search, out)
    names = [F.col(n).alias(c) for c, n in zip((*qid_cols, *by), q_cols + b_cols)]
    if radius is not None:
        return found.select(*names, F.col("_c").alias(id_col), "distance")
    w = Window.partitionBy(*q_cols, *b_cols).orderBy(F.col("_key").asc(), F.col("_c").asc())
    return (found.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
            .select(*names, F.col("_c").alias(id_col), "distance", F.col("rk").cast("bigint").alias("rk")))


def _query_blocks(queries: DataFrame, qvec_col: str, block_bytes: int) -> int:
    size = queries.agg(F.sum(F.size(qvec_col) * F.lit(8))).first()[0] or 0
    return max(1, math.ceil(size / block_bytes))


def _part_count(n_rows: int, part_rows: int, spark) -> int:
    """Parts of ``part_rows`` rows, but one for each core as long as they have some rows to share."""
    return max(1, math.ceil(n_rows / part_rows), min(spark.sparkContext.defaultParallelism, n_rows // 1024))


def knn(corpus: DataFrame, queries: DataFrame, k: int, *, qid_cols=("qid",), qvec_col: str = "qvec",
        id_col: str = "doc_id", vec_col: str = "embedding", by=(), exclude: tuple[str, str] | None = None,
        block_bytes: int = params.KNN_BLOCK_BYTES, part_rows: int = params.KNN_PART_ROWS) -> DataFrame:
    """Exact top-k corpus rows per query row (and per ``by`` group of the corpus).

    Returns ``qid_cols + by + [id_col, distance, rk]`` with ``rk`` 1..k (bigint).
    ``exclude=(query_col, corpus_col)`` drops pairs whose two values are equal
    (e.g. a question must not retrieve its own vector).
    """
    qid_cols, by = tuple(qid_cols), tuple(by)
    n = _part_count(corpus.count(), part_rows, corpus.sparkSession)
    parts = corpus.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(n)).cast("long"))
    asked = queries.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return _search(parts, asked, k, qid_cols, qvec_col, id_col, vec_col, by, exclude, n, _query_blocks(queries, qvec_col, block_bytes))


def within(corpus: DataFrame, queries: DataFrame, radius: float, *, qid_cols=("qid",), qvec_col: str = "qvec",
           id_col: str = "doc_id", vec_col: str = "embedding", by=(), exclude: tuple[str, str] | None = None,
           block_bytes: int = params.KNN_BLOCK_BYTES, part_rows: int = params.KNN_PART_ROWS) -> DataFrame:
    """All corpus rows within a squared distance of ``radius`` of each query: ``qid_cols + by + [id_col, distance]``."""
    qid_cols, by = tuple(qid_cols), tuple(by)
    n = _part_count(corpus.count(), part_rows, corpus.sparkSession)
    parts = corpus.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(n)).cast("long"))
    asked = queries.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return _search(parts, asked, 0, qid_cols, qvec_col, id_col, vec_col, by, exclude, n,
                   _query_blocks(queries, qvec_col, block_bytes), radius)


# --- R3: approximate search by cells --------------------------------------------------------------------------------------
def assign_cells(df: DataFrame, vec_col: str, centroids: np.ndarray, n: int, out: str = "cells") -> DataFrame:
    """Adds the numbers of the n centroids nearest to each vector, nearest first (ties: the smaller number)."""
    norm = (centroids * centroids).sum(1)

    def nearest(vectors: pd.Series) -> pd.Series:
        x = _matrix(vectors)
        d = np.round((x * x).sum(1)[:, None] + norm[None, :] - 2.0 * (x @ centroids.T), 9)
        return pd.Series(list(np.argsort(d, axis=1, kind="stable")[:, :n].astype(np.int64)))

    nearest.__annotations__ = {"vectors": pd.Series, "return": pd.Series}
    return df.withColumn(out, F.pandas_udf(nearest, "array<long>")(F.col(vec_col).cast("array<double>")))


def knn_cells(corpus: DataFrame, queries: DataFrame, k: int, centroids: np.ndarray, probes: int, *, qid_cols=("qid",),
              qvec_col: str = "qvec", id_col: str = "doc_id", vec_col: str = "embedding", by=(),
              exclude: tuple[str, str] | None = None, block_bytes: int = params.KNN_BLOCK_BYTES,
              part_rows: int = params.KNN_PART_ROWS) -> DataFrame:
    """Top-k among the corpus rows of the ``probes`` cells nearest to each query; columns as ``knn``.

    ``centroids`` is a bounded sample (a few thousand vectors).  A large cell is dealt to several parts.
    """
    qid_cols, by = tuple(qid_cols), tuple(by)
    parts = assign_cells(corpus.select(*{id_col, *by, *(exclude or ())[1:], vec_col}), vec_col, centroids, 1)
    split = max(1, math.ceil(corpus.count() / len(centroids) / part_rows))
    parts = parts.withColumn("_part", F.col("cells")[0] * split + F.pmod(F.xxhash64(id_col), F.lit(split)))
    asked = assign_cells(queries, qvec_col, centroids, probes)
    asked = asked.withColumn("_part", F.explode(F.flatten(F.transform("cells", lambda c: F.sequence(c * split, c * split + (split - 1))))))
    n = min(len(centroids) * split, corpus.sparkSession.sparkContext.defaultParallelism * 4)
    return _search(parts, asked.drop("cells"), k, qid_cols, qvec_col, id_col, vec_col, by, exclude, n,
                   _query_blocks(queries, qvec_col, block_bytes))


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact top-k (qid, doc_id) pairs found by the approximate search."""
    e = exact.select("qid", "doc_id").withColumn("_e", F.lit(1))
    a = approx.select("qid", "doc_id").withColumn("_a", F.lit(1))
    j = e.join(a, ["qid", "doc_id"], "left")
    return j.agg(F.count("*").cast("bigint").alias("n_exact"), F.count("_a").cast("bigint").alias("n_found"),
                 (F.count("_a") / F.count("*")).alias("recall"))


def compared_share(corpus: DataFrame, queries: DataFrame, centroids: np.ndarray, probes: int, qvec_col: str = "qvec",
                   vec_col: str = "embedding") -> DataFrame:
    """(n_compared, n_pairs): pairs that the cell search compares, of all pairs of a query and a corpus row."""
    sizes = assign_cells(corpus.select(vec_col), vec_col, centroids, 1).groupBy(F.col("cells")[0].alias("cell")).agg(F.count("*").alias("n"))
    asked = assign_cells(queries.select(qvec_col), qvec_col, centroids, probes).select(F.explode("cells").alias("cell"))
    met = asked.join(sizes, "cell", "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_compared"))
    return met.withColumn("n_pairs", F.lit(corpus.count() * queries.count()))
