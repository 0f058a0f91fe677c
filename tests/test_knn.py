"""kNN against brute force; invariance to partitioning and query blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.knn import compared_share, knn, knn_cells, recall_at_k, within


def _data(spark, n=300, q=17, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(n, dim)).astype(np.float32)
    qs = rng.normal(size=(q, dim)).astype(np.float32)
    cdf = spark.createDataFrame([(i, ["a", "b", "c"][i % 3], c[i].tolist()) for i in range(n)],
                                "doc_id long, grp string, embedding array<float>")
    qdf = spark.createDataFrame([(i, qs[i].tolist()) for i in range(q)], "qid long, qvec array<float>")
    return c.astype(np.float64), qs.astype(np.float64), cdf, qdf


def _brute(c, qs, k, groups=None):
    out = set()
    for qi in range(len(qs)):
        d = ((c - qs[qi]) ** 2).sum(1)
        keys = [None] if groups is None else sorted(set(groups))
        for g in keys:
            idx = [i for i in range(len(c)) if groups is None or groups[i] == g]
            best = sorted(idx, key=lambda i: (d[i], i))[:k]
            out |= {(qi, g, i) for i in best}
    return out


def test_knn_matches_brute_force(spark):
    c, qs, cdf, qdf = _data(spark)
    res = knn(cdf, qdf, 5, qvec_col="qvec").collect()
    assert {(r.qid, None, r.doc_id) for r in res} == _brute(c, qs, 5)
    assert all(1 <= r.rk <= 5 for r in res)


def test_knn_groups_and_partitions(spark):
    c, qs, cdf, qdf = _data(spark)
    groups = ["a", "b", "c"] * 100
    want = _brute(c, qs, 4, groups)
    for parts in (1, 7):
        res = knn(cdf.repartition(parts), qdf, 4, by=("grp",)).collect()
        assert {(r.qid, r.grp, r.doc_id) for r in res} == want


def test_knn_query_blocks_equal_single_pass(spark):
    c, qs, cdf, qdf = _data(spark)
    one = {(r.qid, r.doc_id, r.rk) for r in knn(cdf, qdf, 3).collect()}
    blocks = {(r.qid, r.doc_id, r.rk) for r in knn(cdf, qdf, 3, block_bytes=200, part_rows=40).collect()}
    assert one == blocks


def test_knn_self_distance_zero_and_exclusion(spark):
    c, qs, cdf, qdf = _data(spark)
    self_q = cdf.select(F.col("doc_id").alias("qid"), F.col("embedding").alias("qvec")).limit(5)
    res = knn(cdf, self_q, 1).collect()
    assert all(r.doc_id == r.qid and r.distance == pytest.approx(0.0, abs=1e-9) for r in res)
    res = knn(cdf, self_q, 1, exclude=("qid", "doc_id")).collect()
    assert all(r.doc_id != r.qid for r in res)


def test_cells_equal_brute_force_in_the_probed_cells(spark):
    c, qs, cdf, qdf = _data(spark)
    centroids = c[:12]
    cell = ((c[:, None] - centroids[None]) ** 2).sum(2).argmin(1)
    near = np.argsort(((qs[:, None] - centroids[None]) ** 2).sum(2), axis=1)[:, :3]
    want = set()
    for q in range(len(qs)):
        d = ((c - qs[q]) ** 2).sum(1)
        want |= {(q, i) for i in sorted(np.flatnonzero(np.isin(cell, near[q])), key=lambda i: (d[i], i))[:5]}
    for rows in (10, 1000):
        got = knn_cells(cdf, qdf, 5, centroids, 3, part_rows=rows)
        assert {(r.qid, r.doc_id) for r in got.collect()} == want
    share = compared_share(cdf, qdf, centroids, 3).first()
    assert share.n_compared == sum(int(np.isin(cell, near[q]).sum()) for q in range(len(qs))) and share.n_pairs == 300 * 17
    full = knn_cells(cdf, qdf, 5, centroids, 12)
    assert recall_at_k(full, knn(cdf, qdf, 5)).first().recall == 1.0


def test_range_search_is_complete(spark):
    c, qs, cdf, qdf = _data(spark)
    want = {(q, i) for q in range(len(qs)) for i in np.flatnonzero(((c - qs[q]) ** 2).sum(1) <= 9.0)}
    for rows in (20, 10_000):
        got = within(cdf, qdf, 9.0, part_rows=rows, block_bytes=300)
        assert {(r.qid, r.doc_id) for r in got.collect()} == want and got.count() == len(want)
