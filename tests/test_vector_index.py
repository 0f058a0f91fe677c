"""Trained cell index and pivot search, held against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import vector_index as V
from quarry.plans import q_index


def _frames(spark, x, q):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, embedding array<double>")
    return rows, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "qid long, qvec array<double>")


def _clusters(n, seed=1, dims=32, centres=40, spread=0.15):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    return c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dims))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_index_recall_with_each_vector_once(spark, tmp_path, sf):
    e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), "embedding")
    n = e.count()
    V.build_index(e, V.train(e, q_index.CELLS), str(tmp_path))
    q = e.filter(F.col("doc_id") % (n // 100) == 0).select(F.col("doc_id").alias("qid"), F.col("embedding").alias("qvec"))
    got = {(r.qid, r.doc_id) for r in V.search_index(spark, str(tmp_path), q, 8, q_index.PROBES, q_index.RERANK, exclude_own=True).collect()}
    x = np.array([r[0] for r in e.orderBy("doc_id").select("embedding").collect()], float)
    ids = sorted(r[0] for r in q.select("qid").collect())
    want = {(i, int(j)) for i in ids for j in [j for j in np.argsort(-(x @ x[i]), kind="stable") if j != i][:8]}
    assert len(got) == 8 * len(ids) and len(got & want) / len(want) >= 0.9
    assert q_index.RERANK <= 0.1 * n


def test_index_on_clusters_hot_cell_and_odd_rows(spark, tmp_path):
    x = _clusters(3000)
    x[:1000] = x[0]                                     # a third of all rows is one vector
    rows, queries = _frames(spark, x, x[:60:3] + 0.01)
    rows = rows.unionByName(spark.createDataFrame([(9000, None), (None, x[0].tolist())], rows.schema)).withColumn("code", F.lit(1))
    queries = queries.unionByName(spark.createDataFrame([(77, None)], queries.schema))
    V.build_index(rows, V.train(rows, 32), str(tmp_path), shard_rows=100)
    cells = spark.read.parquet(f"{tmp_path}/cells")
    assert cells.agg(F.max("shards")).first()[0] >= 10 and cells.agg(F.sum("rows")).first()[0] >= 3000
    got = {}
    for r in V.search_index(spark, str(tmp_path), queries, 5, 4, 60).collect():
        got.setdefault(r.qid, []).append((r.rk, r.doc_id))
    assert set(got) == set(range(20))
    hit = 0
    for i, found in got.items():
        d = ((x - (x[3 * i] + 0.01)) ** 2).sum(1)
        hit += len({j for _, j in found} & set(np.lexsort((np.arange(3000), np.round(d, 9)))[:5].tolist()))
    assert hit >= 0.95 * 100
    plan = V.search_index(spark, str(tmp_path), queries, 5, 4, 60)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pivots_are_exact_and_skip_on_clusters(spark):
    x = _clusters(2500)
    rows, queries = _frames(spark, x, x[::50])
    model = V.train(rows, 40, code_bytes=0)
    for radius in (0.0, 0.5, 1.5, 4.0):
        got = {(r.qid, r.doc_id) for r in V.within_pivots(rows, queries, radius, model, part_rows=300).collect()}
        want = {(i, int(j)) for i, q in enumerate(x[::50]) for j in np.flatnonzero(np.round(((x - q) ** 2).sum(1), 9) <= radius)}
        assert got == want
    share = V.within_pivots(rows, queries, 1.5, model, counts=True).agg(F.sum("n_compared")).first()[0] / (2500 * 50)
    assert share < 0.1
    assert V.within_pivots(rows.limit(0), queries, 1.0, model).count() == 0 and V.within_pivots(rows, queries, -1.0, model).count() == 0


def test_second_cells_lift_recall_at_equal_probes(spark, tmp_path):
    x = _clusters(1500, dims=8, centres=3, spread=0.8)
    rows, queries = _frames(spark, x, x[::30])
    model, recall = V.train(rows, 24), []
    for boundary in (0.0, 0.6):
        V.build_index(rows, model, f"{tmp_path}/{boundary}", boundary=boundary)
        got = {(r.qid, r.doc_id) for r in V.search_index(spark, f"{tmp_path}/{boundary}", queries, 8, 2, 200).collect()}
        want = {(i, int(j)) for i, q in enumerate(x[::30]) for j in np.argsort(((x - q) ** 2).sum(1), kind="stable")[:8]}
        recall.append(len(got & want) / len(want))
    assert recall[1] > recall[0]
