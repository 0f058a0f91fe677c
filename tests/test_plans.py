"""Plan shape: no all-pairs operators, pruned scans, partial top-k before the shuffle."""

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_products_in_registered_queries(spark):
    qs = ent.queries()
    for name in ["knn_exact", "knn_filtered", "answer_pipeline", "hybrid_topk", "rerank_policy", "knn_expanded",
                 "eval_pipeline", "halluc_eval", "scope_gate", "expand_queries", "tag_keywords"]:
        p = _plan(qs[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_knn_scan_is_pruned_and_topk_is_partial(spark):
    p = _plan(ent.queries()["knn_exact"](spark, SF))
    # the vector side of the corpus never reads the document text
    emb_scans = [l for l in p.splitlines() if "FileScan parquet" in l and "embeddings.parquet" in l]
    assert emb_scans and all("text" not in l for l in emb_scans)
    assert "WindowGroupLimit" in p            # partial top-k before the shuffle, final after it
    assert "MapInPandas" in p or "PythonMapInArrow" in p or "MapInArrow" in p
