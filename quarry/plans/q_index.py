"""Driver queries: the written vector index."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators.knn import knn, recall_at_k
from quarry.operators.vector_index import build_index, search_index, train
from quarry.plans import adapters as ad
from quarry.plans.catalog import register
from quarry.session import scratch_path

# The test vectors are spread evenly over the sphere, so near ones lie in many cells; clustered vectors need few probes.
CELLS, PROBES, RERANK = 64, 48, 48


def _found(spark, sf):
    corpus, root = ad.corpus(spark, sf).select("doc_id", "embedding"), scratch_path(spark, f"vector-index-{uuid.uuid4().hex}")
    build_index(corpus, train(corpus, CELLS), root)
    return search_index(spark, root, ad.questions(spark, sf), 8, PROBES, RERANK, exclude_own=True)


@register("knn_index")
def q_knn_index(spark, sf):
    """The 8 nearest documents of every question by the written index; no twin, as k-means isn't expressible in SQL."""
    return _found(spark, sf).select("qid", "doc_id", "rk", F.round("distance", 6).alias("distance"))


@register("knn_index_recall")
def q_knn_index_recall(spark, sf):
    """R3 quality: recall@8 of the written index against the exact search."""
    exact = knn(ad.corpus(spark, sf), ad.questions(spark, sf), 8, exclude=("qid", "doc_id"))
    return recall_at_k(_found(spark, sf), exact)
