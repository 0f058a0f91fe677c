"""Driver queries: retrieval."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators.knn import knn
from quarry.operators.retrieve import search_written
from quarry.plans import adapters as ad
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register
from quarry.session import scratch_path
from quarry.sources.sinks import write_index

K = 8


def _round(c: str, n: int = 6):
    return F.round(F.col(c), n).alias(c)


@register("knn_exact", S.with_(S.CORPUS, S.QUESTIONS, S.PAIRS) + f"""
SELECT qid, doc_id, rk, round(distance, 6) AS distance FROM (
  SELECT qid, doc_id, distance, row_number() OVER (PARTITION BY qid ORDER BY distance, doc_id) AS rk FROM pairs)
WHERE rk <= {K}""")
def knn_exact(spark, sf):
    res = knn(ad.corpus(spark, sf), ad.questions(spark, sf), K, exclude=("qid", "doc_id"))
    return res.select("qid", "doc_id", "rk", _round("distance"))


@register("knn_filtered", S.with_(S.CORPUS, S.QUESTIONS, S.PAIRS) + f"""
SELECT qid, doc_id, rk, round(distance, 6) AS distance FROM (
  SELECT qid, doc_id, distance, row_number() OVER (PARTITION BY qid ORDER BY distance, doc_id) AS rk
  FROM pairs WHERE type = 'statute')
WHERE rk <= {K}""")
def knn_filtered(spark, sf):
    """R2: the index is written once by (domain, type); the search reads the folders of one type."""
    root = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    write_index(ad.corpus(spark, sf).select("doc_id", "content", "type", "domain", "embedding"), root)
    res = search_written(spark, root, ad.questions(spark, sf), K, types=["statute"])
    return res.select("qid", "doc_id", "rk", _round("distance"))
