"""Driver queries: embeddings (M1) and approximate search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quarry.operators.knn import compared_share, knn, knn_cells, recall_at_k
from quarry.operators.models import TOKEN_PATTERN, hashed_embeddings
from quarry.plans import adapters as ad
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register

DIM = 64


def _summary(emb):
    """Scalar fingerprint of an embedding: argmax bucket (lowest on ties), max weight, non-zeros."""
    mx = F.array_max(emb)
    return (F.array_position(emb, mx) - 1).cast("bigint"), F.round(mx, 6), F.size(F.filter(emb, lambda x: x > 0))


@register("embed_hashed", f"""
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(list_position(vec, list_max(vec)) - 1 AS BIGINT) AS top_bucket, round(list_max(vec), 6) AS max_weight,
       CAST(len(list_filter(vec, lambda x: x > 0)) AS INTEGER) AS nonzero
FROM (
  SELECT doc_id, toks, CASE WHEN nrm > 0 THEN list_transform(cnt, lambda x: x / nrm) ELSE cnt END AS vec
  FROM (
    SELECT doc_id, toks, cnt, sqrt(list_sum(list_transform(cnt, lambda x: x * x))) AS nrm
    FROM (
      SELECT doc_id, toks,
             list_transform(range({DIM}), lambda i: CAST(len(list_filter(bks, lambda b: b = i)) AS DOUBLE)) AS cnt
      FROM (
        SELECT doc_id, toks,
               list_transform(toks, lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT) % {DIM}) AS bks
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{TOKEN_PATTERN}'),
                                         lambda t: length(t) > 0) AS toks FROM documents)))))""")
def q_embed_hashed(spark, sf):
    """M1 default embedding over whole documents (hashed bag of words, L2-normalised)."""
    e = hashed_embeddings(ad.table(spark, sf, "documents"), "doc_id", "text", DIM)
    top, mx, nz = _summary(F.col("embedding"))
    return e.select("doc_id", "n_tokens", top.alias("top_bucket"), mx.alias("max_weight"), nz.alias("nonzero"))


CELLS, PROBES = 128, 64      # half of the cells: the test vectors are spread evenly, so near ones lie in many


def _centroids(spark, sf) -> np.ndarray:
    """Bounded sample: the CELLS vectors with the smallest ids."""
    rows = ad.table(spark, sf, "embeddings").orderBy("vec_id").limit(CELLS).select("embedding").collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


_SQ = "list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"
CELL_CTES = [f"""cent AS (
  SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS cell, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings QUALIFY row_number() OVER (ORDER BY vec_id) <= {CELLS})""", f"""ccell AS (
  SELECT doc_id, embedding, cell FROM (
    SELECT c.doc_id, c.embedding, cell,
           row_number() OVER (PARTITION BY c.doc_id ORDER BY round({_SQ.format(a='c.embedding', b='v')}, 9), cell) AS r
    FROM corpus c, cent) WHERE r = 1)""", f"""qcell AS (
  SELECT qid, qvec, cell FROM (
    SELECT q.qid, q.qvec, cell, row_number() OVER (PARTITION BY q.qid ORDER BY round({_SQ.format(a='q.qvec', b='v')}, 9), cell) AS r
    FROM questions q, cent) WHERE r <= {PROBES})""", f"""met AS (
  SELECT qid, doc_id, {_SQ.format(a='qvec', b='embedding')} AS distance FROM qcell JOIN ccell USING (cell) WHERE doc_id <> qid)""", """cells8 AS (
  SELECT qid, doc_id, distance, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), doc_id) AS rk FROM met
  QUALIFY rk <= 8)"""]


def _approximate(spark, sf):
    return knn_cells(ad.corpus(spark, sf), ad.questions(spark, sf), 8, _centroids(spark, sf), PROBES, exclude=("qid", "doc_id"))


@register("knn_lsh", S.with_(S.CORPUS, S.QUESTIONS, *CELL_CTES) + "SELECT qid, doc_id, rk, round(distance, 6) AS distance FROM cells8")
def q_knn_lsh(spark, sf):
    """Approximate top-8; vectors are hashed to the cell of their nearest centroid, questions probe a few cells."""
    return _approximate(spark, sf).select("qid", "doc_id", "rk", F.round("distance", 6).alias("distance"))


@register("knn_lsh_recall", S.with_(S.CORPUS, S.QUESTIONS, *CELL_CTES, S.PAIRS, """exact8 AS (
  SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), doc_id) AS rk FROM pairs QUALIFY rk <= 8)""") + """
SELECT CAST(count(*) AS BIGINT) AS n_exact, CAST(count(c.doc_id) AS BIGINT) AS n_found, count(c.doc_id) / count(*) AS recall,
       (SELECT count(*) FROM qcell JOIN ccell USING (cell)) AS n_compared,
       (SELECT count(*) FROM corpus) * (SELECT count(*) FROM questions) AS n_pairs
FROM exact8 e LEFT JOIN cells8 c USING (qid, doc_id)""")
def q_knn_lsh_recall(spark, sf):
    """R3 quality: recall@8 against the exact search, and how many of all pairs were compared."""
    c, q = ad.corpus(spark, sf), ad.questions(spark, sf)
    exact = knn(c, q, 8, exclude=("qid", "doc_id"))
    share = compared_share(c, q, _centroids(spark, sf), PROBES)
    return recall_at_k(_approximate(spark, sf), exact).join(F.broadcast(share))     # one row each
