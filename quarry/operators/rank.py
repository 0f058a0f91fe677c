"""Rerank, gating and confidence (K1-K9).  All per-question aggregates are one
``groupBy(qid)`` over at most k rows per question."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import params


def relevance_clamped(d) -> F.Column:
    """K4: 1 - min(d/2, 1)."""
    return 1 - F.least(d / 2, F.lit(1.0))


def relevance_floor(d) -> F.Column:
    """K4: max(0, 1 - d/2)."""
    return F.greatest(F.lit(0.0), 1 - d / 2)


def judge_rerank(cands: DataFrame, judge: DataFrame, top_k: int = params.RERANK_TOP_K,
                 max_docs: int = params.RERANK_MAX_DOCS, threshold: float = params.RERANK_THRESHOLD,
                 pos_col: str = "pos") -> DataFrame:
    """K1: judge scores for the first ``max_docs`` candidates of each question.

    ``judge`` has (doc_id, score 0..10, relevant) — or (qid, doc_id, ...) for per-question
    verdicts.  Missing verdict: score 5, relevant.  rscore = score/10; relevant iff judged
    relevant and rscore >= threshold.  Sorted by rscore desc (stable: ties keep the candidate
    order), top_k kept.  Adds rscore, is_relevant, rpos."""
    keys = ["qid", "doc_id"] if "qid" in judge.columns else ["doc_id"]
    j = judge.select(*keys, F.col("score").alias("_s"), F.col("relevant").alias("_r"))
    c = cands.where(F.col(pos_col) <= max_docs).join(j, keys, "left")
    rscore = F.coalesce(F.col("_s"), F.lit(5.0)) / 10.0
    c = c.withColumn("rscore", rscore).withColumn(
        "is_relevant", F.coalesce(F.col("_r"), F.lit(True)) & (F.col("rscore") >= threshold)).drop("_s", "_r")
    w = Window.partitionBy("qid").orderBy(F.col("rscore").desc(), F.col(pos_col))
    return c.withColumn("rpos", F.row_number().over(w).cast("bigint")).where(F.col("rpos") <= top_k)


def passthrough_rerank(cands: DataFrame, top_k: int | None = None, pos_col: str = "pos") -> DataFrame:
    """K2: rerank disabled or failed — original order, rscore 1 - min(d/2, 1) (d default 0.5),
    all relevant."""
    out = cands.withColumn("rscore", relevance_clamped(F.coalesce(F.col("distance"), F.lit(0.5)))) \
        .withColumn("is_relevant", F.lit(True)).withColumn("rpos", F.col(pos_col))
    return out.where(F.col(pos_col) <= top_k) if top_k else out


def rerank_policy(docs_k16: DataFrame, docs_k8: DataFrame, judge: DataFrame,
                  final_k: int = params.RETRIEVAL_TOP_K, pool_size: int = params.RERANK_POOL,
                  min_docs: int = params.RERANK_MIN_DOCS, top_k: int = params.RERANK_TOP_K) -> DataFrame:
    """K3: rerank only when a question has > ``min_docs`` docs, judging the first ``pool_size``;
    keep the relevant of the top ``top_k``; fewer than ``top_k`` survivors -> the k=8 hybrid
    result.  Questions with <= ``min_docs`` docs keep their first ``final_k``.

    Branches are tagged (0 reranked, 1 redo at k=8, 2 short list) and per question the first
    present branch wins — windows instead of semi/anti joins.
    Returns (qid, doc_id, type, domain, distance, pos) with pos 1..n in final order."""
    w = Window.partitionBy("qid")
    cols = ["qid", "doc_id", "type", "domain", "distance", "pos"]
    d16 = docs_k16.withColumn("_n", F.count("*").over(w))
    rr = judge_rerank(d16.where((F.col("_n") > min_docs) & (F.col("pos") <= pool_size)), judge, top_k=top_k)
    surv = rr.where(F.col("is_relevant")).withColumn("_ns", F.count("*").over(w))
    kept = surv.where(F.col("_ns") >= top_k).withColumn("pos", F.col("rpos")).select(*cols) \
        .withColumn("_b", F.lit(0))
    n16 = docs_k16.groupBy("qid").agg(F.count("*").alias("_n"))
    redo = docs_k8.join(n16.where(F.col("_n") > min_docs), "qid", "left_semi").select(*cols) \
        .withColumn("_b", F.lit(1))
    short = d16.where((F.col("_n") <= min_docs) & (F.col("pos") <= final_k)).select(*cols) \
        .withColumn("_b", F.lit(2))
    u = kept.unionByName(redo).unionByName(short)
    return u.withColumn("_m", F.min("_b").over(w)).where(F.col("_b") == F.col("_m")).select(*cols)


def doc_stats(docs: DataFrame) -> DataFrame:
    """Per-question aggregates used by K5/K6: n_docs, mean statute relevance, max/avg relevance."""
    d = F.col("distance")
    rel_gate = F.when(F.col("type") == "statute", relevance_clamped(F.coalesce(d, F.lit(1.0))))
    rel_conf = relevance_floor(F.coalesce(d, F.lit(1.0)))
    return docs.groupBy("qid").agg(
        F.count("*").alias("n_docs"),
        F.avg(rel_gate).alias("statute_relevance"),
        F.max(rel_conf).alias("max_rel"),
        F.avg(rel_conf).alias("avg_rel"),
        F.max((F.col("type") == "statute").cast("int")).alias("has_statute"),
    )


def low_relevance(stats: DataFrame, min_relevance: float = params.MIN_RELEVANCE) -> F.Column:
    """K5: no docs, or no statute, or mean statute relevance below the floor."""
    return F.coalesce(F.col("n_docs"), F.lit(0)).eqNullSafe(0) | F.col("statute_relevance").isNull() | (
        F.col("statute_relevance") < min_relevance)


def confidence(top_k: int = params.RETRIEVAL_TOP_K, cap: float = params.CONFIDENCE_CAP) -> F.Column:
    """K6 over doc_stats columns: 0.4 max + 0.4 avg + 0.2 min(n/top_k, 1) + 0.1 has_statute,
    capped, 2 decimals; 0 without docs."""
    n = F.coalesce(F.col("n_docs"), F.lit(0))
    raw = (0.4 * F.col("max_rel") + 0.4 * F.col("avg_rel") + 0.2 * F.least(n / float(top_k), F.lit(1.0))
           + 0.1 * F.col("has_statute"))
    return F.when(n > 0, F.round(F.least(raw, F.lit(cap)), 2)).otherwise(F.lit(0.0))


def is_uncertain(conf, n_docs, threshold: float = params.CONFIDENCE_THRESHOLD) -> F.Column:
    """K7."""
    return (conf < threshold) | (F.coalesce(n_docs, F.lit(0)) == 0)


def confidence_band(conf, high: float = params.BAND_HIGH, medium: float = params.BAND_MEDIUM) -> F.Column:
    """K8."""
    return F.when(conf >= high, "high").when(conf >= medium, "medium").otherwise("low")


def check_policy(out_of_scope, n_docs, low_rel) -> F.Column:
    """K9: struct(check, deep): out of scope -> no check; < 2 docs or low relevance -> deep
    (model) check; otherwise no check."""
    risky = (F.coalesce(n_docs, F.lit(0)) < 2) | low_rel
    check = F.when(out_of_scope, F.lit(False)).otherwise(risky)
    return F.struct(check.alias("check"), check.alias("deep"))
