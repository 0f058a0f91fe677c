"""The per-question half of the answer policy in one step (R5-R9 + K1-K3 fused).

After the kNN pool, everything a question needs is at most ``fetch x groups x
expansions`` candidate rows.  They are enriched (keyword bonus, judge verdict), grouped
by question once — a bounded list per question — and the dedup, keyword re-rank, hybrid
merge at k=16 and k=8, fallback and rerank policy run as array expressions on that list.
One shuffle replaces the chain of windows and joins of the stage-by-stage operators in
``retrieve`` / ``rank`` (which remain the reference implementation of each step and are
oracle-checked on their own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params
from quarry.operators.retrieve import BROADCAST_ROWS, quotas


def _doc(d, dist):
    return F.struct(d["doc_id"].alias("doc_id"), d["type"].alias("type"), d["domain"].alias("domain"),
                    dist.alias("distance"), d["score"].alias("score"), d["relevant"].alias("relevant"))


def _hybrid(rows, k: int):
    """R4-R9 for final size k on one question's de-duplicated candidates: docs in final order.
    ``d{k}`` is the doc's distance within the k-sized over-fetch (null when outside it)."""
    sk, ck = quotas(k)
    dk = f"d{k}"
    st = F.array_sort(F.transform(F.filter(rows, lambda r: (r["type"] == "statute") & r[dk].isNotNull()),
                                  lambda r: F.struct((r[dk] + F.coalesce(r["bonus"], F.lit(0.0))).alias("k1"),
                                                     r[dk].alias("k2"), r["doc_id"].alias("k3"), _doc(r, r[dk]).alias("d"))))
    cs = F.array_sort(F.transform(F.filter(rows, lambda r: (r["type"] == "case") & r[dk].isNotNull()),
                                  lambda r: F.struct(r[dk].alias("k1"), r["doc_id"].alias("k3"), _doc(r, r[dk]).alias("d"))))
    merged = F.concat(F.transform(F.slice(st, 1, sk), lambda x: x["d"]), F.transform(F.slice(cs, 1, ck), lambda x: x["d"]))
    fb = F.transform(F.slice(F.array_sort(F.transform(F.filter(rows, lambda r: r["d0"].isNotNull()), lambda r: F.struct(
        r["d0"].alias("k1"), r["doc_id"].alias("k3"), _doc(r, r["d0"]).alias("d")))), 1, k), lambda x: x["d"])
    take_fb = F.when(F.size(merged) == 0, F.lit(k)).otherwise(F.lit(0))     # R9: only when both are empty
    return F.slice(F.concat(merged, F.slice(fb, 1, take_fb)), 1, k)


def final_docs(pool_df: DataFrame, bonus: DataFrame, judge: DataFrame | None, *, est_rows: int | None = None,
               pool_k: int = 16, final_k: int = params.RETRIEVAL_TOP_K, pool_size: int = params.RERANK_POOL,
               min_docs: int = params.RERANK_MIN_DOCS, top_k: int = params.RERANK_TOP_K,
               threshold: float = params.RERANK_THRESHOLD, redo: bool = True) -> DataFrame:
    """(qid, doc_id, type, domain, distance, pos): hybrid retrieval + rerank policy per question.

    ``judge`` = (doc_id, score, relevant) or None (no rerank: the first ``final_k`` of k=16).  Without ``redo`` the relevant
    ones of the judge's ``top_k`` are final, however few (the stream's policy).
    Candidates are first de-duplicated per (question, doc) with the smallest distance within
    each over-fetch (k=16, k=8, unfiltered) in one aggregation, then grouped per question."""
    small = est_rows is not None and est_rows <= BROADCAST_ROWS
    p = pool_df.join(bonus, ["qid", "doc_id"], "left")
    if judge is not None:
        j = judge.select("doc_id", "score", "relevant")
        if small:       # only the candidates' verdicts move
            j = F.broadcast(j.join(F.broadcast(pool_df.select("doc_id").distinct()), "doc_id", "left_semi"))
        p = p.join(j, "doc_id", "left")
    else:
        p = p.withColumn("score", F.lit(None).cast("double")).withColumn("relevant", F.lit(None).cast("boolean"))

    def within(k):
        sk, ck = quotas(k)
        keep = ((F.col("type") == "statute") & (F.col("rk") <= 2 * sk)) | (
            (F.col("type") == "case") & (F.col("ord") == 0) & (F.col("rk") <= 2 * ck))
        return F.min(F.when(keep, F.col("distance"))).alias(f"d{k}")

    ks = sorted({pool_k, final_k})
    per_doc = p.groupBy("qid", "doc_id").agg(
        F.first("type").alias("type"), F.first("domain").alias("domain"), *[within(k) for k in ks],
        F.min(F.when(F.col("ord") == 0, F.col("distance"))).alias("d0"),
        F.max("bonus").alias("bonus"), F.max("score").alias("score"), F.max("relevant").alias("relevant"))
    row = F.struct("doc_id", "type", "domain", *[f"d{k}" for k in ks], "d0", "bonus", "score", "relevant")
    g = per_doc.groupBy("qid").agg(F.collect_list(row).alias("rows"))
    g = g.withColumn("_d16", _hybrid(F.col("rows"), pool_k))
    if judge is None:
        g = g.withColumn("_final", F.slice("_d16", 1, final_k))
    else:
        g = g.withColumn("_d8", _hybrid(F.col("rows"), final_k))
        judged = F.transform(F.slice("_d16", 1, pool_size), lambda d, i: F.struct(
            (-(F.coalesce(d["score"], F.lit(5.0)) / 10.0)).alias("neg"), i.alias("i"),
            (F.coalesce(d["relevant"], F.lit(True)) & (F.coalesce(d["score"], F.lit(5.0)) / 10.0 >= threshold))
            .alias("rel"), d.alias("d")))
        surv = F.transform(F.filter(F.slice(F.array_sort(judged), 1, top_k), lambda x: x["rel"]), lambda x: x["d"])
        g = g.withColumn("_surv", surv)
        g = g.withColumn("_final", F.col("_surv")) if not redo else g.withColumn(
            "_final", F.when(F.size("_d16") <= min_docs, F.slice("_d16", 1, final_k))
            .when(F.size("_surv") >= top_k, F.col("_surv")).otherwise(F.col("_d8")))
    # the outer form: for the inner one the optimizer adds a filter on the list's size below the projections, which
    # evaluates the whole nested expression again
    out = g.select("qid", F.posexplode_outer("_final").alias("_p", "d")).where(F.col("_p").isNotNull())
    return out.select("qid", F.col("d.doc_id").alias("doc_id"), F.col("d.type").alias("type"),
                      F.col("d.domain").alias("domain"), F.col("d.distance").alias("distance"),
                      (F.col("_p") + 1).cast("bigint").alias("pos"))
