"""Retrieval compositions over ``knn``.

``pool`` runs the single kNN pass an answer needs: every (question, expansion)
row against the corpus, top ``fetch`` per (domain, type) — the per-collection
over-fetch of a multi-collection store.  Everything after that (dedup, keyword
re-rank, hybrid merge at k=16 or k=8, fallback, plain search) is derived from
the pool with windows over at most ``fetch x groups`` rows per question, so the
corpus is scanned once per answer batch.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params
from quarry.functions.keywords import automaton, contained, words_in
from quarry.functions.text import ARTICLE_REF, lit_array, ws_words
from quarry.operators.knn import knn
from quarry.operators.vector_index import Quantiser, train, within_pivots
from quarry.sources.sinks import open_index

# Rows of a candidate table small enough to broadcast into a join with the corpus, and bytes of a row of it: candidates are ids and
# numbers, so both bound what is broadcast.
BROADCAST_ROWS, CANDIDATE_BYTES = 500_000, 128


def quotas(k: int) -> tuple[int, int]:
    """(statute_k, case_k) for a final size k."""
    statute_k = max(4, k // 2 + 1)
    return statute_k, k - statute_k + 2


def fetch_size(k: int) -> int:
    sk, ck = quotas(k)
    return max(2 * sk, 2 * ck)


def pool(corpus: DataFrame, qrows: DataFrame, fetch: int, *, qid_cols=("qid", "ord"), by=("domain", "type"),
         exclude=("qid", "doc_id")) -> DataFrame:
    """Top ``fetch`` per (query row, group). Columns: qid_cols, by, doc_id, distance, rk."""
    c = corpus.select("doc_id", *[b for b in by if b != "doc_id"], "embedding")
    return knn(c, qrows, fetch, qid_cols=qid_cols, by=by, exclude=exclude)


def hybrid_candidates(pool_df: DataFrame, k: int) -> DataFrame:
    """Statutes from every expansion and cases from the original query, each within its
    own per-collection over-fetch for final size k; de-duplicated by doc_id (min distance)."""
    sk, ck = quotas(k)
    keep = ((F.col("type") == "statute") & (F.col("rk") <= 2 * sk)) | (
        (F.col("type") == "case") & (F.col("ord") == 0) & (F.col("rk") <= 2 * ck))
    return dedup(pool_df.where(keep))


def dedup(cands: DataFrame) -> DataFrame:
    """One row per (qid, doc_id) keeping the smallest distance."""
    return cands.groupBy("qid", "doc_id").agg(
        F.min("distance").alias("distance"), F.first("type").alias("type"), F.first("domain").alias("domain"))


def _row_bytes(df: DataFrame) -> float:
    """A bound on the bytes of a row of numbers and short keys; any other column makes it infinite."""
    keys = {"type": 16, "domain": 32, "qid": 16, "doc_id": 16}
    return sum(8 if isinstance(f.dataType, (T.NumericType, T.BooleanType)) else
               keys.get(f.name, math.inf) if isinstance(f.dataType, T.StringType) else math.inf for f in df.schema)


def attach(small: DataFrame, corpus: DataFrame, cols, on: str = "doc_id", est_rows: int | None = None) -> DataFrame:
    """Join corpus columns onto a candidate table.  The candidate side is broadcast only when ``est_rows``, its row count or
    a bound on it, is within ``BROADCAST_ROWS`` and its columns are few and of bounded width; otherwise the planner shuffles.
    A broadcast table is used twice, so ``small`` should be persisted: its keys go below the joins that make up the corpus, which then
    shuffle the candidates' texts only."""
    right = corpus.select(on, *[c for c in cols if c != on])
    if est_rows is not None and est_rows <= BROADCAST_ROWS and _row_bytes(small) <= CANDIDATE_BYTES:
        right = right.join(F.broadcast(small.select(on)), on, "left_semi")
        return right.join(F.broadcast(small), on, "inner")
    return small.join(right, on, "inner")


def question_features(questions: DataFrame, words, text_col: str = "question",
                      article_ref: str = ARTICLE_REF) -> DataFrame:
    """R7, question side (computed once per question, not per candidate):
    qlex = lexicon words in the lowered question, qarts = article references (with repeats),
    qwords = lowered whitespace words of length >= 2 (with repeats)."""
    lq = F.lower(F.col(text_col))
    return questions.select(
        "qid",
        F.transform(contained(lq, words), lambda i: F.get(lit_array(words), i)).alias("qlex"),
        F.regexp_extract_all(F.col(text_col), F.lit(article_ref), 0).alias("qarts"),
        F.filter(ws_words(lq), lambda w: F.length(w) >= 2).alias("qwords"))


@F.pandas_udf(T.DoubleType())
def _bonus_udf(qlex: pd.Series, qarts: pd.Series, qwords: pd.Series, lc: pd.Series) -> pd.Series:
    """Bonus (<= 0) added to a statute's distance: -0.5 per lexicon word in both, -0.5 more when >= 2 such words;
    -2.0 per article reference occurrence found in the content; -0.3 per question word found in it.  Over Arrow
    batches; a batch's words are looked for by one automaton, and a text is passed once, however many words and questions."""
    lists = [[list(x) for x in column] for column in (qlex, qarts, qwords)]
    words = automaton({w for column in lists for some in column for w in some})
    seen: dict = {}
    out = []
    for lex, arts, asked, text in zip(*lists, lc):
        if text not in seen:
            seen[text] = words_in(text, words)
        found = seen[text]
        n = sum(1 for w in lex if w in found)
        out.append(-0.5 * n - (0.5 if n >= 2 else 0.0) - 2.0 * sum(w in found for w in arts) - 0.3 * sum(w in found for w in asked))
    return pd.Series(out, dtype="float64")


def keyword_bonus_table(cands: DataFrame, questions: DataFrame, corpus: DataFrame, words,
                        est_rows: int | None = None) -> DataFrame:
    """(qid, doc_id, bonus) for every candidate statute (cases get no bonus).  Content is
    lowered in the JVM; the substring counts run in an Arrow-batched pandas UDF."""
    st = cands.where(F.col("type") == "statute").select("qid", "doc_id").distinct()
    withdoc = attach(st, corpus, ["content"], est_rows=est_rows).withColumn("lc", F.lower("content"))
    feats = question_features(questions, words)
    j = withdoc.join(feats, "qid")      # arrays of words: the planner knows their bytes, a row count doesn't
    return j.select("qid", "doc_id", _bonus_udf("qlex", "qarts", "qwords", "lc").alias("bonus"))


def keyword_rerank(cands: DataFrame, bonus: DataFrame) -> DataFrame:
    """Adds ``kscore`` = distance + bonus for statutes, distance for cases."""
    j = cands.join(bonus, ["qid", "doc_id"], "left")
    return j.withColumn("kscore", F.when(F.col("type") == "statute", F.col("distance") + F.col("bonus"))
                        .otherwise(F.col("distance"))).drop("bonus")


def hybrid_merge(scored: DataFrame, k: int) -> DataFrame:
    """First statute_k statutes by keyword score, then case_k cases by distance, cut to k.
    Output adds ``pos`` (1..k, bigint)."""
    sk, ck = quotas(k)
    ws = Window.partitionBy("qid").orderBy("kscore", "distance", "doc_id")
    wc = Window.partitionBy("qid").orderBy("distance", "doc_id")
    st = scored.where(F.col("type") == "statute").withColumn("brk", F.row_number().over(ws)).where(
        F.col("brk") <= sk).withColumn("branch", F.lit(0))
    cs = scored.where(F.col("type") == "case").withColumn("brk", F.row_number().over(wc)).where(
        F.col("brk") <= ck).withColumn("branch", F.lit(1))
    w = Window.partitionBy("qid").orderBy("branch", "brk")
    return (st.unionByName(cs).withColumn("pos", F.row_number().over(w).cast("bigint"))
            .where(F.col("pos") <= k).drop("branch", "brk"))


def fallback_topk(pool_df: DataFrame, k: int) -> DataFrame:
    """R9 source: unfiltered top-k of the original query, derived from a pool whose per-group
    fetch is >= k (the union of per-group top-k contains the global top-k)."""
    w = Window.partitionBy("qid").orderBy("distance", "doc_id")
    return (dedup(pool_df.where(F.col("ord") == 0))
            .withColumn("pos", F.row_number().over(w).cast("bigint")).where(F.col("pos") <= k)
            .withColumn("kscore", F.col("distance")))


def with_fallback(merged: DataFrame, fallback: DataFrame, qids: DataFrame | None = None) -> DataFrame:
    """Questions with no hybrid result take the unfiltered top-k.  Both inputs are tagged
    and, per question, only the rows of the first non-empty branch survive (one window, no
    anti-join of ``merged`` against itself)."""
    u = merged.withColumn("_b", F.lit(0)).unionByName(fallback.select(*merged.columns).withColumn("_b", F.lit(1)))
    return u.withColumn("_m", F.min("_b").over(Window.partitionBy("qid"))).where(
        F.col("_b") == F.col("_m")).drop("_b", "_m")


def hybrid(pool_df: DataFrame, bonus: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """R4-R9 for final size k: (qid, doc_id, type, domain, distance, kscore, pos).
    ``bonus`` comes from ``keyword_bonus_table`` over the candidates of the largest k used."""
    cands = hybrid_candidates(pool_df, k)
    merged = hybrid_merge(keyword_rerank(cands, bonus), k)
    return with_fallback(merged, fallback_topk(pool_df, k), questions)


def attach_scores(chosen: DataFrame, scores: DataFrame) -> DataFrame:
    """Fill ``distance`` of already chosen docs from a score table by (qid, doc_id);
    docs without a score keep their own."""
    s = scores.select("qid", "doc_id", F.col("distance").alias("_d"))
    return chosen.join(s, ["qid", "doc_id"], "left").withColumn(
        "distance", F.coalesce(F.col("_d"), F.col("distance"))).drop("_d")


def search_similar(pool_df: DataFrame, k: int = 5, domain_order: DataFrame | None = None) -> DataFrame:
    """Plain search; per-domain top-k, de-duplicated, cut to k.

    Default ranks globally by distance.  With ``domain_order`` (domain, priority) the literal
    order is kept: domains in priority order, each domain's own top-k by distance."""
    p = pool_df.where(F.col("ord") == 0)
    wd = Window.partitionBy("qid", "domain").orderBy("distance", "doc_id")
    per_dom = p.groupBy("qid", "domain", "doc_id").agg(F.min("distance").alias("distance")) \
        .withColumn("drk", F.row_number().over(wd)).where(F.col("drk") <= k)
    if domain_order is None:
        w = Window.partitionBy("qid").orderBy("distance", "doc_id")
    else:
        per_dom = per_dom.join(F.broadcast(domain_order.select("domain", "priority")), "domain")
        w = Window.partitionBy("qid").orderBy("priority", "drk")
    first = Window.partitionBy("qid", "doc_id").orderBy(*(["distance", "domain"] if domain_order is None
                                                          else ["priority", "drk"]))
    uniq = per_dom.withColumn("_f", F.row_number().over(first)).where(F.col("_f") == 1).drop("_f")
    return uniq.withColumn("pos", F.row_number().over(w).cast("bigint")).where(F.col("pos") <= k)


def similarity(distance) -> F.Column:
    """K4 (clamped form): 1 - d/2 floored at 0; cosine similarity for unit vectors."""
    return F.greatest(F.lit(0.0), 1 - F.col(distance) / 2) if isinstance(distance, str) else \
        F.greatest(F.lit(0.0), 1 - distance / 2)


def boosted_topk(pool_df: DataFrame, domains: DataFrame, k: int, statute_boost: float = params.STATUTE_BOOST,
                 use_priority: bool = True) -> DataFrame:
    """Rank by similarity x weight; statutes x ``statute_boost``; domain weight
    ``1 + (5 - priority) / 10`` when ``use_priority`` (priority 1 weighs most)."""
    p = dedup(pool_df.where(F.col("ord") == 0))
    d = F.broadcast(domains.select("domain", "priority"))
    wgt = F.when(F.col("type") == "statute", F.lit(statute_boost)).otherwise(F.lit(1.0))
    if use_priority:
        wgt = wgt * (1 + (5 - F.col("priority")) / 10.0)
    s = p.join(d, "domain").withColumn("weighted", similarity("distance") * wgt)
    w = Window.partitionBy("qid").orderBy(F.col("weighted").desc(), F.col("doc_id"))
    return s.withColumn("pos", F.row_number().over(w).cast("bigint")).where(F.col("pos") <= k)


def similarity_threshold(corpus: DataFrame, questions: DataFrame, threshold: float = params.SIMILARITY_THRESHOLD,
                         exclude=("qid", "doc_id"), pivots: Quantiser | None = None, n_pivots: int = 64) -> DataFrame:
    """Every corpus row whose similarity 1 - d/2 reaches the threshold, by an exact range search over the whole corpus that
    skips what pivots rule out.  ``pivots`` are trained from a bounded sample where none are given; ``exclude`` (None: nothing) leaves
    out a question's own row."""
    rows = corpus.select("doc_id", "embedding")
    model = pivots or train(rows, n_pivots, code_bytes=0)
    found = within_pivots(rows, questions, 2 * (1 - threshold), model, exclude_own=exclude is not None)
    return found.withColumn("similarity", 1 - F.col("distance") / 2)


def search_written(spark: SparkSession, root: str, questions: DataFrame, k: int, types=None, domains=None,
                   exclude=("qid", "doc_id")) -> DataFrame:
    """R2 on the written index: exact top-k among the chunks of some types and domains (None: all).  The filters are on the
    index's folders, so only theirs are listed and read, and of them only ids and vectors."""
    index = open_index(spark, root)
    for column, values in (("type", types), ("domain", domains)):
        if values is not None:
            index = index.where(F.col(column).isin(list(values)))
    return knn(index.select("doc_id", "embedding"), questions, k, exclude=exclude)
