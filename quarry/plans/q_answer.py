"""Driver queries: the answer pipeline (A9) and its stages."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry import params
from quarry.functions.text import cut
from quarry.operators import answer as A
from quarry.operators import rank as K
from quarry.operators import retrieve as R
from quarry.operators.scope import scope_gate
from quarry.plans import adapters as ad
from quarry.plans import pipeline as P
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register

# Driver parameters: the generated vectors are random, so relevance is low (statute mean
# 0.05-0.24); the floor is set inside that range so that both statuses occur.
MIN_REL = 0.14
WORDS = L.LATIN_RERANK_WORDS
GROUPS = L.LATIN_SCOPE_GROUPS
FETCH = R.fetch_size(P.POOL_K)


def _inputs(spark, sf):
    q, c = ad.questions(spark, sf), ad.corpus(spark, sf)
    inq = scope_gate(q, GROUPS).where(~F.col("out_of_scope"))
    return q, c, inq


def _final(spark, sf):
    q, c, inq = _inputs(spark, sf)
    return P.retrieve_final(inq, c, ad.judge_scores(spark, sf), WORDS), c, q


def cited(spark, sf, cols, inputs=None):
    """The final documents of every question with columns of the corpus."""
    q, c, inq = inputs or _inputs(spark, sf)
    f, n = P.retrieve_final(inq, c, ad.judge_scores(spark, sf), WORDS, with_count=True)
    f = f.persist(StorageLevel.MEMORY_AND_DISK)
    return R.attach(f, c, cols, est_rows=n * params.RETRIEVAL_TOP_K)


# ---- SQL: shared prefix ------------------------------------------------------------------
_GATE = f"""gate AS (SELECT qid, question, qvec, {S.scope_case(GROUPS, 'question')} AS dd FROM questions)"""
_INQ = "inq AS (SELECT qid, question, qvec FROM gate WHERE dd IS NULL)"
_PREFIX = [S.CORPUS, S.QUESTIONS, S.JUDGE, _GATE, _INQ, S.pool_cte(FETCH)]
_M16 = S.hybrid_ctes(16, WORDS)
_M8 = S.hybrid_ctes(8, WORDS)
_POLICY = [
    "n16 AS (SELECT qid, count(*) AS n FROM m16 GROUP BY qid)",
    """rr AS (
  SELECT m.qid, m.doc_id, m.type, m.domain, m.distance, m.pos,
         coalesce(j.score, 5.0) / 10.0 AS rscore,
         coalesce(j.relevant, true) AND coalesce(j.score, 5.0) / 10.0 >= 0.4 AS is_rel
  FROM m16 m JOIN n16 ON m.qid = n16.qid LEFT JOIN judge j ON m.doc_id = j.doc_id
  WHERE n16.n > 3 AND m.pos <= 5)""",
    """rr3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rscore DESC, pos) AS rpos
            FROM rr) WHERE rpos <= 3)""",
    "surv AS (SELECT * FROM rr3 WHERE is_rel)",
    "ok AS (SELECT qid FROM surv GROUP BY qid HAVING count(*) >= 3)",
    """final AS (
  SELECT qid, doc_id, type, domain, distance, rpos AS pos FROM surv WHERE qid IN (SELECT qid FROM ok)
  UNION ALL
  SELECT qid, doc_id, type, domain, distance, pos FROM m8
  WHERE qid IN (SELECT qid FROM n16 WHERE n > 3) AND qid NOT IN (SELECT qid FROM ok)
  UNION ALL
  SELECT qid, doc_id, type, domain, distance, pos FROM m16
  WHERE qid IN (SELECT qid FROM n16 WHERE n <= 3) AND pos <= 8)""",
]
_STATS = """stats AS (
  SELECT qid, count(*) AS n_docs,
         avg(CASE WHEN type = 'statute' THEN 1 - least(distance / 2, 1.0::DOUBLE) END) AS statute_relevance,
         max(greatest(0.0::DOUBLE, 1 - distance / 2)) AS max_rel,
         avg(greatest(0.0::DOUBLE, 1 - distance / 2)) AS avg_rel,
         max(CASE WHEN type = 'statute' THEN 1 ELSE 0 END) AS has_statute
  FROM final GROUP BY qid)"""
_CONF = """CASE WHEN coalesce(s.n_docs, 0) > 0 THEN round(least(0.4::DOUBLE * s.max_rel + 0.4::DOUBLE * s.avg_rel
        + 0.2::DOUBLE * least(coalesce(s.n_docs, 0) / 8.0::DOUBLE, 1.0::DOUBLE) + 0.1::DOUBLE * s.has_statute,
        0.95::DOUBLE), 2) ELSE 0.0 END"""


def _label(alias: str = "d") -> str:
    a = alias
    return f"""(CASE WHEN {a}.type = 'statute' THEN coalesce({a}.source, '{A.UNKNOWN_SOURCE}') ||
      CASE WHEN coalesce({a}.article, '') <> '' THEN '(' || {a}.article || ')' ELSE '' END
   WHEN {a}.type = 'case' THEN coalesce({a}.source, '{A.UNKNOWN_SOURCE}') ||
      CASE WHEN coalesce({a}.accusation, '') <> '' THEN '【' || {a}.accusation || '】' ELSE '' END
   ELSE coalesce({a}.source, '{A.UNKNOWN_SOURCE}') END)"""


def _cut(expr: str, n: int) -> str:
    return f"(CASE WHEN length({expr}) > {n} THEN substr({expr}, 1, {n}) || '...' ELSE {expr} END)"


_STREAM_POLICY = [
    """rr AS (
  SELECT m.qid, m.doc_id, m.type, m.domain, m.distance, coalesce(j.relevant, true) AND coalesce(j.score, 5.0) / 10.0 >= 0.4 AS is_rel,
         row_number() OVER (PARTITION BY m.qid ORDER BY coalesce(j.score, 5.0) / 10.0 DESC, m.pos) AS rpos
  FROM m16 m LEFT JOIN judge j ON m.doc_id = j.doc_id WHERE m.pos <= 10)""",
    """final AS (
  SELECT qid, doc_id, type, domain, distance, row_number() OVER (PARTITION BY qid ORDER BY rpos) AS pos
  FROM rr WHERE rpos <= 8 AND is_rel)""",
]


def _answer_sql(policy) -> str:
    return S.with_(*_PREFIX, *_M16, *_M8, *policy, _STATS, f"""lists AS (
  SELECT f.qid, string_agg(CAST(f.doc_id AS VARCHAR), ',' ORDER BY f.pos) AS ids,
         string_agg({_label('d')}, ' | ' ORDER BY f.pos) AS labels,
         min_by({_cut('d.content', P.ANSWER_CHARS)}, f.pos) AS excerpt
  FROM final f JOIN corpus d ON f.doc_id = d.doc_id GROUP BY f.qid)""", f"""res AS (
  SELECT g.qid, g.dd IS NOT NULL AS oos, coalesce(g.dd, '') AS detected_domain,
         coalesce(s.n_docs, 0) AS n, s.statute_relevance, {_CONF} AS conf, l.ids, l.labels, l.excerpt
  FROM gate g LEFT JOIN stats s ON g.qid = s.qid LEFT JOIN lists l ON g.qid = l.qid)""") + f"""
SELECT qid,
  CASE WHEN oos THEN 'out_of_scope' WHEN n = 0 OR statute_relevance IS NULL OR statute_relevance < {MIN_REL}
       THEN 'low_relevance' ELSE 'answered' END AS status,
  detected_domain,
  CAST(CASE WHEN oos THEN 0 ELSE n END AS BIGINT) AS n_docs,
  CASE WHEN oos THEN '' ELSE coalesce(ids, '') END AS doc_ids,
  CASE WHEN oos THEN 0.1 WHEN n = 0 OR statute_relevance IS NULL OR statute_relevance < {MIN_REL} THEN 0.2
       ELSE conf END AS confidence,
  CASE WHEN oos OR n = 0 OR statute_relevance IS NULL OR statute_relevance < {MIN_REL} THEN true
       ELSE conf < 0.35 OR n = 0 END AS is_uncertain,
  CASE WHEN oos THEN format({S.q(A.REFUSAL_TEMPLATE.replace('{domain}', '{}'))}, detected_domain)
       WHEN n = 0 OR statute_relevance IS NULL OR statute_relevance < {MIN_REL} THEN {S.q(A.LOW_RELEVANCE_ANSWER)}
       ELSE excerpt END AS answer,
  CASE WHEN oos OR n = 0 OR statute_relevance IS NULL OR statute_relevance < {MIN_REL} THEN ''
       ELSE labels END AS citations
FROM res"""


_ANSWER_SQL, _STREAM_SQL = _answer_sql(_POLICY), _answer_sql(_STREAM_POLICY)


# the texts of an answer's citations, for queries that start with ``ans AS (_ANSWER_SQL)``
_FINAL_TEXTS = f"""texts AS (
  SELECT qid, list({_cut('d.text', params.CITATION_CHARS)} ORDER BY pos) AS doc_texts
  FROM (SELECT qid, unnest(string_split(doc_ids, ',')) AS id, generate_subscripts(string_split(doc_ids, ','), 1) AS pos
        FROM ans WHERE doc_ids <> '') a JOIN documents d ON CAST(d.doc_id AS VARCHAR) = a.id GROUP BY qid)"""


@register("answer_pipeline", _ANSWER_SQL)
def answer_pipeline(spark, sf):
    return P.answer_pipeline(ad.questions(spark, sf), ad.corpus(spark, sf), ad.judge_scores(spark, sf),
                             scope_groups=GROUPS, rerank_words=WORDS, min_relevance=MIN_REL)


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


@register("knn_fanout", S.with_(*_PREFIX) + "SELECT qid, ord, domain, type, doc_id, rk, round(distance, 6) AS distance FROM pool")
def knn_fanout(spark, sf):
    q, c, inq = _inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    p = R.pool(c, qrows, FETCH)
    return p.select("qid", "ord", "domain", "type", "doc_id", "rk", _r("distance"))


@register("knn_dedup", S.with_(*_PREFIX, *_M16) +
          "SELECT qid, doc_id, type, round(distance, 6) AS distance FROM cand16")
def knn_dedup(spark, sf):
    q, c, inq = _inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    d = R.hybrid_candidates(R.pool(c, qrows, FETCH), 16)
    return d.select("qid", "doc_id", "type", _r("distance"))


@register("keyword_rerank", S.with_(*_PREFIX, *_M16) +
          "SELECT qid, doc_id, type, round(kscore, 6) AS kscore FROM sc16")
def keyword_rerank(spark, sf):
    q, c, inq = _inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    d = R.hybrid_candidates(R.pool(c, qrows, FETCH), 16)
    return R.keyword_rerank(d, R.keyword_bonus_table(d, inq, c, WORDS)).select("qid", "doc_id", "type", _r("kscore"))


@register("hybrid_topk", S.with_(*_PREFIX, *_M8) +
          "SELECT qid, doc_id, type, pos, round(distance, 6) AS distance FROM m8")
def hybrid_topk(spark, sf):
    q, c, inq = _inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    p = R.pool(c, qrows, FETCH)
    bonus = R.keyword_bonus_table(R.hybrid_candidates(p, 8), inq, c, WORDS)
    return R.hybrid(p, bonus, inq, 8).select("qid", "doc_id", "type", "pos", _r("distance"))


# Fallback: the hybrid branches restricted to one domain's statutes and cases of another
# domain's type never both exist for questions whose pool is filtered to 'labor' cases only.
@register("hybrid_fallback", S.with_(S.CORPUS, S.QUESTIONS, _GATE, _INQ, S.pool_cte(FETCH).replace(
    "FROM {qtab} q, corpus c WHERE c.doc_id <> q.qid".format(qtab="inq"),
    "FROM inq q, corpus c WHERE c.doc_id <> q.qid AND c.type = 'case'"),
    *[c.replace("ord = 0 AND rk", "ord = 1 AND rk") for c in S.hybrid_ctes(8, WORDS)]) +
          "SELECT qid, doc_id, type, pos, round(distance, 6) AS distance FROM m8")
def hybrid_fallback(spark, sf):
    """With no statutes in the index and cases taken from a non-existent expansion, both
    hybrid branches are empty and every question falls back to the unfiltered top-k."""
    q, c, inq = _inputs(spark, sf)
    c = c.where(F.col("type") == "case")
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    p = R.pool(c, qrows, FETCH)
    cands = R.dedup(p.where(((F.col("type") == "statute") & (F.col("rk") <= 10)) |
                            ((F.col("type") == "case") & (F.col("ord") == 1) & (F.col("rk") <= 10))))
    merged = R.hybrid_merge(R.keyword_rerank(cands, R.keyword_bonus_table(cands, inq, c, WORDS)), 8)
    out = R.with_fallback(merged, R.fallback_topk(p, 8), inq)
    return out.select("qid", "doc_id", "type", "pos", _r("distance"))


@register("judge_rerank", S.with_(*_PREFIX, *_M16, """jr AS (
  SELECT m.qid, m.doc_id, m.pos, coalesce(j.score, 5.0) / 10.0 AS rscore,
         coalesce(j.relevant, true) AND coalesce(j.score, 5.0) / 10.0 >= 0.4 AS is_relevant
  FROM m16 m LEFT JOIN judge j ON m.doc_id = j.doc_id WHERE m.pos <= 10)""") + """
SELECT qid, doc_id, pos, rscore, is_relevant, rpos FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY rscore DESC, pos) AS BIGINT) AS rpos FROM jr)
WHERE rpos <= 3""")
def judge_rerank(spark, sf):
    q, c, inq = _inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    p = R.pool(c, qrows, FETCH)
    d16 = R.hybrid(p, R.keyword_bonus_table(R.hybrid_candidates(p, 16), inq, c, WORDS), inq, 16)
    return K.judge_rerank(d16, ad.judge_scores(spark, sf)).select("qid", "doc_id", "pos", "rscore", "is_relevant",
                                                                   "rpos")


@register("rerank_policy", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY) +
          "SELECT qid, doc_id, type, CAST(pos AS BIGINT) AS pos, round(distance, 6) AS distance FROM final")
def rerank_policy(spark, sf):
    f, _, _ = _final(spark, sf)
    return f.select("qid", "doc_id", "type", F.col("pos").cast("bigint").alias("pos"), _r("distance"))


@register("relevance_gate", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY, _STATS) + f"""
SELECT qid, CAST(n_docs AS BIGINT) AS n_docs, round(statute_relevance, 6) AS statute_relevance,
       n_docs = 0 OR statute_relevance IS NULL OR statute_relevance < {MIN_REL} AS low_relevance FROM stats""")
def relevance_gate(spark, sf):
    f, _, _ = _final(spark, sf)
    s = K.doc_stats(f)
    return s.select("qid", F.col("n_docs").cast("bigint").alias("n_docs"), _r("statute_relevance"),
                    K.low_relevance(s, MIN_REL).alias("low_relevance"))


@register("confidence", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY, _STATS) + f"""
SELECT s.qid, {_CONF} AS confidence, ({_CONF}) < 0.35 OR s.n_docs = 0 AS is_uncertain FROM stats s""")
def confidence(spark, sf):
    f, _, _ = _final(spark, sf)
    s = K.doc_stats(f)
    conf = K.confidence()
    return s.select("qid", conf.alias("confidence"), K.is_uncertain(conf, F.col("n_docs")).alias("is_uncertain"))


# Driver cut points inside the observed confidence range (0.2-0.6).
BAND_HIGH, BAND_MEDIUM = 0.45, 0.3


@register("confidence_band", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY, _STATS) + f"""
SELECT qid, CASE WHEN c >= {BAND_HIGH} THEN 'high' WHEN c >= {BAND_MEDIUM} THEN 'medium' ELSE 'low' END AS band
FROM (SELECT s.qid, {_CONF} AS c FROM stats s)""")
def confidence_band(spark, sf):
    f, _, _ = _final(spark, sf)
    s = K.doc_stats(f)
    return s.select("qid", K.confidence_band(K.confidence(), BAND_HIGH, BAND_MEDIUM).alias("band"))


@register("check_policy", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY, _STATS) + f"""
SELECT g.qid, CASE WHEN g.dd IS NOT NULL THEN false
                   ELSE coalesce(s.n_docs, 0) < 2 OR s.statute_relevance IS NULL OR s.statute_relevance < {MIN_REL}
              END AS do_check
FROM gate g LEFT JOIN stats s ON g.qid = s.qid""")
def check_policy(spark, sf):
    q, c, inq = _inputs(spark, sf)
    f = P.retrieve_final(inq, c, ad.judge_scores(spark, sf), WORDS)
    g = scope_gate(q, GROUPS).select("qid", "out_of_scope").join(K.doc_stats(f), "qid", "left")
    pol = K.check_policy(F.col("out_of_scope"), F.col("n_docs"), K.low_relevance(g, MIN_REL))
    return g.select("qid", pol["check"].alias("do_check"))


@register("citations", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY) + f"""
SELECT f.qid, CAST(f.pos AS BIGINT) AS pos, {_label('d')} AS source, f.type AS doc_type,
       {_cut('d.content', 200)} AS content, round(f.distance, 6) AS relevance_score
FROM final f JOIN corpus d ON f.doc_id = d.doc_id""")
def citations(spark, sf):
    docs = cited(spark, sf, ["content", "source", "article", "accusation"])
    cs = A.citations(docs).select("qid", F.explode("citations").alias("c"))
    return cs.select("qid", F.col("c.pos").cast("bigint").alias("pos"), F.col("c.source").alias("source"),
                     F.col("c.doc_type").alias("doc_type"), F.col("c.content").alias("content"),
                     F.round(F.col("c.relevance_score"), 6).alias("relevance_score"))


@register("context_block", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY) + f"""
SELECT f.qid, string_agg('[来源' || CAST(f.pos AS VARCHAR) || '] ' ||
   CASE WHEN f.type = 'statute' THEN '【法条】' || coalesce(d.source, '{A.UNKNOWN_SOURCE}') || ' ' || coalesce(d.article, '') || chr(10) || d.content
        ELSE '【案例】' || coalesce(d.source, '{A.UNKNOWN_SOURCE}') || '（' || coalesce(d.accusation, '') || '）' || chr(10) || d.content END,
   chr(10) || chr(10) ORDER BY f.pos) AS context
FROM final f JOIN corpus d ON f.doc_id = d.doc_id GROUP BY f.qid""")
def context_block(spark, sf):
    docs = cited(spark, sf, ["content", "source", "article", "accusation"])
    return A.context_block(docs)


@register("answers_extractive", S.with_(*_PREFIX, *_M16, *_M8, *_POLICY) + f"""
SELECT f.qid, {_cut('d.content', P.ANSWER_CHARS)} AS answer
FROM final f JOIN corpus d ON f.doc_id = d.doc_id WHERE f.pos = 1""")
def answers_extractive(spark, sf):
    """M4 default generator: the answer is the top-ranked document's excerpt."""
    return cited(spark, sf, ["content"]).where(F.col("pos") == 1).select("qid", cut("content", P.ANSWER_CHARS).alias("answer"))
