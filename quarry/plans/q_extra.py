"""Driver queries: expansion fan-out with text embeddings (G4/G5 -> M1 -> R4/R5), disabled
rerank (K2), prompt assembly (A3) and the article spot check (T17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry import params
from quarry.operators import answer as A
from quarry.operators import rank as K
from quarry.operators import retrieve as R
from quarry.operators import segment as G
from quarry.operators.models import TOKEN_PATTERN, hashed_embedding, hashed_embeddings
from quarry.operators.scope import expand_queries
from quarry.plans import adapters as ad
from quarry.plans import q_answer as QA
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register
from quarry.plans.q_text import _SEG

DIM = 64


def _hashed_ctes(name: str, src: str, keep: str, text: str) -> list[str]:
    """M1 twin: ``name`` = keep columns + ``embedding`` (hashed bag of words of ``text``)."""
    return [
        f"{name}_t AS (SELECT {keep}, list_filter(regexp_split_to_array(lower({text}), '{TOKEN_PATTERN}'), "
        f"lambda t: length(t) > 0) AS toks FROM {src})",
        f"{name}_b AS (SELECT {keep}, list_transform(toks, lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT) % {DIM})"
        f" AS bks FROM {name}_t)",
        f"{name}_c AS (SELECT {keep}, list_transform(range({DIM}), lambda i: CAST(len(list_filter(bks, lambda b: b = i))"
        f" AS DOUBLE)) AS cnt FROM {name}_b)",
        f"{name} AS (SELECT {keep}, CASE WHEN nrm > 0 THEN list_transform(cnt, lambda x: x / nrm) ELSE cnt END AS embedding"
        f" FROM (SELECT *, sqrt(list_sum(list_transform(cnt, lambda x: x * x))) AS nrm FROM {name}_c))",
    ]


def _expand_sql(src: str = "benchmark_q") -> str:
    hits = ", ".join(f"CASE WHEN contains(question, {S.q(kw)}) THEN {S.lst(ex)} ELSE []::VARCHAR[] END"
                     for kw, ex in L.LATIN_EXPANSIONS)
    tmpl = ", ".join("'" + t.replace("'", "''").replace("{q}", "' || question || '") + "'" for t in L.LATIN_TEMPLATES)
    return f"""exp AS (
  SELECT qid, CAST(u.i - 1 AS BIGINT) AS ord, u.x AS query_text FROM (
    SELECT qid, unnest(list_transform(lst, lambda x, i: {{'x': x, 'i': i}})) AS u FROM (
      SELECT qid, [question] || CASE WHEN len(flatten([{hits}])) > 0 THEN flatten([{hits}]) ELSE [{tmpl}] END AS lst
      FROM {src}))
  WHERE u.i <= {params.MAX_EXPANSIONS})"""


_FETCH = QA.FETCH
_EXPANDED_SQL = S.with_(
    S.CORPUS, S.QUESTIONS, QA._GATE, "benchmark_q AS (SELECT qid, question FROM gate WHERE dd IS NULL)",
    _expand_sql(), *_hashed_ctes("hq", "exp", "qid, ord", "query_text"),
    *_hashed_ctes("hc", "corpus", "doc_id, type, domain", "content"),
    f"""xpool AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY qid, ord, domain, type ORDER BY distance, doc_id) AS rk FROM (
      SELECT q.qid, q.ord, c.doc_id, c.type, c.domain,
             list_sum(list_transform(list_zip(q.embedding, c.embedding), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS distance
      FROM hq q, hc c WHERE c.doc_id <> q.qid))
  WHERE rk <= {_FETCH})""") + """
SELECT qid, doc_id, first(type) AS type, round(min(distance), 6) AS distance
FROM xpool WHERE (type = 'statute' AND rk <= 18) OR (type = 'case' AND ord = 0 AND rk <= 18)
GROUP BY qid, doc_id"""


@register("knn_expanded", _EXPANDED_SQL)
def q_knn_expanded(spark, sf):
    """R4/R5 with expansions: the first 3 expanded queries of each in-scope question and the
    chunk texts embedded with the default text embedding; statutes from every expansion,
    cases from the original, per (domain, type) over-fetch, de-duplicated by min distance."""
    q, c, inq = QA._inputs(spark, sf)
    exp = expand_queries(inq.select("qid", "question"), L.LATIN_EXPANSIONS, L.LATIN_TEMPLATES,
                         max_expansions=params.MAX_EXPANSIONS)
    qrows = exp.select("qid", "ord", hashed_embedding(F.col("query_text"), DIM).alias("qvec"))
    ch = hashed_embeddings(c.select("doc_id", "content"), "doc_id", "content", DIM).select("doc_id", "embedding") \
        .join(c.select("doc_id", "type", "domain"), "doc_id")
    pool = R.pool(ch, qrows, _FETCH)
    d = R.hybrid_candidates(pool, 16)
    return d.select("qid", "doc_id", "type", F.round("distance", 6).alias("distance"))


@register("rerank_disabled", S.with_(*QA._PREFIX, *QA._M16) + """
SELECT qid, doc_id, CAST(pos AS BIGINT) AS rpos, round(1 - least(distance / 2, 1.0::DOUBLE), 6) AS rscore, true AS is_relevant
FROM m16 WHERE pos <= 3""")
def q_rerank_disabled(spark, sf):
    """K2: rerank disabled or failed — original order, score 1 - min(d/2, 1), all relevant."""
    q, c, inq = QA._inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    p = R.pool(c, qrows, _FETCH)
    d16 = R.hybrid(p, R.keyword_bonus_table(R.hybrid_candidates(p, 16), inq, c, QA.WORDS), inq, 16)
    r = K.passthrough_rerank(d16, top_k=params.RERANK_TOP_K)
    return r.select("qid", "doc_id", F.col("rpos").cast("bigint").alias("rpos"), F.round("rscore", 6).alias("rscore"),
                    "is_relevant")


PROMPT = "Context:\n{context}\n\nQuestion:\n{question}\n\nHistory:\n{history}"


@register("prompt_text", S.with_(*QA._PREFIX, *QA._M16, *QA._M8, *QA._POLICY) + f"""
SELECT g.qid, 'Context:' || chr(10) || ctx.context || chr(10) || chr(10) || 'Question:' || chr(10) || g.question
       || chr(10) || chr(10) || 'History:' || chr(10) || '{A.NO_HISTORY}' AS prompt
FROM inq g JOIN (
  SELECT f.qid, string_agg('[来源' || CAST(f.pos AS VARCHAR) || '] ' ||
     CASE WHEN f.type = 'statute' THEN '【法条】' || coalesce(d.source, '{A.UNKNOWN_SOURCE}') || ' ' || coalesce(d.article, '') || chr(10) || d.content
          ELSE '【案例】' || coalesce(d.source, '{A.UNKNOWN_SOURCE}') || '（' || coalesce(d.accusation, '') || '）' || chr(10) || d.content END,
     chr(10) || chr(10) ORDER BY f.pos) AS context
  FROM final f JOIN corpus d ON f.doc_id = d.doc_id GROUP BY f.qid) ctx ON g.qid = ctx.qid""")
def q_prompt_text(spark, sf):
    """A3: the prompt from the context block, the question and the history text (a fresh
    session per question: no history)."""
    q, c, inq = QA._inputs(spark, sf)
    ctx = A.context_block(QA.cited(spark, sf, ["content", "source", "article", "accusation"], (q, c, inq)))
    j = inq.select("qid", "question").join(ctx, "qid")
    return j.select("qid", A.prompt(F.col("context"), F.col("question"), F.lit(A.NO_HISTORY), PROMPT).alias("prompt"))


SPOT = ["第1条", "第5条", "第12条"]


@register("spot_check", _SEG + f"""
SELECT file_id, article, substr(content, 1, 60) || '...' AS preview FROM seg WHERE article IN ({", ".join(S.q(a) for a in SPOT)})""")
def q_spot_check(spark, sf):
    """Named articles with a 60-character preview."""
    s = G.segment_articles(ad.statute_files(spark, sf))
    return s.where(F.col("article").isin(SPOT)).select(
        "file_id", "article", F.concat(F.substring("content", 1, 60), F.lit("...")).alias("preview"))
