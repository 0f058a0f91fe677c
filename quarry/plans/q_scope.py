"""Driver queries: scope gate, model verdicts, expansion, reply parsing, batch plan and
retrieval variants (G1-G6, M2, M5, R10-R13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry import params
from quarry.functions import json_reply as J
from quarry.operators import retrieve as R
from quarry.operators import scope as G
from quarry.operators.models import batch_plan
from quarry.plans import adapters as ad
from quarry.plans import q_answer as QA
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register, round6


@register("scope_gate", S.with_(S.QUESTIONS, QA._GATE) +
          "SELECT qid, dd IS NOT NULL AS out_of_scope, coalesce(dd, '') AS detected_domain FROM gate")
def q_scope_gate(spark, sf):
    return G.scope_gate(ad.questions(spark, sf), L.LATIN_SCOPE_GROUPS).select("qid", "out_of_scope",
                                                                               "detected_domain")


_VERDICT_SQL = f"""verdict AS (
  SELECT qid, reply, ok,
         CASE WHEN ok THEN coalesce(json_extract_string(span, '$.domain'), '刑法') = '刑法' ELSE true END AS is_in_scope,
         CASE WHEN ok THEN coalesce(TRY_CAST(json_extract(span, '$.confidence') AS DOUBLE), 0.5) ELSE 0.5 END
           AS verdict_confidence,
         CASE WHEN ok THEN coalesce(json_extract_string(span, '$.domain'), '刑法') ELSE '未知' END AS verdict_domain
  FROM (SELECT qid, reply, {S.json_span_sql('reply')} AS span, {S.parsed_ok_sql('reply')} AS ok FROM replies))"""


@register("scope_verdict", S.with_(S.SCOPE_REPLIES, _VERDICT_SQL) +
          "SELECT qid, is_in_scope, verdict_confidence, verdict_domain FROM verdict")
def q_scope_verdict(spark, sf):
    v = G.scope_verdict(ad.scope_replies(spark, sf))
    return v.select("qid", "is_in_scope", "verdict_confidence", "verdict_domain")


@register("parse_reply", S.with_(S.SCOPE_REPLIES) + f"""
SELECT qid, {S.parsed_ok_sql('reply')} AS parsed,
       CASE WHEN {S.parsed_ok_sql('reply')} THEN json_extract_string({S.json_span_sql('reply')}, '$.domain') END AS domain,
       CASE WHEN {S.parsed_ok_sql('reply')} THEN TRY_CAST(json_extract({S.json_span_sql('reply')}, '$.confidence') AS DOUBLE) END AS confidence
FROM replies""")
def q_parse_reply(spark, sf):
    """M5: outermost {...} span across lines, parsed; fields null when absent or unparseable."""
    r = ad.scope_replies(spark, sf).withColumn("_v", J.parsed(F.col("reply")))
    return r.select("qid", F.col("_v").isNotNull().alias("parsed"),
                    J.field(F.col("_v"), "$.domain", "string").alias("domain"),
                    J.field(F.col("_v"), "$.confidence", "double").alias("confidence"))


@register("scope_combined", S.with_(S.QUESTIONS, QA._GATE, S.SCOPE_REPLIES, _VERDICT_SQL) + """
SELECT g.qid,
       g.dd IS NOT NULL OR (NOT coalesce(v.is_in_scope, true) AND coalesce(v.verdict_confidence, 0.5) > 0.7) AS out_of_scope,
       CASE WHEN g.dd IS NOT NULL THEN g.dd
            WHEN NOT coalesce(v.is_in_scope, true) AND coalesce(v.verdict_confidence, 0.5) > 0.7 THEN v.verdict_domain
            ELSE '' END AS detected_domain
FROM gate g LEFT JOIN verdict v ON g.qid = v.qid""")
def q_scope_combined(spark, sf):
    """Keyword gate, else a confident out-of-scope model verdict; questions without a
    reply keep the failure default (in scope, 0.5)."""
    g = G.scope_gate(ad.questions(spark, sf), L.LATIN_SCOPE_GROUPS)
    v = G.scope_verdict(ad.scope_replies(spark, sf)).select("qid", "is_in_scope", "verdict_confidence",
                                                            "verdict_domain")
    j = g.join(v, "qid", "left").fillna({"is_in_scope": True, "verdict_confidence": 0.5, "verdict_domain": ""})
    return G.combine_scope(j).select("qid", "out_of_scope", "detected_domain")


def _expand_sql() -> str:
    hits = ", ".join(f"CASE WHEN contains(question, {S.q(kw)}) THEN {S.lst(ex)} ELSE []::VARCHAR[] END"
                     for kw, ex in L.LATIN_EXPANSIONS)
    tmpl = ", ".join("'" + t.replace("'", "''").replace("{q}", "' || question || '") + "'" for t in L.LATIN_TEMPLATES)
    return f"""SELECT qid, CAST(u.i - 1 AS BIGINT) AS ord, u.x AS query_text FROM (
  SELECT qid, unnest(list_transform(lst, lambda x, i: {{'x': x, 'i': i}})) AS u FROM (
    SELECT qid, [question] || CASE WHEN len(flatten([{hits}])) > 0 THEN flatten([{hits}]) ELSE [{tmpl}] END AS lst
    FROM benchmark_q))"""


@register("expand_queries", "WITH benchmark_q AS (SELECT item_id AS qid, text AS question FROM benchmark)\n" +
          _expand_sql())
def q_expand_queries(spark, sf):
    b = ad.table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    return G.expand_queries(b, L.LATIN_EXPANSIONS, L.LATIN_TEMPLATES).select("qid", "ord", "query_text")


@register("refusal_text", S.with_(S.QUESTIONS, QA._GATE) + """
SELECT qid, format('Sorry, your question concerns the {} domain, which this service does not cover. '
                   || 'Questions on criminal law are welcome.', dd) AS answer FROM gate WHERE dd IS NOT NULL""")
def q_refusal_text(spark, sf):
    """The refusal template filled with the detected domain."""
    from quarry.operators.answer import REFUSAL_TEMPLATE
    g = G.scope_gate(ad.questions(spark, sf), L.LATIN_SCOPE_GROUPS).where(F.col("out_of_scope"))
    return g.select("qid", G.refusal("detected_domain", REFUSAL_TEMPLATE).alias("answer"))


_BATCH_SQL = S.with_(S.CORPUS) + f"""
SELECT CAST(b AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(length(content)) AS BIGINT) AS n_chars,
       greatest({params.EMBED_MIN_SLEEP_S}::DOUBLE, 60.0::DOUBLE / {params.EMBED_RPM},
                sum(length(content)) / {float(params.EMBED_TPM)}::DOUBLE * 60.0::DOUBLE) AS wait_s
FROM (SELECT content, (row_number() OVER (ORDER BY doc_id) - 1) // {params.EMBED_BATCH_SIZE} AS b FROM corpus)
GROUP BY b"""


@register("batch_plan", S.round6(_BATCH_SQL, ["wait_s"]))
def q_batch_plan(spark, sf):
    return round6(batch_plan(ad.corpus(spark, sf), order_col="doc_id"), ["wait_s"])


# ---- retrieval variants over the k=16 pool ---------------------------------------------------
def _pool(spark, sf):
    q, c, inq = QA._inputs(spark, sf)
    qrows = inq.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    return R.pool(c, qrows, QA.FETCH)


@register("attach_scores", S.with_(*QA._PREFIX, *QA._M16, *QA._M8, *QA._POLICY) + """
SELECT f.qid, f.doc_id, round(coalesce(p.distance, f.distance), 6) AS distance, p.doc_id IS NOT NULL AS rescored
FROM final f LEFT JOIN (SELECT qid, doc_id, min(distance) AS distance FROM pool WHERE type = 'case' GROUP BY qid, doc_id) p
  ON f.qid = p.qid AND f.doc_id = p.doc_id""")
def q_attach_scores(spark, sf):
    """Scores of already chosen docs re-attached by doc_id from a case-only search."""
    final, _, _ = QA._final(spark, sf)
    scores = R.dedup(_pool(spark, sf).where(F.col("type") == "case"))
    s = scores.select("qid", "doc_id", F.lit(True).alias("rescored"))
    out = R.attach_scores(final, scores).join(s, ["qid", "doc_id"], "left")
    return out.select("qid", "doc_id", F.round("distance", 6).alias("distance"),
                      F.coalesce(F.col("rescored"), F.lit(False)).alias("rescored"))


@register("search_similar", S.with_(*QA._PREFIX) + """
SELECT qid, doc_id, CAST(pos AS BIGINT) AS pos, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, doc_id) AS pos FROM (
    SELECT * FROM (SELECT qid, domain, doc_id, distance,
                          row_number() OVER (PARTITION BY qid, domain ORDER BY distance, doc_id) AS drk
                   FROM pool WHERE ord = 0) WHERE drk <= 5))
WHERE pos <= 5""")
def q_search_similar(spark, sf):
    s = R.search_similar(_pool(spark, sf), k=5)
    return s.select("qid", "doc_id", "pos", F.round("distance", 6).alias("distance"))


@register("search_domain_order", S.with_(*QA._PREFIX) + """
SELECT qid, doc_id, CAST(pos AS BIGINT) AS pos, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY priority, drk) AS pos FROM (
    SELECT *, CASE domain WHEN 'criminal' THEN 1 WHEN 'civil' THEN 2 WHEN 'commercial' THEN 3
                          WHEN 'administrative' THEN 4 ELSE 5 END AS priority
    FROM (SELECT qid, domain, doc_id, distance,
                 row_number() OVER (PARTITION BY qid, domain ORDER BY distance, doc_id) AS drk
          FROM pool WHERE ord = 0) WHERE drk <= 5))
WHERE pos <= 5""")
def q_search_domain_order(spark, sf):
    """R11 literal mode: per-domain top-k concatenated in domain order, cut to k."""
    s = R.search_similar(_pool(spark, sf), k=5, domain_order=ad.domains(spark))
    return s.select("qid", "doc_id", "pos", F.round("distance", 6).alias("distance"))


@register("boosted_topk", S.with_(*QA._PREFIX) + f"""
SELECT qid, doc_id, CAST(pos AS BIGINT) AS pos, round(weighted, 6) AS weighted FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY weighted DESC, doc_id) AS pos FROM (
    SELECT qid, doc_id, greatest(0.0::DOUBLE, 1 - distance / 2)
           * ((CASE WHEN type = 'statute' THEN {params.STATUTE_BOOST}::DOUBLE ELSE 1.0::DOUBLE END)
              * (1 + CAST(5 - priority AS DOUBLE) / 10.0::DOUBLE)) AS weighted
    FROM (SELECT qid, doc_id, min(distance) AS distance, first(type) AS type, first(domain) AS domain
          FROM pool WHERE ord = 0 GROUP BY qid, doc_id) p
    JOIN (SELECT * FROM (VALUES ('criminal', 1), ('civil', 2), ('commercial', 3), ('administrative', 4), ('labor', 5))
          AS t(domain, priority)) d ON p.domain = d.domain))
WHERE pos <= 8""")
def q_boosted_topk(spark, sf):
    b = R.boosted_topk(_pool(spark, sf), ad.domains(spark), 8)
    return b.select("qid", "doc_id", "pos", F.round("weighted", 6).alias("weighted"))


@register("similarity_threshold", S.with_(S.CORPUS, S.QUESTIONS, S.PAIRS) + f"""
SELECT qid, doc_id, round(1 - distance / 2, 6) AS similarity FROM pairs
WHERE round(distance, 9) <= {2 * (1 - params.SIMILARITY_THRESHOLD)}""")
def q_similarity_threshold(spark, sf):
    s = R.similarity_threshold(ad.corpus(spark, sf), ad.questions(spark, sf))
    return s.select("qid", "doc_id", F.round("similarity", 6).alias("similarity"))
