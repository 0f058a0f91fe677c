"""Driver queries: conversation history and presentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import cut
from quarry.operators import answer as A
from quarry.operators import history as Y
from quarry.operators import retrieve as R
from quarry.plans import adapters as ad
from quarry.plans import q_answer as QA
from quarry.plans import q_scope as QS
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register
from quarry.plans.q_text import MSG_PAIRS


def _pairs(spark, sf):
    return Y.message_pairs_split(ad.table(spark, sf, "conversations"))


@register("message_pairs", S.with_(MSG_PAIRS) + 'SELECT conv_id, turn, pair_no, "user", assistant FROM pairs')
def q_message_pairs(spark, sf):
    return _pairs(spark, sf).select("conv_id", "turn", "pair_no", "user", "assistant")


@register("pairs_to_messages", S.with_(MSG_PAIRS) + """
SELECT conv_id, CAST((pair_no - 1) * 2 AS BIGINT) AS msg_no, 'user' AS role, "user" AS content FROM pairs
UNION ALL
SELECT conv_id, CAST((pair_no - 1) * 2 + 1 AS BIGINT), 'assistant', assistant FROM pairs""")
def q_pairs_to_messages(spark, sf):
    return A.pairs_to_messages(_pairs(spark, sf))


HISTORY_SQL = f"""
SELECT conv_id, pair_no, CAST(n_history AS BIGINT) AS n_history,
       CASE WHEN n_history = 0 THEN '{A.NO_HISTORY}' ELSE array_to_string(list_transform(
         list_sort(last3), lambda s: s.l), chr(10)) END AS history_text
FROM (
  SELECT conv_id, pair_no,
         count(*) OVER (PARTITION BY conv_id ORDER BY pair_no ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING) AS n_history,
         flatten(list([{{'k': pair_no * 2, 'l': '{A.USER_LABEL}' || substr("user", 1, 200) || '...'}},
                       {{'k': pair_no * 2 + 1, 'l': '{A.ASSISTANT_LABEL}' || substr(assistant, 1, 300) || '...'}}])
           OVER (PARTITION BY conv_id ORDER BY pair_no ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)) AS last3
  FROM pairs)"""


@register("history_window", S.with_(MSG_PAIRS) + HISTORY_SQL)
def q_history_window(spark, sf):
    h = Y.history_window_split(_pairs(spark, sf))
    return h.select("conv_id", "pair_no", "n_history", "history_text")


@register("history_reset", """
SELECT c.conv_id, c.turn, c.role FROM conversations c
LEFT JOIN (SELECT conv_id, max(turn) AS r FROM conversations WHERE role = 'system' GROUP BY conv_id) s
  ON c.conv_id = s.conv_id
WHERE s.r IS NULL OR c.turn > s.r""")
def q_history_reset(spark, sf):
    """A10: a 'system' message acts as a reset; only the turns after the last one remain."""
    return Y.history_after_reset_split(ad.table(spark, sf, "conversations")).select("conv_id", "turn", "role")


@register("citation_markdown", S.with_(*QA._PREFIX, *QA._M16, *QA._M8, *QA._POLICY) + f"""
SELECT f.qid, string_agg(
  '**[' || CAST(f.pos AS VARCHAR) || '] ' || {QA._label('d')} || '**' || chr(10)
  || '- 类型: ' || f.type || chr(10)
  || CASE WHEN coalesce(d.accusation, '') <> '' THEN '- 罪名: ' || d.accusation || chr(10) ELSE '' END
  || CASE WHEN coalesce(d.article, '') <> '' THEN '- 条款: ' || d.article || chr(10) ELSE '' END
  || '- 内容摘要: ' || substr({QA._cut('d.content', 200)}, 1, 150) || '...' || chr(10) || chr(10), '' ORDER BY f.pos)
  AS markdown
FROM final f JOIN corpus d ON f.doc_id = d.doc_id GROUP BY f.qid""")
def q_citation_markdown(spark, sf):
    docs = QA.cited(spark, sf, ["content", "source", "article", "accusation"])
    cites = docs.select("qid", "pos", A.source_label("source", "type", "article", "accusation").alias("source"),
                        F.col("type").alias("doc_type"), "accusation", F.lit("").alias("articles"), "article",
                        cut("content", 200).alias("content"))
    return A.citation_markdown(cites)


@register("search_markdown", S.with_(*QA._PREFIX) + """, ss AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, doc_id) AS pos FROM (
    SELECT * FROM (SELECT qid, domain, doc_id, distance,
                          row_number() OVER (PARTITION BY qid, domain ORDER BY distance, doc_id) AS drk
                   FROM pool WHERE ord = 0) WHERE drk <= 5)) WHERE pos <= 5)
SELECT s.qid, '### 🔍 找到 ' || CAST(count(*) AS VARCHAR) || ' 个相关文档' || chr(10) || chr(10) || string_agg(
  '#### ' || CASE WHEN contains(coalesce(d.source, ''), '法') THEN '📜' ELSE '⚖️' END || ' 文档 ' || CAST(s.pos AS VARCHAR) || chr(10)
  || '- **来源**: ' || coalesce(d.source, '未知') || chr(10)
  || CASE WHEN coalesce(d.accusation, '') <> '' THEN '- **罪名**: ' || d.accusation || chr(10) ELSE '' END
  || CASE WHEN coalesce(d.article, '') <> '' THEN '- **条款**: ' || d.article || chr(10) ELSE '' END
  || chr(10) || '> ' || replace(d.content, chr(10), chr(10) || '> ') || chr(10) || chr(10) || '---' || chr(10) || chr(10),
  '' ORDER BY s.pos) AS markdown
FROM ss s JOIN corpus d ON s.doc_id = d.doc_id GROUP BY s.qid""")
def q_search_markdown(spark, sf):
    s = R.search_similar(QS._pool(spark, sf), k=5)
    c = ad.corpus(spark, sf)
    docs = R.attach(s, c, ["content", "source", "article", "accusation"])
    return A.search_markdown(docs)
