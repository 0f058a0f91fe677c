"""Driver queries: corpus build — cleaning, ids, segmentation, packing, chunks, tags,
cases, QA pairs, statistics (T1-T17, S4, S10, S11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry.functions.text import clean_head, clean_text, stable_id
from quarry.operators import answer as A
from quarry.operators import cases as C
from quarry.operators import segment as G
from quarry.plans import adapters as ad
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register, round6
from quarry.sources.quality import id_collisions, with_retrieval_key

PACK_SEPS = ".;"          # Latin sentence separators for the driver texts
CASE_LIMIT = 10_000       # S11: the first records, a part of them at every scale factor


@register("clean_text", f"SELECT doc_id, {S.clean_sql('text')} AS clean FROM documents")
def q_clean_text(spark, sf):
    return ad.table(spark, sf, "documents").select("doc_id", clean_text(F.col("text")).alias("clean"))


@register("doc_id", f"SELECT doc_id, {S.stable_id_sql(S.clean_sql('text'), 'source')} AS chunk_id FROM documents")
def q_doc_id(spark, sf):
    d = ad.table(spark, sf, "documents")
    return d.select("doc_id", stable_id(clean_head("text", 100), F.col("source")).alias("chunk_id"))


# every document and a second version of it, which begins alike: beyond 100 characters the two have one id
_IDS = f"""SELECT doc_id, text, {S.stable_id_sql(S.clean_sql('text'), 'source')} AS chunk_id FROM (
  SELECT doc_id, text, source FROM documents UNION ALL SELECT -1 - doc_id, text || ' ' || reverse(text), source FROM documents)"""


def _with_ids(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", "text", "source")
    second = F.struct((-1 - F.col("doc_id")).alias("doc_id"), F.concat("text", F.lit(" "), F.reverse("text")).alias("text"))
    # made in a generator: one scan, and the long text is computed once and not at every use of it
    d = d.select("source", F.explode(F.array(F.struct("doc_id", "text"), second)).alias("v")).select("v.doc_id", "v.text", "source")
    return d.select("doc_id", "text", stable_id(clean_head("text", 100), F.col("source")).alias("chunk_id"))


@register("id_collisions", f"""
SELECT chunk_id, count(DISTINCT md5(coalesce(text, ''))) AS n_contents, count(*) AS n_rows FROM ({_IDS})
WHERE chunk_id IS NOT NULL GROUP BY chunk_id HAVING n_contents > 1""")
def q_id_collisions(spark, sf):
    """T2 check: ids of texts of one source that share their first 100 characters but differ."""
    return id_collisions(_with_ids(spark, sf), "chunk_id", "text")


@register("retrieval_key", f"""
SELECT doc_id, chunk_id || CASE WHEN count(DISTINCT md5(coalesce(text, ''))) OVER (PARTITION BY chunk_id) > 1
  THEN '-' || substr(md5(coalesce(text, '')), 1, 12) ELSE '' END AS retrieval_key FROM ({_IDS})""")
def q_retrieval_key(spark, sf):
    """A key that keeps the texts of colliding ids apart."""
    return with_retrieval_key(_with_ids(spark, sf), "chunk_id", "text").select("doc_id", "retrieval_key")


_SEG = S.with_(S.STATUTE_FILES, *S.segment_ctes())


def _seg(spark, sf):
    return G.segment_articles(ad.statute_files(spark, sf))


@register("segment_articles", _SEG + "SELECT file_id, pos, article, chapter, content, chunk_id FROM seg")
def q_segment_articles(spark, sf):
    return _seg(spark, sf).select("file_id", "pos", "article", "chapter", "content", "chunk_id")


# references to an article inside the lines
_REFERRING = "referring AS (SELECT file_id, domain_name, replace(text, '. ', '. 见第三条 ') AS text FROM files)"


@register("segment_anywhere", S.with_(S.STATUTE_FILES, _REFERRING, *S.segment_ctes("referring", "anywhere"))
          + "SELECT file_id, pos, article, chapter, content, chunk_id FROM seg")
def q_segment_anywhere(spark, sf):
    """T3 with anchors anywhere: references inside an article cut it, too."""
    files = ad.statute_files(spark, sf).withColumn("text", F.replace("text", F.lit(". "), F.lit(". 见第三条 ")))
    return G.segment_articles(files, anchor="anywhere").select("file_id", "pos", "article", "chapter", "content", "chunk_id")



@register("carry_heading", _SEG + """
SELECT file_id, chapter, CAST(count(*) AS BIGINT) AS n_articles, CAST(min(pos) AS BIGINT) AS first_pos
FROM seg WHERE pos > 0 GROUP BY file_id, chapter""")
def q_carry_heading(spark, sf):
    s = _seg(spark, sf).where(F.col("pos") > 0)
    return s.groupBy("file_id", "chapter").agg(F.count("*").cast("bigint").alias("n_articles"),
                                               F.min("pos").cast("bigint").alias("first_pos"))


def _pack_sql(max_len: int = 800, seps: str = PACK_SEPS) -> str:
    cur = r"regexp_extract(acc, '[^\x01]*$')"
    step = (f"CASE WHEN length({cur}) + length(s) > {max_len} AND {cur} <> '' THEN acc || chr(1) || s "
            f"ELSE acc || s END")
    sent = f"list_filter(regexp_extract_all(content, {S.q(f'[^{seps}]*[{seps}]?')}), lambda x: x <> '')"
    return f"""pk1 AS (
  SELECT file_id, pos, article, chunk_id, content,
         CASE WHEN length(content) > {max_len}
              THEN list_transform(string_split(list_reduce({sent}, lambda acc, s: {step}), chr(1)), lambda x: {S.strip_sql('x')})
              ELSE [content] END AS parts0
  FROM seg),
pk2 AS (
  SELECT file_id, pos, article, chunk_id,
         CASE WHEN length(content) > {max_len} THEN list_filter(parts0, lambda x, i: i < len(parts0) OR x <> '')
              ELSE parts0 END AS parts
  FROM pk1),
pk AS (
  SELECT file_id, pos, u.x AS content, u.i - 1 AS part, len(parts) AS n, article, chunk_id
  FROM (SELECT *, unnest(list_transform(parts, lambda x, i: {{'x': x, 'i': i}})) AS u FROM pk2))"""


@register("pack_sentences", _SEG.rstrip() + ",\n" + _pack_sql() + """
SELECT file_id, pos, CAST(part AS BIGINT) AS part,
       CASE WHEN n > 1 THEN article || '(第' || CAST(part + 1 AS VARCHAR) || '部分)' ELSE article END AS article,
       CASE WHEN n > 1 THEN chunk_id || '_' || CAST(part AS VARCHAR) ELSE chunk_id END AS chunk_id,
       content
FROM pk""")
def q_pack_sentences(spark, sf):
    p = G.pack_sentences(_seg(spark, sf), seps=PACK_SEPS)
    return p.select("file_id", "pos", "part", "article", "chunk_id", "content")


@register("overlap_chunks", """
SELECT doc_id, CAST((s - 1) // 650 AS BIGINT) AS chunk_no, substr(text, CAST(s AS BIGINT), 800) AS chunk
FROM (SELECT doc_id, text, unnest(generate_series(1, greatest(length(text) - 150, 1), 650)) AS s FROM documents)""")
def q_overlap_chunks(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", "text")
    return G.overlap_chunks(d, "text").select("doc_id", "chunk_no", "chunk")


def _tags_sql(col: str) -> str:
    items = ", ".join(
        f"CASE WHEN {' OR '.join(f'contains({col}, {S.q(p)})' for p in pats)} THEN {S.q(lab)} END"
        for lab, pats in L.LATIN_TAGS)
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ',')"


@register("tag_keywords", f"SELECT doc_id, {_tags_sql('text')} AS tags FROM documents")
def q_tag_keywords(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", "text")
    return G.tag_keywords(d, L.LATIN_TAGS, "text").select("doc_id", F.array_join("tags", ",").alias("tags"))


_STATS_SQL = S.with_(S.CORPUS) + """
SELECT type, CAST(count(*) AS BIGINT) AS n_docs, CAST(coalesce(sum(length(content)), 0) AS BIGINT) AS total_chars,
       coalesce(avg(length(content)), 0.0) AS avg_chars, CAST(grouping(type) AS INTEGER) AS is_total
FROM corpus GROUP BY ROLLUP (type)"""


@register("corpus_stats", S.round6(_STATS_SQL, ["avg_chars"]))
def q_corpus_stats(spark, sf):
    return round6(G.corpus_stats(ad.corpus(spark, sf)), ["avg_chars"])


# ---- cases ----------------------------------------------------------------------------------
RAW_CASES = """raw AS (
  SELECT o_orderkey AS case_index,
         'Order ' || CAST(o_orderkey AS VARCHAR) || ' was placed by customer ' || CAST(o_custkey AS VARCHAR)
           || ' with status ' || o_orderstatus AS fact,
         o_orderkey % 2 = 0 AS nested,
         [o_orderpriority] AS m_acc, [o_custkey % 300, o_orderkey % 100] AS m_art,
         CASE WHEN o_orderstatus = 'P' OR o_orderkey % 10 = 4 THEN NULL ELSE
           {'imprisonment': CAST(o_orderkey % 37 AS INTEGER), 'death_penalty': o_orderpriority = '1-URGENT',
            'life_imprisonment': o_orderpriority = '2-HIGH'} END AS m_term,
         o_custkey AS m_fine,
         CASE WHEN o_orderstatus = 'F' THEN []::VARCHAR[] ELSE [o_orderpriority, 'theft'] END AS f_acc,
         [o_custkey % 300] AS f_art, CAST(o_orderkey % 25 AS INTEGER) AS f_term, o_custkey AS f_fine
  FROM orders)"""
NORM_CASES = f"""norm AS (
  SELECT case_index, {S.clean_sql('fact')} AS fact,
         CASE WHEN nested THEN m_acc ELSE f_acc END AS accusation,
         list_transform(CASE WHEN nested THEN m_art ELSE f_art END, lambda a: CAST(a AS VARCHAR)) AS articles,
         CASE WHEN nested THEN m_term ELSE {{'imprisonment': coalesce(f_term, 0), 'death_penalty': false,
                                             'life_imprisonment': false}} END AS term,
         CASE WHEN nested THEN m_fine ELSE coalesce(f_fine, 0) END AS fine
  FROM raw WHERE fact IS NOT NULL AND length(fact) >= 50)"""
VERDICT_SQL = """CASE WHEN term IS NULL THEN NULL WHEN coalesce(term.death_penalty, false) THEN '死刑'
  WHEN coalesce(term.life_imprisonment, false) THEN '无期徒刑'
  WHEN coalesce(term.imprisonment, 0) > 0 THEN '有期徒刑' || CAST(term.imprisonment AS VARCHAR) || '个月'
  ELSE '其他刑罚' END"""
COMPOSE_SQL = f"""comp AS (
  SELECT case_index,
    '【案情事实】' || chr(10) || fact
    || CASE WHEN coalesce(len(accusation), 0) > 0 THEN chr(10) || '【指控罪名】' || array_to_string(accusation, '、') ELSE '' END
    || CASE WHEN coalesce(len(articles), 0) > 0 THEN chr(10) || '【相关法条】第' || array_to_string(articles, '、') || '条' ELSE '' END
    || CASE WHEN ({VERDICT_SQL}) IS NOT NULL THEN chr(10) || '【判决结果】' || ({VERDICT_SQL}) ELSE '' END AS content,
    CASE WHEN coalesce(len(accusation), 0) > 0 THEN array_to_string(accusation, ',') ELSE '未知' END AS accusation_csv,
    CASE WHEN coalesce(len(articles), 0) > 0 THEN array_to_string(articles, ',') ELSE '未知' END AS articles_csv,
    {S.stable_id_sql('substr(fact, 1, 100)', "'CAIL'")} AS chunk_id
  FROM norm)"""


def _norm(spark, sf):
    return C.normalise_cases(ad.raw_cases(spark, sf))


@register("case_normalise", S.with_(RAW_CASES, NORM_CASES) + """
SELECT case_index, fact, array_to_string(accusation, '|') AS accusation, array_to_string(articles, '|') AS articles,
       term.imprisonment AS imprisonment, term.death_penalty AS death_penalty,
       term.life_imprisonment AS life_imprisonment, fine
FROM norm""")
def q_case_normalise(spark, sf):
    n = _norm(spark, sf)
    return n.select("case_index", "fact", F.array_join("accusation", "|").alias("accusation"),
                    F.array_join("articles", "|").alias("articles"), F.col("term.imprisonment").alias("imprisonment"),
                    F.col("term.death_penalty").alias("death_penalty"),
                    F.col("term.life_imprisonment").alias("life_imprisonment"), "fine")


@register("case_verdict", S.with_(RAW_CASES, NORM_CASES) + f"SELECT case_index, {VERDICT_SQL} AS verdict FROM norm")
def q_case_verdict(spark, sf):
    return _norm(spark, sf).select("case_index", C.verdict("term").alias("verdict"))


@register("case_compose", S.with_(RAW_CASES, NORM_CASES, COMPOSE_SQL) +
          "SELECT case_index, content, accusation_csv, articles_csv, chunk_id FROM comp")
def q_case_compose(spark, sf):
    return C.compose_cases(_norm(spark, sf)).select("case_index", "content", "accusation_csv", "articles_csv",
                                                    "chunk_id")


@register("case_head", S.with_(RAW_CASES, NORM_CASES, COMPOSE_SQL) +
          f"SELECT case_index, chunk_id FROM comp WHERE case_index IN "
          f"(SELECT case_index FROM raw ORDER BY case_index LIMIT {CASE_LIMIT})")
def q_case_head(spark, sf):
    """The first N records by case index, taken before any is filtered (the limit is the feature)."""
    head = ad.raw_cases(spark, sf).orderBy("case_index").limit(CASE_LIMIT)
    return C.compose_cases(C.normalise_cases(head)).select("case_index", "chunk_id")


# ---- QA pairs and the corpus union ------------------------------------------------------------
MSG_PAIRS = """pairs AS (
  SELECT conv_id, turn, prev_text AS "user", text AS assistant,
         CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS pair_no
  FROM (SELECT conv_id, turn, role, text,
               lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
               lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text
        FROM conversations WHERE role IN ('user', 'assistant', 'ai', 'bot'))
  WHERE role IN ('assistant', 'ai', 'bot') AND prev_role = 'user')"""
QA_SQL = f"""qa AS (
  SELECT conv_id, turn, '【问题】' || q || chr(10) || '【回答】' || a AS content FROM (
    SELECT conv_id, turn, {S.clean_sql('"user"')} AS q, {S.clean_sql('assistant')} AS a FROM pairs)
  WHERE q <> '' AND a <> '')"""


def _qa(spark, sf):
    pairs = A.message_pairs(ad.table(spark, sf, "conversations"))
    return C.qa_chunks(pairs.withColumnRenamed("user", "question").withColumnRenamed("assistant", "answer"))


@register("qa_pairs", S.with_(MSG_PAIRS, QA_SQL) + "SELECT conv_id, turn, content FROM qa")
def q_qa_pairs(spark, sf):
    return _qa(spark, sf).select("conv_id", "turn", "content")


@register("corpus_union", S.with_(S.STATUTE_FILES, *S.segment_ctes(), RAW_CASES, NORM_CASES, COMPOSE_SQL, MSG_PAIRS,
                                  QA_SQL) + """
SELECT type, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(length(content)) AS BIGINT) AS n_chars,
       CAST(count(DISTINCT chunk_id) AS BIGINT) AS n_ids
FROM (SELECT 'statute' AS type, content, chunk_id FROM seg
      UNION ALL SELECT 'case', content, chunk_id FROM comp
      UNION ALL SELECT 'qa', content, NULL FROM qa)
GROUP BY type""")
def q_corpus_union(spark, sf):
    """Statutes of every domain, cases and QA pairs in one chunk table."""
    st = _seg(spark, sf).withColumn("type", F.lit("statute")).select("type", "content", "chunk_id")
    cs = C.compose_cases(_norm(spark, sf)).select("type", "content", "chunk_id")
    qa = _qa(spark, sf).select("type", "content")
    u = st.unionByName(cs).unionByName(qa, allowMissingColumns=True)
    return u.groupBy("type").agg(F.count("*").cast("bigint").alias("n_chunks"),
                                 F.sum(F.length("content")).cast("bigint").alias("n_chars"),
                                 F.countDistinct("chunk_id").cast("bigint").alias("n_ids"))
