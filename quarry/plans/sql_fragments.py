"""DuckDB twins of the driver-data adapters (common table expressions)."""

CORPUS = """corpus AS (
  SELECT d.doc_id, d.text AS content,
         CASE WHEN e.label % 2 = 0 THEN 'statute' ELSE 'case' END AS type,
         ['criminal','civil','commercial','administrative','labor'][e.label % 5 + 1] AS domain,
         ['Criminal law','Civil code','Commercial law','Administrative law','Labor law'][e.label % 5 + 1] AS domain_name,
         d.source,
         CASE WHEN e.label % 2 = 0 THEN '第' || CAST(d.doc_id AS VARCHAR) || '条' ELSE '' END AS article,
         CASE WHEN e.label % 2 = 0 THEN '' ELSE d.lang END AS accusation,
         d.lang,
         CAST(e.embedding AS DOUBLE[]) AS embedding
  FROM documents d JOIN embeddings e ON d.doc_id % (SELECT count(*) FROM embeddings) = e.vec_id)"""

QUESTIONS = """questions AS (
  SELECT b.item_id AS qid, b.text AS question, CAST(e.embedding AS DOUBLE[]) AS qvec
  FROM benchmark b JOIN embeddings e ON b.item_id = e.vec_id)"""

# All (question, chunk) distances; the oracle may enumerate pairs, the engine never does.
PAIRS = """pairs AS (
  SELECT q.qid, c.doc_id, c.type, c.domain,
         list_sum(list_transform(list_zip(q.qvec, c.embedding), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS distance
  FROM questions q, corpus c WHERE c.doc_id <> q.qid)"""

JUDGE = """judge AS (
  SELECT d.doc_id, CAST(d.n_chars % 11 AS DOUBLE) AS score, l.quality = 1 AS relevant
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def scope_case(groups, col: str) -> str:
    """G1 twin: label of the first group with a keyword contained in ``col``."""
    whens = " ".join(
        f"WHEN {' OR '.join(f'contains({col}, {q(k)})' for k in kws)} THEN {q(lab)}" for lab, kws in groups)
    return f"(CASE {whens} ELSE NULL END)"


def keyword_bonus(question: str, content: str, words) -> str:
    """R7 twin."""
    from quarry.functions.text import ARTICLE_REF, WS_CLASS
    lq, lc = f"lower({question})", f"lower({content})"
    nw = f"len(list_filter({lst(words)}, lambda w: contains({lq}, w) AND contains({lc}, w)))"
    arts = f"len(list_filter(regexp_extract_all({question}, {q(ARTICLE_REF)}), lambda a: contains({lc}, a)))"
    qw = (f"len(list_filter(regexp_split_to_array({lq}, {q(WS_CLASS + '+')}), "
          f"lambda w: length(w) >= 2 AND contains({lc}, w)))")
    return f"(-0.5 * {nw} - CASE WHEN {nw} >= 2 THEN 0.5 ELSE 0.0 END - 2.0 * {arts} - 0.3 * {qw})"


def quotas(k: int):
    sk = max(4, k // 2 + 1)
    return sk, k - sk + 2


def hybrid_ctes(k: int, words, pool: str = "pool", qtab: str = "inq", sfx: str = "") -> list[str]:
    """R4-R9 twin for final size k over a pool (qid, ord, doc_id, type, domain, distance, rk).
    Produces CTE ``m{k}{sfx}`` (qid, doc_id, type, domain, distance, pos)."""
    sk, ck = quotas(k)
    n = f"{k}{sfx}"
    return [
        f"""cand{n} AS (
  SELECT qid, doc_id, min(distance) AS distance, first(type) AS type, first(domain) AS domain FROM {pool}
  WHERE (type = 'statute' AND rk <= {2 * sk}) OR (type = 'case' AND ord = 0 AND rk <= {2 * ck})
  GROUP BY qid, doc_id)""",
        f"""sc{n} AS (
  SELECT c.*, CASE WHEN c.type = 'statute' THEN c.distance + {keyword_bonus('q.question', 'd.content', words)}
              ELSE c.distance END AS kscore
  FROM cand{n} c JOIN corpus d ON c.doc_id = d.doc_id JOIN {qtab} q ON c.qid = q.qid)""",
        f"""br{n} AS (
  SELECT * FROM (SELECT *, 0 AS branch, row_number() OVER (PARTITION BY qid ORDER BY kscore, distance, doc_id) AS brk
                 FROM sc{n} WHERE type = 'statute') WHERE brk <= {sk}
  UNION ALL
  SELECT * FROM (SELECT *, 1 AS branch, row_number() OVER (PARTITION BY qid ORDER BY distance, doc_id) AS brk
                 FROM sc{n} WHERE type = 'case') WHERE brk <= {ck})""",
        f"""mm{n} AS (
  SELECT qid, doc_id, type, domain, distance, kscore, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY qid ORDER BY branch, brk) AS pos FROM br{n}) WHERE pos <= {k})""",
        f"""m{n} AS (
  SELECT * FROM mm{n}
  UNION ALL
  SELECT qid, doc_id, type, domain, distance, distance AS kscore, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, doc_id) AS pos FROM (
      SELECT qid, doc_id, min(distance) AS distance, first(type) AS type, first(domain) AS domain
      FROM {pool} WHERE ord = 0 GROUP BY qid, doc_id))
  WHERE pos <= {k} AND qid IN (SELECT qid FROM {qtab}) AND qid NOT IN (SELECT qid FROM mm{n}))""",
    ]


def pool_cte(fetch: int, qtab: str = "inq") -> str:
    """R1/R4 twin: per (qid, ord, domain, type) top ``fetch`` of the original question vector."""
    return f"""pool AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY qid, ord, domain, type ORDER BY distance, doc_id) AS rk FROM (
      SELECT q.qid, CAST(0 AS BIGINT) AS ord, c.doc_id, c.type, c.domain,
             list_sum(list_transform(list_zip(q.qvec, c.embedding), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS distance
      FROM {qtab} q, corpus c WHERE c.doc_id <> q.qid))
  WHERE rk <= {fetch})"""


def clean_sql(x: str) -> str:
    """T1 twin."""
    from quarry.functions.text import CONTROL_CLASS, WS_CLASS
    a = f"regexp_replace(coalesce({x}, ''), {q(WS_CLASS + '+')}, ' ', 'g')"
    b = f"regexp_replace({a}, {q(CONTROL_CLASS)}, '', 'g')"
    c = f"replace({b}, '．', '.')"
    return f"regexp_replace({c}, '^ +| +$', '', 'g')"


def strip_sql(x: str) -> str:
    from quarry.functions.text import WS_CLASS
    return f"regexp_replace({x}, {q(f'^{WS_CLASS}+|{WS_CLASS}+$')}, '', 'g')"


def stable_id_sql(content: str, source: str) -> str:
    return f"substr(md5({source} || ':' || substr({content}, 1, 100)), 1, 12)"


STATUTE_FILES = """files AS (
  SELECT doc_id AS file_id, source AS domain_name,
         (CASE WHEN n_chars % 7 = 0 THEN '目录 ' ELSE '' END) || 'Title ' || source || ' ' || substr(text, 1, 150) || chr(10) ||
         array_to_string(list_transform(string_split(text, chr(10)), lambda l, i:
            (CASE WHEN (i - 1) % 10 = 0 THEN '第' || ['一','二','三','四','五','六','七','八','九','十'][((i - 1) // 10) % 10 + 1]
                  || '章 Part ' || CAST((i - 1) // 10 + 1 AS VARCHAR) || chr(10) ELSE '' END)
            || '第' || CAST(i AS VARCHAR) || '条 ' || l), chr(10)) AS text
  FROM documents)"""


def segment_ctes(src: str = "files", anchor: str = "line") -> list[str]:
    """T3-T7 twin: CTE ``seg`` (file_id, domain_name, pos, article, chapter, body, content, chunk_id)."""
    from quarry.functions.text import WS_CLASS
    from quarry.operators.segment import ANCHOR, HEADING
    anchor_line = rf"(?m)^ *({ANCHOR}){WS_CLASS}*" if anchor == "line" else rf"({ANCHOR}){WS_CLASS}*"
    heading_line = rf"(?m)^ *({HEADING})"
    heading_strip = rf"(?m)^ *{HEADING}$"
    body = clean_sql(f"regexp_replace(p, {q(heading_strip)}, '', 'g')")
    return [
        f"""sg1 AS (
  SELECT file_id, domain_name, regexp_extract_all(t, {q(anchor_line)}, 1) AS anchors,
         regexp_split_to_array(t, {q(anchor_line)}) AS parts
  FROM (SELECT file_id, domain_name, regexp_replace(text, '[　\t]', ' ', 'g') AS t FROM {src}))""",
        f"""sg2 AS (SELECT *, list_transform(parts, lambda p: regexp_extract_all(p, {q(heading_line)}, 1)[-1]) AS heads FROM sg1)""",
        """sg3 AS (SELECT *, list_transform(anchors, lambda a, i: coalesce(list_filter(heads[1:i], lambda h: h IS NOT NULL)[-1], '')) AS chap FROM sg2)""",
        f"""sg4 AS (
  SELECT file_id, domain_name, u.pos AS pos, u.article AS article, u.chapter AS chapter, u.body AS body, u.raw AS raw
  FROM (SELECT file_id, domain_name, unnest(list_transform(parts, lambda p, i: {{
          'pos': i - 1,
          'article': CASE WHEN i = 1 THEN '前言' ELSE anchors[i - 1] END,
          'chapter': CASE WHEN i = 1 THEN '' ELSE chap[i - 1] END,
          'body': {body},
          'raw': p}})) AS u FROM sg3))""",
        f"""seg AS (
  SELECT file_id, domain_name, CAST(pos AS BIGINT) AS pos, article, chapter, body,
         CASE WHEN pos = 0 THEN body ELSE (CASE WHEN chapter <> '' THEN '【' || chapter || '】' ELSE '' END)
              || article || ' ' || body END AS content,
         {stable_id_sql("CASE WHEN pos = 0 THEN substr(body, 1, 100) ELSE body END",
                        "CASE WHEN pos = 0 THEN domain_name || '前言' ELSE domain_name END")} AS chunk_id
  FROM sg4
  WHERE CASE WHEN pos = 0 THEN
          length({strip_sql(f"regexp_replace(raw, {q(heading_strip)}, '', 'g')")}) > 100
          AND NOT (contains(regexp_replace(raw, {q(WS_CLASS + '+')}, '', 'g'), '目录')
                   OR contains(regexp_replace(raw, {q(WS_CLASS + '+')}, '', 'g'), '第一编')
                   OR contains(regexp_replace(raw, {q(WS_CLASS + '+')}, '', 'g'), '第二编'))
        ELSE length(body) > 20 END)""",
    ]

SCOPE_REPLIES = """replies AS (
  SELECT l.doc_id AS qid,
    CASE l.doc_id % 5
      WHEN 0 THEN 'Sure.' || chr(10) || '{"domain": "' || (CASE WHEN l.quality = 1 THEN '刑法' ELSE '民法' END)
                  || '",' || chr(10) || ' "confidence": ' || (CASE WHEN l.toxic = 1 THEN '0.95' ELSE '0.' || CAST(d.n_chars % 10 AS VARCHAR) END)
                  || ', "reasoning": "r"}' || chr(10) || 'Done'
      WHEN 1 THEN '{"domain": "' || (CASE WHEN l.quality = 1 THEN '刑法' ELSE '民法' END) || '"}'
      WHEN 2 THEN 'no verdict {broken'
      WHEN 3 THEN '{"confidence": ' || (CASE WHEN l.toxic = 1 THEN '0.95' ELSE '0.' || CAST(d.n_chars % 10 AS VARCHAR) END) || '}'
      ELSE '{"domain": "' || (CASE WHEN l.quality = 1 THEN '刑法' ELSE '民法' END) || '", "confidence": '
           || (CASE WHEN l.toxic = 1 THEN '0.95' ELSE '0.' || CAST(d.n_chars % 10 AS VARCHAR) END) || '}'
    END AS reply
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def json_span_sql(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), '(?s)\\{{.*\\}}', 0)"


def parsed_ok_sql(x: str) -> str:
    s = json_span_sql(x)
    return f"({s} <> '' AND json_valid({s}))"


def round6(sql: str, cols) -> str:
    """Wrap a query so that the given double columns are rounded to 6 decimals."""
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"
