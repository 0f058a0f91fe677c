"""Driver queries: data quality (S14-S17) and the index sink round trip."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.plans import adapters as ad
from quarry.plans import sql_fragments as S
from quarry.plans.catalog import register
from quarry.session import scratch_path
from quarry.sources import quality as Q
from quarry.sources import sinks


def _files(spark, sf):
    """Each document and each page is treated as one text file."""
    d = ad.table(spark, sf, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("file"),
                                                 F.col("text"))
    p = ad.table(spark, sf, "pages").select(F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("file"),
                                             F.col("html").alias("text"))
    return d.unionByName(p)


_FILES = """files AS (
  SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS file, text FROM documents
  UNION ALL SELECT 'page/' || CAST(page_id AS VARCHAR), html FROM pages)"""
_LINES = (f"len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: "
          f"regexp_matches(l, {S.q(Q.NON_WS)})))")
_DQ = f"""dq AS (
  SELECT file, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes, CAST(length(text) AS BIGINT) AS n_chars,
         CAST({_LINES} AS BIGINT) AS n_lines,
         contains(text, '第') AND contains(text, '条') AS has_articles,
         contains(text, '第') AND (contains(text, '章') OR contains(text, '编')) AS has_chapters,
         CASE WHEN text IS NULL THEN 'missing' WHEN octet_length(encode(text)) < 1000 THEN 'too_small'
              WHEN {_LINES} < 3 THEN 'too_few_lines' ELSE '' END AS reason
  FROM files)"""


@register("dq_documents", S.with_(_FILES, _DQ) +
          "SELECT file, size_bytes, n_chars, n_lines, has_articles, has_chapters, reason = '' AS passed, reason FROM dq")
def q_dq_documents(spark, sf):
    return Q.text_file_quality(_files(spark, sf))


@register("dq_summary", S.with_(_FILES, _DQ) + """
SELECT CAST(sum(CASE WHEN reason = '' THEN 1 ELSE 0 END) AS BIGINT) AS passed, CAST(count(*) AS BIGINT) AS total,
       min(CASE WHEN reason = '' THEN 1 ELSE 0 END) = 1 AS all_passed FROM dq""")
def q_dq_summary(spark, sf):
    return Q.quality_summary(Q.text_file_quality(_files(spark, sf)))


@register("dq_json", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n_records,
       CAST(count(CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN 1 END) AS BIGINT) AS n_valid,
       array_to_string(list_sort(list_distinct(flatten(list(json_keys(props))))), ',') AS fields
FROM events GROUP BY event_type""")
def q_dq_json(spark, sf):
    """S15 over event payloads: records, valid JSON objects and field names per source."""
    return Q.json_records_quality(ad.table(spark, sf, "events"), "event_type", "props")


# Required files: the registry's domain files and a few source files of the corpus.
REQUIRED = [f"{k}.txt" for k in ad.DOMAIN_KEYS] + ["src0.txt", "src19.txt", "src25.txt", "cases.json"]


@register("dq_missing", f"""
SELECT r.file FROM (SELECT unnest({S.lst(REQUIRED)}) AS file) r
WHERE r.file NOT IN (SELECT DISTINCT source || '.txt' FROM documents)""")
def q_dq_missing(spark, sf):
    """Required files absent from the corpus sources."""
    req = spark.createDataFrame([(f,) for f in REQUIRED], "file string")
    found = ad.table(spark, sf, "documents").select(F.concat(F.col("source"), F.lit(".txt")).alias("file"))
    return Q.missing_files(req, found)


@register("index_roundtrip", S.with_(S.CORPUS) + """
SELECT domain, type, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(length(content)) AS BIGINT) AS n_chars,
       CAST(sum(len(embedding)) AS BIGINT) AS n_values
FROM corpus GROUP BY domain, type""")
def q_index_roundtrip(spark, sf):
    """The corpus with its vectors written as a (domain, type)-partitioned index and
    read back; the counts per partition must survive the round trip."""
    root = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    sinks.write_index(ad.corpus(spark, sf).select("doc_id", "content", "type", "domain", "embedding"), root)
    idx = sinks.open_index(spark, root)
    return idx.groupBy("domain", "type").agg(F.count("*").cast("bigint").alias("n_chunks"),
                                             F.sum(F.length("content")).cast("bigint").alias("n_chars"),
                                             F.sum(F.size("embedding")).cast("bigint").alias("n_values"))
