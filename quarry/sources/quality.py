"""Data-quality checks (S14-S17): one row per file with the reason it failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import WS_CLASS

MIN_BYTES = 1000
MIN_LINES = 3
NON_WS = WS_CLASS.replace("[", "[^", 1)


def text_file_quality(files: DataFrame, name_col: str = "file", text_col: str = "text",
                      bytes_col: str | None = None, valid_col: str | None = None) -> DataFrame:
    """Exists (row present), >= 1000 bytes, valid UTF-8, >= 3 non-blank lines; article and
    chapter markers reported (they do not fail a file).  ``bytes_col``/``valid_col`` come
    from a binary read (``binaryFile``); for string input they are derived."""
    t = F.col(text_col)
    size = F.col(bytes_col) if bytes_col else F.octet_length(t)
    valid = F.col(valid_col) if valid_col else F.lit(True)
    # a line is non-blank iff it has a non-whitespace character (same as strip() != '')
    lines = F.size(F.filter(F.split(F.coalesce(t, F.lit("")), "\n"), lambda l: l.rlike(NON_WS)))
    has_art = (F.instr(t, "第") > 0) & (F.instr(t, "条") > 0)
    has_chap = (F.instr(t, "第") > 0) & ((F.instr(t, "章") > 0) | (F.instr(t, "编") > 0))
    reason = (F.when(t.isNull(), F.lit("missing"))
              .when(size < MIN_BYTES, F.lit("too_small"))
              .when(~valid, F.lit("not_utf8"))
              .when(lines < MIN_LINES, F.lit("too_few_lines"))
              .otherwise(F.lit("")))
    return files.select(F.col(name_col).alias("file"), size.cast("bigint").alias("size_bytes"),
                        F.length(t).cast("bigint").alias("n_chars"), lines.cast("bigint").alias("n_lines"),
                        has_art.alias("has_articles"), has_chap.alias("has_chapters"),
                        (reason == "").alias("passed"), reason.alias("reason"))


def binary_text_files(spark, path_glob: str) -> DataFrame:
    """S14 source: files read as bytes, with UTF-8 validity and decoded text."""
    b = spark.read.format("binaryFile").load(path_glob)
    return b.select(F.col("path").alias("file"), F.col("length").alias("size_bytes"),
                    F.is_valid_utf8(F.col("content").cast("string")).alias("utf8"),
                    F.col("content").cast("string").alias("text"))


def json_records_quality(records: DataFrame, group_col: str, json_col: str) -> DataFrame:
    """Per source: records, parseable JSON objects, distinct field names.  Field names
    are exploded and de-duplicated per source before they are gathered, so the gathered list
    is bounded by the number of distinct names, not by the records."""
    keys = F.json_object_keys(F.col(json_col))
    counts = records.groupBy(group_col).agg(F.count("*").cast("bigint").alias("n_records"),
                                            F.count(keys).cast("bigint").alias("n_valid"))
    names = records.select(group_col, F.explode(keys).alias("_k")).distinct() \
        .groupBy(group_col).agg(F.array_join(F.array_sort(F.collect_list("_k")), ",").alias("fields"))
    return counts.join(names, group_col, "left").withColumn("fields", F.coalesce("fields", F.lit("")))


def quality_summary(checks: DataFrame) -> DataFrame:
    """Passed / total and an overall pass flag."""
    return checks.agg(F.sum(F.col("passed").cast("int")).cast("bigint").alias("passed"),
                      F.count("*").cast("bigint").alias("total"),
                      (F.min(F.col("passed").cast("int")) == 1).alias("all_passed"))


def missing_files(required: DataFrame, found: DataFrame, col: str = "file") -> DataFrame:
    """Required files that are not present."""
    return required.join(found.select(col).distinct(), col, "left_anti")


def id_collisions(chunks: DataFrame, id_col: str = "chunk_id", content_col: str = "content") -> DataFrame:
    """T2 check: ids that stand for more than one content, with the number of contents and of rows.  An id is made of a source and the
    first 100 characters, so longer contents may share it.  Rows are counted per (id, content) first, so a common id is no hot group."""
    rows = chunks.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.md5(F.coalesce(content_col, F.lit(""))).alias("m"))
    contents = rows.groupBy("id", "m").agg(F.count("*").alias("n"))
    per_id = contents.groupBy("id").agg(F.count("*").alias("n_contents"), F.sum("n").alias("n_rows"))
    return per_id.where(F.col("n_contents") > 1).select(F.col("id").alias(id_col), "n_contents", "n_rows")


def with_retrieval_key(chunks: DataFrame, id_col: str = "chunk_id", content_col: str = "content", key: str = "retrieval_key") -> DataFrame:
    """Adds a key that tells colliding contents apart: the id, and behind a colliding one a dash and 12 hex digits of the content's md5.
    De-duplication by it drops copies and keeps every text."""
    collided = id_collisions(chunks, id_col, content_col).select(F.col(id_col).alias("_id"), F.lit(True).alias("_hit"))
    # before the join, so that contents nobody asks for aren't shuffled
    rows = chunks.withColumn("_suffix", F.concat(F.lit("-"), F.substring(F.md5(F.coalesce(content_col, F.lit(""))), 1, 12)))
    tagged = rows.join(collided, rows[id_col] == collided["_id"], "left")
    return tagged.withColumn(key, F.concat(id_col, F.when(F.col("_hit"), F.col("_suffix")).otherwise(F.lit("")))).drop("_id", "_hit", "_suffix")
