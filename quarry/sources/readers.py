"""Readers (S1-S5, S11): statute texts, case records (JSON array or JSONL), QA pairs and
evaluation samples — always with declared schemas, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.cases import RAW_CASE_SCHEMA
from quarry.operators.models import global_index
from quarry.session import path_exists
from quarry.sources.json_array import array_objects

EVAL_SCHEMA = "question string, answer string, sources array<string>, category string"
QA_SCHEMA = "question string, answer string"


def statute_texts(spark: SparkSession, domains: DataFrame, root: str) -> DataFrame:
    """One row per existing domain file (whole text); a missing file yields no row, not
    an error.  ``root`` is any folder that Spark can read.  Output: domain, domain_name, priority, file, text."""
    files = [r["file"] for r in domains.select("file").collect()]  # registry: a handful of rows
    present = [f for f in (f"{root.rstrip('/')}/{name}" for name in files) if path_exists(spark, f)]
    if not present:
        return domains.select("domain", F.col("name").alias("domain_name"), "priority", "file",
                              F.lit(None).cast("string").alias("text")).where(F.lit(False))
    t = spark.read.option("wholetext", True).text(present).select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col("value").alias("text"))
    return t.join(F.broadcast(domains.select("domain", F.col("name").alias("domain_name"), "priority", "file")),
                  "file")


def case_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Case records from JSON arrays or JSONL (a file, folder or glob of one format); bad
    records are skipped.  The format is that of the first non-blank line, after a byte-order mark: an array starts
    with '['.  ``case_index`` is the record position; with ``limit``, the first so many records are taken *before*
    filtering; without, all are."""
    first = spark.read.text(path).select(F.regexp_replace("value", "^\ufeff", "").alias("v")).where(F.trim("v") != "").first()
    is_array = first is not None and first["v"].lstrip().startswith("[")
    schema = RAW_CASE_SCHEMA + ", _corrupt_record string"
    if is_array:    # by ranges of the files, however large one is
        found = array_objects(spark, path)
        record = F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        df = found.select(F.struct("file", "start", "seq").alias("_mid"), record.alias("r")).select("_mid", "r.*")
        df = global_index(df, "_mid").withColumnRenamed("idx", "case_index").drop("_mid")
        return (df if limit is None else df.where(F.col("case_index") < limit)).where(_valid("fact")).drop("_corrupt_record")
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    # record position in file order: monotonically increasing ids follow file order; the global
    # index turns them into consecutive positions without a single-task window
    df = global_index(df.withColumn("_mid", F.monotonically_increasing_id()), "_mid") \
        .withColumnRenamed("idx", "case_index").drop("_mid")
    if limit is not None:
        df = df.where(F.col("case_index") < limit)
    return df.where(_valid("fact")).drop("_corrupt_record")


def _valid(data_col: str) -> F.Column:
    """Not a corrupt record.  A corrupt record has every data column null, so also testing a
    data column keeps the meaning and lets Spark prune to it (a query on the corrupt-record
    column alone is not allowed)."""
    return F.col("_corrupt_record").isNull() | F.col(data_col).isNotNull()


def qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    """QA JSONL with a declared schema; broken lines dropped (see ``cases.qa_chunks``)."""
    df = spark.read.schema(QA_SCHEMA + ", _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    return df.where(_valid("question")).drop("_corrupt_record")


def eval_samples(spark: SparkSession, path: str | None, fallback: DataFrame | None = None) -> DataFrame:
    """Evaluation samples with defaults ('' , '', [], 'general'); a missing file falls
    back to the supplied built-in sample table."""
    if not path or not path_exists(spark, path):
        if fallback is None:
            raise FileNotFoundError(f"evaluation set {path!r} not found and no fallback given")
        return fallback
    df = spark.read.schema(EVAL_SCHEMA + ", _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    return df.where(_valid("question")).select(
        F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("ground_truth"),
        F.coalesce("sources", F.array().cast("array<string>")).alias("expected_sources"),
        F.coalesce("category", F.lit("general")).alias("category"))
