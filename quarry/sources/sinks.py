"""Writers (S6-S10, S13): the chunk index as partitioned Parquet, single-domain rebuild with a
backup, and the evaluation report as JSON."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import hadoop_path, path_exists

INDEX_PARTITIONS = ["domain", "type"]


def write_index(chunks: DataFrame, root: str, id_col: str = "doc_id") -> None:
    """Replace the whole index; one directory per (domain, type) so that metadata
    filters prune partitions at read time, rows ordered by id inside each file so that
    row-group statistics serve id lookups."""
    order = [*INDEX_PARTITIONS, id_col] if id_col in chunks.columns else INDEX_PARTITIONS
    # each (domain, type, id range) goes to one task, so a task writes one file, not one for every directory
    chunks.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(*INDEX_PARTITIONS).parquet(root)


def open_index(spark: SparkSession, root: str) -> DataFrame:
    """Every domain folder present; without any, the root is one collection, whose chunks have their own ``domain`` and
    ``type`` or null; an absent root is an error asking for a build."""
    if not path_exists(spark, root):
        raise FileNotFoundError(f"index {root} does not exist; build it first (write_index)")
    chunks = spark.read.parquet(root)
    for column in INDEX_PARTITIONS:
        if column not in chunks.columns:
            chunks = chunks.withColumn(column, F.lit(None).cast("string"))
    return chunks


def rebuild_domain(spark: SparkSession, chunks: DataFrame, root: str, domain: str, backup_root: str) -> None:
    """Back up one domain's partitions, then replace that domain: its new partitions are overwritten,
    and those that the new chunks don't have are removed.  Other domains stay untouched."""
    current = open_index(spark, root).where(F.col("domain") == domain)
    current.write.mode("overwrite").partitionBy(*INDEX_PARTITIONS).parquet(backup_root)
    new = chunks.where(F.col("domain") == domain)
    kept = {r["type"] for r in new.select("type").distinct().collect()}     # a handful of chunk types
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*INDEX_PARTITIONS).parquet(root)
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = f"{root.rstrip('/')}/domain={utils.escapePathName(domain)}"
    fs, path = hadoop_path(spark, folder)
    for entry in fs.listStatus(path) if fs.exists(path) else []:
        name = utils.unescapePathName(entry.getPath().getName())
        if name.startswith("type=") and name.removeprefix("type=") not in kept:
            fs.delete(entry.getPath(), True)


def upsert_index(spark: SparkSession, chunks: DataFrame, root: str, key: str = "chunk_id") -> DataFrame:
    """Resume a build: only chunks whose id is not in the index yet (to be appended)."""
    if not path_exists(spark, root):
        return chunks
    return chunks.join(open_index(spark, root).select(key), key, "left_anti")


def save_report(metrics: DataFrame, samples: DataFrame, path: str) -> None:
    """Metrics and per-sample results as UTF-8 JSON lines under ``path``."""
    metrics.write.mode("overwrite").json(os.path.join(path, "metrics"))
    samples.write.mode("overwrite").json(os.path.join(path, "samples"))
