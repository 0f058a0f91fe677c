"""A corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again before the
next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, langid, linededup, mixing, ngramjoin
from quarry.llm.common import Stage, tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language ID accepts; it learns from the labelled ones."""
    judged = langid.identify(docs, langid.train(docs))
    return judged.filter("accepted").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; copies of whole documents stay whole for the join to judge."""
    cut = linededup.drop_frequent_lines(docs, leave_copies=True)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngramjoin.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each drawn block, mostly a whole document, in shuffled shards."""
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, and the digest of what they decode to."""
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"),
                             outputs=("n_tokens", "ids", "decoded_sha256"), keep=["doc_id", "lang", "source"])


STAGES = [("language_id", identify_language), ("line_dedup", drop_lines), ("ngram_jaccard_join", join_near),
          ("mixing", mix_sources), ("bpe", encode)]
ORACLE_SQL = None       # the language ID compresses with zstandard, which SQL can't express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    stage = Stage(spark, "pipeline")
    docs = tables(spark, sf_dir, "documents")
    for k, (name, function) in enumerate(STAGES):
        docs = stage.keep(function(spark, docs, sf_dir), str(k))
        if k:
            stage.drop(str(k - 1))
    return docs
