"""Driver-data adapters: map the generated test tables onto the engine's shapes.

The generated tables carry no legal text, so the driver queries exercise the
same operators with Latin-script inputs:

* ``corpus``   = all documents, each with a vector (``vec_id = doc_id`` modulo the number of vectors);
  ``type`` from the vector label parity, ``domain`` from ``label % 5``.
* ``questions`` = benchmark items joined to their vectors (``item_id = vec_id``);
  a question never retrieves its own vector (``exclude=('qid', 'doc_id')``).

Each adapter has a SQL twin in ``plans.oracle`` with identical semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.cases import META_TYPE

# The five domain keys in priority order (1 = highest).
DOMAIN_KEYS = ["criminal", "civil", "commercial", "administrative", "labor"]
DOMAIN_NAMES = ["Criminal law", "Civil code", "Commercial law", "Administrative law", "Labor law"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domains(spark: SparkSession) -> DataFrame:
    """The domain registry (5 rows): domain, name, file, priority, description."""
    rows = [(k, n, f"{k}.txt", i + 1, f"{n} statutes") for i, (k, n) in enumerate(zip(DOMAIN_KEYS, DOMAIN_NAMES))]
    return spark.createDataFrame(rows, "domain string, name string, file string, priority int, description string")


def _domain_of(label: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(k) for k in DOMAIN_KEYS]), (label % 5 + 1).cast("int"))


def _domain_name_of(label: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(k) for k in DOMAIN_NAMES]), (label % 5 + 1).cast("int"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with vectors: doc_id, content, type, domain, domain_name, source, article,
    accusation, lang, embedding."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    j = d.join(e, d.doc_id % e.count() == e.vec_id, "inner")     # the ids are 0 .. count - 1
    is_statute = (F.col("label") % 2) == 0
    return j.select(
        "doc_id",
        F.col("text").alias("content"),
        F.when(is_statute, F.lit("statute")).otherwise(F.lit("case")).alias("type"),
        _domain_of(F.col("label")).alias("domain"),
        _domain_name_of(F.col("label")).alias("domain_name"),
        "source",
        F.when(is_statute, F.concat(F.lit("第"), F.col("doc_id").cast("string"), F.lit("条"))).otherwise(F.lit(""))
        .alias("article"),
        F.when(is_statute, F.lit("")).otherwise(F.col("lang")).alias("accusation"),
        "lang",
        "embedding",
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qid, question, qvec."""
    b = table(spark, sf_dir, "benchmark")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return b.join(e, b.item_id == e.vec_id, "inner").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question"), F.col("embedding").alias("qvec"))


def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge verdicts per document: score 0..10 = n_chars % 11, relevant = quality label.
    Documents without a label have no verdict (the rerank default applies)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "inner").select(
        "doc_id", (F.col("n_chars") % 11).cast("double").alias("score"), (F.col("quality") == 1).alias("relevant"))


# Chinese numerals one..ten used for synthetic chapter headings.
CHAPTER_NUMERALS = ["一", "二", "三", "四", "五", "六", "七", "八", "九", "十"]


def statute_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statute-format texts from documents: each document is one file; every line i gets
    the anchor '第{i+1}条 ', every 10th line is preceded by a chapter heading line, and a
    title line precedes the first anchor (marked as a contents page when n_chars % 7 = 0).
    Columns: file_id, domain_name, text."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    nums = F.array(*[F.lit(x) for x in CHAPTER_NUMERALS])
    lines = F.split(F.col("text"), "\n")
    body = F.array_join(F.transform(lines, lambda l, i: F.concat(
        F.when(i % 10 == 0, F.concat(F.lit("第"), F.element_at(nums, ((i / 10).cast("int") % 10 + 1)),
                                     F.lit("章 Part "), ((i / 10).cast("int") + 1).cast("string"), F.lit("\n")))
        .otherwise(F.lit("")),
        F.lit("第"), (i + 1).cast("string"), F.lit("条 "), l)), "\n")
    title = F.concat(F.when(F.col("n_chars") % 7 == 0, F.lit("目录 ")).otherwise(F.lit("")),
                     F.lit("Title "), F.col("source"), F.lit(" "), F.substring("text", 1, 150), F.lit("\n"))
    return d.select(F.col("doc_id").alias("file_id"), F.col("source").alias("domain_name"),
                    F.concat(title, body).alias("text"))


def raw_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case records in both raw shapes from orders: even keys nested (meta), odd keys flat (a third of them with an
    empty meta).  Some terms are empty structs."""
    o = table(spark, sf_dir, "orders")
    key, cust, st, pr = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    nested = key % 2 == 0
    none = "struct<imprisonment:int,death_penalty:boolean,life_imprisonment:boolean>"
    term = F.when(st == "P", F.lit(None)).when(key % 10 == 4, F.from_json(F.lit("{}"), none)).otherwise(F.struct(
        (key % 37).cast("int").alias("imprisonment"), (pr == "1-URGENT").alias("death_penalty"),
        (pr == "2-HIGH").alias("life_imprisonment")))
    meta = F.struct(F.array(pr).alias("accusation"), F.array(cust % 300, key % 100).alias("relevant_articles"),
                    term.alias("term_of_imprisonment"), cust.alias("punish_of_money"))
    fact = F.concat(F.lit("Order "), key.cast("string"), F.lit(" was placed by customer "), cust.cast("string"),
                    F.lit(" with status "), st)
    return o.select(
        key.alias("case_index"), fact.alias("fact"),
        F.when(nested, meta).when(key % 3 == 0, F.from_json(F.lit("{}"), META_TYPE)).alias("meta"),
        F.when(~nested, F.when(st == "F", F.array().cast("array<string>")).otherwise(F.array(pr, F.lit("theft"))))
        .alias("accusation"),
        F.when(~nested, F.array(cust % 300)).alias("law_articles"),
        F.when(~nested, (key % 25).cast("int")).alias("prison_term"),
        F.when(~nested, cust).alias("fine"))


# Fixed value: the served domain's label in model scope replies.
SERVED = "刑法"
OTHER = "民法"


def scope_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model scope replies per labelled document in five shapes (prose around multi-line JSON,
    missing confidence, not JSON, missing domain, bare JSON).  Columns: qid, reply."""
    lab = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(d, "doc_id")
    dom = F.when(F.col("quality") == 1, F.lit(SERVED)).otherwise(F.lit(OTHER))
    conf = F.when(F.col("toxic") == 1, F.lit("0.95")).otherwise(F.concat(F.lit("0."), (F.col("n_chars") % 10)
                                                                       .cast("string")))
    form = F.col("doc_id") % 5
    reply = (F.when(form == 0, F.concat(F.lit('Sure.\n{"domain": "'), dom, F.lit('",\n "confidence": '), conf,
                                        F.lit(', "reasoning": "r"}\nDone')))
             .when(form == 1, F.concat(F.lit('{"domain": "'), dom, F.lit('"}')))
             .when(form == 2, F.lit("no verdict {broken"))
             .when(form == 3, F.concat(F.lit('{"confidence": '), conf, F.lit("}")))
             .otherwise(F.concat(F.lit('{"domain": "'), dom, F.lit('", "confidence": '), conf, F.lit("}"))))
    return j.select(F.col("doc_id").alias("qid"), reply.alias("reply"))


CATEGORIES = ["criminal_law", "special_case", "case_related", "out_of_scope"]


def eval_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation samples from conversation pairs: question = user turn, ground truth =
    assistant turn ('' for out-of-scope), category by conversation, expected sources."""
    from quarry.operators.answer import message_pairs
    p = message_pairs(table(spark, sf_dir, "conversations"))
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("conv_id") % 4 + 1).cast("int"))
    oos = F.col("conv_id") % 4 == 3
    return p.select(
        "conv_id", "pair_no", F.col("user").alias("question"),
        F.when(oos, F.lit("")).otherwise(F.col("assistant")).alias("ground_truth"),
        cat.alias("category"),
        F.when(oos, F.array().cast("array<string>")).otherwise(F.array(
            F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")),
            F.concat(F.lit("Case "), (F.col("pair_no") % 3).cast("string")))).alias("expected_sources"))


def eval_answers(spark: SparkSession, sf_dir: str, run: str = "next") -> DataFrame:
    """Answers of a system under test for the samples.  Run 'next' answers with the next
    pair's assistant turn (the last pair with its own), run 'self' with its own turn.
    The system under test has no result for every ninth pair (failed samples)."""
    from pyspark.sql import Window
    from quarry.operators.answer import message_pairs
    p = message_pairs(table(spark, sf_dir, "conversations"))
    w = Window.partitionBy("conv_id").orderBy("pair_no")
    pred = F.coalesce(F.lead("assistant").over(w), F.col("assistant")) if run == "next" else F.col("assistant")
    p = p.withColumn("predicted", pred).where((F.col("conv_id") + F.col("pair_no")) % 9 != 0)
    return p.select(
        "conv_id", "pair_no", F.col("predicted").alias("predicted_answer"),
        F.when(F.col("conv_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(
            F.concat(F.lit("[src"), (F.col("conv_id") % 13).cast("string"), F.lit("] statute")),
            F.concat(F.lit("【case】 "), F.col("pair_no").cast("string")))).alias("citations"),
        ((F.col("pair_no") % 10) / 10.0).alias("confidence"),
        (F.length("assistant") / 1000.0).alias("latency"),
        F.when(F.col("pair_no") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("user")))
        .alias("doc_texts"))
