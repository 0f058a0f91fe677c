"""Run the answer pipeline on evaluation samples and score what it answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import checks as H
from quarry.operators import evaluate as E
from quarry.plans.pipeline import answer_pipeline


def score(rows: DataFrame, lex: E.EvalLexicon = E.DEFAULT, check_lex: H.CheckLexicon = H.DEFAULT) -> DataFrame:
    """Adds the four scores to rows of (predicted_answer, ground_truth, category, citations, expected_sources,
    doc_texts, question)."""
    prf = E.citation_prf("citations", "expected_sources", lex)
    return rows.withColumn("_v", prf).select(
        *rows.columns,
        E.correctness("predicted_answer", "ground_truth", "category", lex).alias("is_correct"),
        F.col("_v.precision").alias("citation_precision"), F.col("_v.recall").alias("citation_recall"),
        F.col("_v.f1").alias("citation_f1"),
        H.eval_hallucination("predicted_answer", "doc_texts", "ground_truth", check_lex).alias("has_hallucination"),
        E.relevance("predicted_answer", "question", "ground_truth", lex).alias("relevance_score"))


def evaluate_system(samples: DataFrame, corpus: DataFrame, judge: DataFrame | None, *, lex: E.EvalLexicon = E.DEFAULT,
                    check_lex: H.CheckLexicon = H.DEFAULT, **pipeline) -> DataFrame:
    """Scored results of the answer pipeline; samples are (qid, question, qvec, ground_truth, category, expected_sources).

    The documents of an answer are the texts of its citations, as the citation list holds them.
    """
    answers = answer_pipeline(samples.select("qid", "question", "qvec"), corpus, judge, structured=True, **pipeline)
    texts = F.coalesce(F.transform("citation_list", lambda c: c["content"]), F.array().cast("array<string>"))
    found = answers.select("qid", "status", "confidence", F.col("answer").alias("predicted_answer"), texts.alias("doc_texts"),
                           F.when(F.col("citations") == "", F.array().cast("array<string>"))
                           .otherwise(F.split("citations", r" \| ")).alias("citations"))
    return score(samples.drop("qvec").join(found, "qid"), lex, check_lex)
