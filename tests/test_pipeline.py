"""Answer pipeline on a hand-built index; model callables; report sink."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry.operators import models as M
from quarry.plans.pipeline import answer_pipeline
from quarry.sources import sinks


def _index(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, content string, type string, domain string, domain_name string, "
                                       "source string, article string, accusation string, embedding array<float>")


def test_pipeline_statuses_and_warning(spark):
    corpus = _index(spark, [
        (1, "第1条 如果行为人盗窃他人财物，数额较大的，处三年以下有期徒刑。" * 2, "statute", "criminal", "刑法",
         "刑法", "第1条", "", [1.0, 0.0]),
    ])
    qs = spark.createDataFrame([(10, "盗窃怎么处罚", [1.0, 0.0]), (11, "is there parking", [1.0, 0.0]),
                                (12, "问题", [-1.0, 0.0])], "qid long, question string, qvec array<float>")
    out = {r.qid: r for r in answer_pipeline(qs, corpus, None, scope_groups=L.EXAMPLE_SCOPE_GROUPS,
                                             rerank_words=L.EXAMPLE_RERANK_WORDS).collect()}
    assert out[11].status == "out_of_scope" and out[11].confidence == pytest.approx(0.1)
    assert out[11].detected_domain == "parking"
    assert out[12].status == "low_relevance" and out[12].confidence == pytest.approx(0.2)   # distance 4 -> 0
    a = out[10]
    assert a.status == "answered" and a.n_docs == 1 and a.citations == "刑法(第1条)"
    # one document: the check policy asks for a check; the hedging word gives medium risk
    assert "⚠️" in a.answer and "medium" in a.answer
    # 0.4*1 + 0.4*1 + 0.2*(1/8) + 0.1 = 0.925
    assert a.confidence == pytest.approx(0.93) and a.is_uncertain is False


def test_embed_with_callable_retries_and_errors(spark):
    calls = {"n": 0}

    def fn(texts):
        calls["n"] += 1
        if any(t == "bad" for t in texts):
            raise ValueError("model refused")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(1, "ab"), (2, "bad"), (3, "abc")], "id long, text string").coalesce(1)
    out = {r.id: r for r in M.embed(df, "text", fn, batch_size=1).collect()}
    assert out[1].embedding == [2.0, 1.0] and out[3].embedding == [3.0, 1.0]
    assert out[2].embedding is None and "model refused" in out[2].embed_error      # kept, not dropped


def test_default_embedding_column_equals_table_form(spark):
    df = spark.createDataFrame([(1, "The law, the LAW and order."), (2, "")], "id long, text string")
    a = {r.id: r.e for r in df.select("id", M.hashed_embedding(F.col("text"), 16).alias("e")).collect()}
    b = {r.id: r.embedding for r in M.hashed_embeddings(df, "id", "text", 16).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])
    assert sum(x * x for x in a[1]) == pytest.approx(1.0)


def test_generate_with_callable(spark):
    df = spark.createDataFrame([(1, "p1"), (2, "p2")], "id long, prompt string")
    out = M.generate(df, "prompt", lambda ps: [p.upper() for p in ps]).orderBy("id").collect()
    assert [r.answer for r in out] == ["P1", "P2"]


def test_save_report(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-report-")
    m = spark.createDataFrame([(0.5, 2)], "accuracy double, n long")
    s = spark.createDataFrame([("问题", True)], "question string, is_correct boolean")
    sinks.save_report(m, s, d)
    assert spark.read.json(os.path.join(d, "samples")).collect()[0].question == "问题"
    assert spark.read.json(os.path.join(d, "metrics")).collect()[0].accuracy == 0.5


def test_rate_limits_and_short_replies(spark):
    assert M.is_rate_limited(Exception("429 Too Many Requests")) and M.is_rate_limited(Exception("Rate limit exceeded"))
    assert not M.is_rate_limited(Exception("failed to generate")) and not M.is_rate_limited(Exception("context length limit"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string").coalesce(1)
    out = M.embed(df, "text", lambda texts: [[1.0]], batch_size=2).collect()
    assert all(r.embedding is None and "1 vectors for 2 texts" in r.embed_error for r in out)


def test_pipeline_with_model_callables(spark):
    corpus = _index(spark, [(100 + i, f"text {i} " * 20, "statute" if i % 2 else "case", "criminal", "d", f"src{i}", "", "", v)
                            for i, v in enumerate([[1.0, 0.0], [0.0, 1.0], [0.9, 0.1], [0.1, 0.9]])])
    qs = spark.createDataFrame([(1, "renew my loan", [1.0, 0.0]), (2, "is there parking", [1.0, 0.0]), (3, "what is a tort", [1.0, 0.0]),
                                (4, "overdue", [1.0, 0.0])], "qid long, question string, qvec array<float>")
    replies = spark.createDataFrame([(3, '{"domain": "other", "confidence": 0.9}'), (4, '{"domain": "other", "confidence": 0.6}')],
                                    "qid long, reply string")
    history = spark.createDataFrame([(1, "User: hello")], "qid long, history_text string")
    cached = []
    out = {r.qid: r for r in answer_pipeline(
        qs, corpus, None, scope_groups=L.EXAMPLE_SCOPE_GROUPS, rerank_words=L.EXAMPLE_RERANK_WORDS, min_relevance=0.0, cached=cached,
        scope_replies=replies, expansions=L.EXAMPLE_EXPANSIONS, templates=["{q} rules"], history=history, structured=True,
        embed_fn=lambda texts: [[0.0, 1.0] if "renewal" in t else [1.0, 0.0] for t in texts],
        generate_fn=lambda prompts: [p.upper() for p in prompts]).collect()}
    assert {q: r.status for q, r in out.items()} == {1: "answered", 2: "out_of_scope", 3: "out_of_scope", 4: "answered"}
    assert out[3].detected_domain == "other" and out[2].citation_list is None
    assert "USER: HELLO" in out[1].answer and "RENEW MY LOAN" in out[1].answer and "(NO HISTORY)" in out[4].answer
    assert {c.source for c in out[1].citation_list} == {"src0", "src1", "src2", "src3"}
    assert [c.pos for c in out[1].citation_list] == [1, 2, 3, 4] and out[1].citation_list[0].doc_type == "statute"
    for table in cached:
        table.unpersist()
