"""Hand-worked values of the answering and evaluation rules (FIXTURES.md A9)."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import clean_text
from quarry.operators import cases as C
from quarry.operators import checks as H
from quarry.operators import evaluate as E
from quarry.operators import rank as K
from quarry.operators import retrieve as R
from quarry.operators import segment as G
from quarry.streaming import operators as W


def one(df):
    return df.collect()[0]


def test_clean_text(spark):
    df = spark.createDataFrame([(" a  b\tc ",), (None,), ("x\x01 ．y　　z",)], "t string")
    assert [r[0] for r in df.select(clean_text(F.col("t"))).collect()] == ["a b c", "", "x .y z"]


def test_pack_sentences_limit_4(spark):
    df = spark.createDataFrame([("甲。乙；丙丙丙。", "第1条", "id")], "content string, article string, chunk_id string")
    rows = G.pack_sentences(df, max_len=4).orderBy("part").collect()
    assert [r.content for r in rows] == ["甲。乙；", "丙丙丙。"]
    assert [r.article for r in rows] == ["第1条(第1部分)", "第1条(第2部分)"]
    assert [r.chunk_id for r in rows] == ["id_0", "id_1"]


def test_pack_oversize_sentence_kept_whole(spark):
    text = "长" * 10 + "。"
    df = spark.createDataFrame([(text, "a", "i")], "content string, article string, chunk_id string")
    rows = G.pack_sentences(df, max_len=4).collect()
    assert [(r.content, r.article, r.chunk_id) for r in rows] == [(text, "a", "i")]


def test_verdict(spark):
    df = spark.createDataFrame([((36, False, False),), ((0, True, False),), ((5, False, True),), ((0, False, False),),
                                (None,)], f"term {C.TERM_TYPE}")
    assert [r[0] for r in df.select(C.verdict("term")).collect()] == ["有期徒刑36个月", "死刑", "无期徒刑", "其他刑罚", None]


def test_quotas():
    assert R.quotas(16) == (9, 9)
    assert R.quotas(8) == (5, 5)


def test_relevance_forms(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,)], "d double")
    a = [r[0] for r in df.select(K.relevance_clamped(F.col("d"))).collect()]
    b = [r[0] for r in df.select(K.relevance_floor(F.col("d"))).collect()]
    assert a == b == [1.0, 0.5, 0.0, 0.0]


def _stats(spark, rows):
    df = spark.createDataFrame(rows, "qid long, doc_id long, type string, distance double")
    return K.doc_stats(df)


def test_relevance_gate(spark):
    s = _stats(spark, [(1, 1, "statute", 0.6), (2, 2, "statute", 0.8), (3, 3, "case", 0.1)])
    got = {r.qid: r.low for r in s.select("qid", K.low_relevance(s).alias("low")).collect()}
    assert got == {1: False, 2: True, 3: True}


def test_confidence(spark):
    s = _stats(spark, [(1, 1, "statute", 0.4), (1, 2, "case", 0.8)] + [(2, i, "statute", 0.0) for i in range(8)])
    got = {r.qid: r.c for r in s.select("qid", K.confidence().alias("c")).collect()}
    assert got == {1: 0.75, 2: 0.95}


@pytest.mark.parametrize("exp,pred,want", [
    ([], ["x"], (1.0, 1.0, 1.0)),
    ([], [], (0.0, 0.0, 0.0)),
    (["a"], ["a", "z"], (0.5, 1.0, 2 / 3)),
])
def test_citation_f1(spark, exp, pred, want):
    df = spark.createDataFrame([(pred, exp)], "p array<string>, e array<string>")
    r = one(df.select(E.citation_prf("p", "e").alias("v")).select("v.*"))
    assert (r.precision, r.recall) == pytest.approx(want[:2]) and r.f1 == pytest.approx(want[2])


def test_citation_keyword_scan_stops_at_direct_match(spark):
    # expected mentions a statute; predictions: keyword match, keyword match, direct match, keyword
    df = spark.createDataFrame([(["刑法第1条", "法条X", "abc", "刑法Y"], ["abc 条"])], "p array<string>, e array<string>")
    r = one(df.select(E.citation_prf("p", "e").alias("v")).select("v.*"))
    # "abc" is contained in "abc 条": scan = kw, kw, direct -> 3 matches
    assert r.precision == pytest.approx(0.75) and r.recall == pytest.approx(1.0)


def test_relevance_without_truth(spark):
    df = spark.createDataFrame([("x", "x y", "")], "a string, q string, g string")
    lex = E.EvalLexicon(stopwords=())
    assert one(df.select(E.relevance("a", "q", "g", lex)))[0] == pytest.approx(0.5)


@pytest.mark.parametrize("answer,want", [("第1条 第2条", False), ("第1条 第2条 第3条", True)])
def test_eval_hallucination(spark, answer, want):
    df = spark.createDataFrame([(answer, ["见第1条"], "")], "a string, d array<string>, g string")
    assert one(df.select(H.eval_hallucination("a", "d", "g")))[0] is want


def test_ttl_reuse(spark):
    rows = [(i, "k", t) for i, t in enumerate([0, 6, 10, 12, 20])]
    df = spark.createDataFrame(rows, "id long, key string, t long").withColumn(
        "ts", F.timestamp_seconds("t"))
    got = {r.id: r.hit for r in W.ttl_reuse(df, ["key"], "ts", "id", 10).collect()}
    assert [got[i] for i in range(5)] == [False, True, True, False, True]


def test_rate_schedule(spark):
    df = spark.createDataFrame([(0, "u", 0), (1, "u", 1), (2, "u", 12)], "id long, key string, t long") \
        .withColumn("ts", F.timestamp_seconds("t"))
    got = {r.id: r.start_s for r in W.rate_schedule(df, "key", "ts", "id", 5.0).collect()}
    assert [got[i] for i in range(3)] == [0.0, 5.0, 12.0]


def test_backoff_schedule():
    from quarry.operators.models import backoff_schedule
    assert backoff_schedule(5) == [10, 20, 40, 80, 120]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_SRC = st.lists(st.sampled_from(["刑法", "第1条", "案例", "cail", "abc", "【x】", "(y)", "", "Statute", "z"]), max_size=5)


@settings(max_examples=20, deadline=None)
@given(_SRC, _SRC)
def test_citation_prf_bounds(spark, pred, exp):
    df = spark.createDataFrame([(pred, exp)], "p array<string>, e array<string>")
    r = one(df.select(E.citation_prf("p", "e").alias("v")).select("v.*"))
    for x in (r.precision, r.recall, r.f1):
        assert 0.0 <= x <= 1.0
    if r.precision + r.recall > 0:
        assert r.f1 == pytest.approx(2 * r.precision * r.recall / (r.precision + r.recall))


def test_relevance_of_chinese_answers_and_own_tokenizer(spark):
    from quarry.operators import evaluate as E
    df = spark.createDataFrame([("盗窃罪判几年", "盗窃罪判三年以下", "盗窃罪判三年")], "q string, a string, t string")
    got, own = df.select(E.relevance("a", "q", "t"), E.relevance("a", "q", "t", tokenize_fn=lambda c: F.split(c, ""))).first()
    # pairs: q 5 (3 shared), t 5 (all shared); characters: q 6 (5 shared), t 6 (all shared)
    assert got == pytest.approx(0.4 * 3 / 5 + 0.6) and own == pytest.approx(0.4 * 5 / 6 + 0.6)
