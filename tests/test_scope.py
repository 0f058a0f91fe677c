"""Scope gate, model verdicts, expansion and reply parsing with the Chinese defaults."""

from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry.operators import scope as G


def test_first_group_in_declared_order_wins(spark):
    qs = spark.createDataFrame([(1, "parking at the cafe on a holiday"), (2, "how do I renew a loan"), (3, "cafe near the bicycle stand")],
                               "qid long, question string")
    got = {r.qid: (r.out_of_scope, r.detected_domain) for r in G.scope_gate(qs, L.EXAMPLE_SCOPE_GROUPS).collect()}
    assert got == {1: (True, "opening hours"), 2: (False, ""), 3: (True, "parking")}


def test_verdict_defaults_and_combination(spark):
    replies = spark.createDataFrame([
        (1, '好的\n{"domain": "民法",\n "confidence": 0.9}\n完毕'),   # prose + multi-line JSON
        (2, '{"domain": "民法", "confidence": 0.6}'),                 # out of scope but not confident
        (3, '{"confidence": 0.8}'),                                   # no domain -> served domain
        (4, "没有 JSON"),                                             # no JSON -> default
        (5, '{"domain": '),                                           # broken JSON -> default
        (6, None),
    ], "qid long, reply string")
    v = {r.qid: r for r in G.scope_verdict(replies).collect()}
    assert (v[1].is_in_scope, v[1].verdict_confidence, v[1].verdict_domain) == (False, 0.9, "民法")
    assert (v[3].is_in_scope, v[3].verdict_domain) == (True, "刑法")
    for q in (4, 5, 6):
        assert (v[q].is_in_scope, v[q].verdict_confidence, v[q].verdict_domain) == (True, 0.5, "未知")
    j = G.scope_verdict(replies).withColumn("out_of_scope", F.lit(False)).withColumn("detected_domain", F.lit(""))
    c = {r.qid: (r.out_of_scope, r.detected_domain) for r in G.combine_scope(j).collect()}
    assert c[1] == (True, "民法") and c[2] == (False, "")


def test_expansion_order_templates_and_cap(spark):
    qs = spark.createDataFrame([(1, "renew an overdue book"), (2, "什么是罪")], "qid long, question string")
    rows = G.expand_queries(qs, L.EXAMPLE_EXPANSIONS, L.EXPANSION_TEMPLATES).orderBy("qid", "ord").collect()
    one = [r.query_text for r in rows if r.qid == 1]
    assert one == ["renew an overdue book", "overdue items and fees", "late return rules", "renewal of a loan"]   # declared order
    two = [r.query_text for r in rows if r.qid == 2]
    assert two == ["什么是罪", "刑法 什么是罪 处罚", "什么是罪 有期徒刑 罚金"]
    capped = G.expand_queries(qs, L.EXAMPLE_EXPANSIONS, L.EXPANSION_TEMPLATES, max_expansions=2)
    assert capped.where("qid = 1").count() == 2
