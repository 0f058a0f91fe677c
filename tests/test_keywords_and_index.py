"""Words found in one pass, the keyword bonus by definition, and searches over the written index."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from quarry.functions.keywords import contained
from quarry.operators import retrieve as R
from quarry.operators.knn import knn
from quarry.operators.scope import expand_queries, scope_gate
from quarry.operators.segment import tag_keywords
from quarry.sources.sinks import open_index, write_index


def _texts(n, seed):
    rnd = random.Random(seed)
    return [None if rnd.random() < 0.05 else "".join(rnd.choices(["ab", "a", "b", "c ", "第三条", "é", "", "日"], k=rnd.randint(0, 12))) for _ in range(n)]


def test_contained_equals_a_search_per_word(spark):
    words, texts = ["ab", "b", "aba", "", "第三条", "zz", "ab", "éc"], _texts(400, 1)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").withColumn("found", contained("t", words))
    for r in df.collect():
        assert r.found == ([] if r.t is None else [k for k, w in enumerate(words) if w in r.t])
    assert df.limit(1).select(contained("t", []).alias("x")).first().x == []


def test_tags_gate_and_expansion_by_definition(spark):
    groups = [("one", ["aba", "zz"]), ("none", []), ("two", ["b", "é"])]
    expansions = [("ab", ["x1", "x2"]), ("é", ["y"]), ("zz", ["never"])]
    rows = [(i, t) for i, t in enumerate(_texts(300, 2))]
    df = spark.createDataFrame(rows, "qid long, question string")
    gate = {r.qid: r for r in scope_gate(df, groups).collect()}
    tags = {r.qid: r.tags for r in tag_keywords(df, groups, "question").collect()}
    asked = {}
    for r in expand_queries(df, expansions, ["about {q}"]).orderBy("qid", "ord").collect():
        asked.setdefault(r.qid, []).append(r.query_text)
    for i, t in rows:
        hit = [label for label, words in groups if t is not None and any(w in t for w in words)]
        assert gate[i].out_of_scope == bool(hit) and gate[i].detected_domain == (hit[0] if hit else "") and tags[i] == hit
        if t is not None:
            assert asked[i] == [t, *([x for w, more in expansions if w in t for x in more] or [f"about {t}"])]


def test_bonus_by_definition(spark):
    questions = [(1, "Fee of the loan 第三条 第三条 the x"), (2, "nothing"), (3, "")]
    docs = [(i, t or "") for i, t in enumerate([*_texts(30, 3), "The fee of a LOAN, 第三条", "loan thesis"])]
    q = spark.createDataFrame(questions, "qid long, question string")
    corpus = spark.createDataFrame(docs, "doc_id long, content string")
    cands = spark.createDataFrame([(k, i, "statute") for k, _ in questions for i, _ in docs] * 2, "qid long, doc_id long, type string")
    words = ["loan", "fee", "card"]
    for est in (None, 100):
        got = {(r.qid, r.doc_id): r.bonus for r in R.keyword_bonus_table(cands, q, corpus, words, est).collect()}
        assert len(got) == len(questions) * len(docs)
        for k, question in questions:
            for i, text in docs:
                low, asked = text.lower(), question.lower()
                n = sum(w in asked and w in low for w in words)
                want = -0.5 * n - 0.5 * (n >= 2) - 2.0 * sum(a in low for a in re.findall("第三条", question)) - 0.3 * sum(
                    len(w) >= 2 and w in low for w in asked.split())
                assert abs(got[k, i] - want) < 1e-9


def test_wide_candidates_are_not_broadcast(spark):
    narrow = spark.createDataFrame([(1, 2)], "qid long, doc_id long")
    corpus = spark.createDataFrame([(2, "x")], "doc_id long, content string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = [R.attach(df, corpus, ["content"], est_rows=1)._jdf.queryExecution().toString()
                for df in (narrow, narrow.withColumn("answer", F.lit("long")))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan[0] and "BroadcastHashJoin" not in plan[1]


def test_written_index_is_pruned_and_equals_the_filtered_search(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, "c", ["statute", "case"][i % 2], ["civil", "labor", "a=b"][i % 3], rng.normal(size=6).tolist()) for i in range(120)]
    chunks = spark.createDataFrame(rows, "doc_id long, content string, type string, domain string, embedding array<double>")
    asked = spark.createDataFrame([(i, rows[i][4]) for i in range(0, 120, 17)], "qid long, qvec array<double>")
    write_index(chunks, str(tmp_path / "index"))
    got = R.search_written(spark, str(tmp_path / "index"), asked, 4, types=["statute"], domains=["civil", "a=b"])
    want = knn(chunks.where("type = 'statute' AND domain <> 'labor'"), asked, 4, exclude=("qid", "doc_id"))
    key = ["qid", "doc_id", "rk"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    scan = open_index(spark, str(tmp_path / "index")).where(F.col("type").isin(["statute"])).select("doc_id", "embedding")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*type", plan) and "content" not in plan


def test_a_folder_without_domains_is_one_collection(spark, tmp_path):
    spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "y", [0.0, 1.0])], "doc_id long, content string, embedding array<double>").write.parquet(
        str(tmp_path / "one"))
    index = open_index(spark, str(tmp_path / "one"))
    assert set(index.columns) == {"doc_id", "content", "embedding", "domain", "type"} and index.where("domain IS NULL AND type IS NULL").count() == 2
    asked = spark.createDataFrame([(9, [1.0, 0.1])], "qid long, qvec array<double>")
    assert [r.doc_id for r in R.search_written(spark, str(tmp_path / "one"), asked, 2).orderBy("rk").collect()] == [1, 2]


def test_the_head_of_a_cleaned_text_is_that_of_the_whole(spark):
    from pyspark.sql import functions as F

    from quarry.functions.text import clean_head, clean_text
    r = random.Random(5)
    texts = ["".join(r.choice("ab é字\U0001f600 \t\n\x00\x1c．　") for _ in range(r.choice([0, 5, 30, 39, 40, 41, 80, 400]))) for _ in range(400)]
    texts += [None, " " * 200 + "a" * 20, "a" * 9 + " " * 300 + "b", "\x01" * 100 + "abc" * 10, "a" * 10 + " " * 100]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~F.col("t").isNull() & (clean_head("t", 10) != F.substring(clean_text("t"), 1, 10))).count() == 0
    assert df.where("t IS NULL").select(clean_head("t", 10)).first()[0] == ""


def test_a_retrieval_key_shuffles_no_text(spark):
    from quarry.sources.quality import with_retrieval_key
    df = spark.createDataFrame([("a", "x" * 300), ("a", "y" * 300), ("b", "z")], "chunk_id string, content string")
    keyed = with_retrieval_key(df, "chunk_id", "content").select("chunk_id", "retrieval_key").hint("merge")
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("LogicalRDD")] if "LogicalRDD" in plan else plan
    joins = above[:above.index("Join")]
    assert "content" not in joins and len({r.retrieval_key for r in keyed.collect()}) == 3


def test_attached_texts_are_filtered_below_the_joins_of_the_corpus(spark):
    from quarry.operators import retrieve as R
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, content string")
    labels = spark.createDataFrame([(i, "statute") for i in range(10)], "vec_id long, type string")
    corpus = docs.join(labels, docs.doc_id % 10 == labels.vec_id).select("doc_id", "content", "type")
    small = spark.createDataFrame([(1, 7), (2, 7), (2, 49), (3, 99)], "qid long, doc_id long")
    got = R.attach(small, corpus, ["content"], est_rows=4)
    assert sorted((r.qid, r.content) for r in got.collect()) == [(1, "text 7"), (2, "text 49"), (2, "text 7")]
    lines = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {kind: min(i for i, x in enumerate(lines) if f"Join {kind}" in x) for kind in ("Inner", "LeftSemi")}
    semi = next(x for x in lines if "Join LeftSemi" in x)
    inner = [x for x in lines if "Join Inner" in x]
    assert len(inner) == 2 and semi.index("Join") > max(x.index("Join") for x in inner)
