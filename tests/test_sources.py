"""Readers and writers on small files written by the test."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import cases as C
from quarry.sources import readers, sinks


def _tmp():
    return tempfile.mkdtemp(prefix="quarry-test-")


def test_case_records_array_and_jsonl(spark):
    d = _tmp()
    recs = [{"fact": "甲" * 60, "meta": {"accusation": ["盗窃"], "relevant_articles": [264],
                                          "term_of_imprisonment": {"imprisonment": 36, "death_penalty": False,
                                                                   "life_imprisonment": False}}},
            {"fact": "乙" * 49, "accusation": ["诈骗"], "law_articles": [266], "prison_term": 12},
            {"fact": "丙" * 50, "accusation": ["诈骗"], "law_articles": [266], "prison_term": 12}]
    with open(os.path.join(d, "a.json"), "w", encoding="utf-8") as fh:
        json.dump(recs, fh, ensure_ascii=False)
    with open(os.path.join(d, "b.jsonl"), "w", encoding="utf-8") as fh:
        for r in recs:
            fh.write(json.dumps(r, ensure_ascii=False) + "\n")
        fh.write("{broken\n")
    for name in ("a.json", "b.jsonl"):
        raw = readers.case_records(spark, os.path.join(d, name))
        out = C.compose_cases(C.normalise_cases(raw)).orderBy("case_index").collect()
        assert [r.case_index for r in out] == [0, 2]                       # 49-char fact dropped
        assert out[0].content.endswith("【判决结果】有期徒刑36个月")
        assert out[1].articles_csv == "266" and out[1].accusation_csv == "诈骗"
    assert readers.case_records(spark, os.path.join(d, "a.json"), limit=1).count() == 1


def test_index_write_open_rebuild(spark):
    d = _tmp()
    root, backup = os.path.join(d, "idx"), os.path.join(d, "bak")
    df = spark.createDataFrame([(1, "x", "statute", "criminal"), (2, "y", "case", "civil")],
                               "doc_id long, content string, type string, domain string")
    sinks.write_index(df, root)
    assert sinks.open_index(spark, root).count() == 2
    new = spark.createDataFrame([(3, "z", "statute", "criminal")], df.schema)
    sinks.rebuild_domain(spark, new, root, "criminal", backup)
    got = {(r.doc_id, r.domain) for r in sinks.open_index(spark, root).collect()}
    assert got == {(3, "criminal"), (2, "civil")}
    assert {r.doc_id for r in spark.read.parquet(backup).collect()} == {1}
    try:
        sinks.open_index(spark, os.path.join(d, "absent"))
        raise AssertionError("expected an error")
    except FileNotFoundError:
        pass


def test_statute_texts_missing_file_is_skipped(spark):
    d = _tmp()
    with open(os.path.join(d, "criminal.txt"), "w", encoding="utf-8") as fh:
        fh.write("第一条　" + "内容" * 20)
    doms = spark.createDataFrame([("criminal", "刑法", "criminal.txt", 1, ""), ("civil", "民法", "civil.txt", 2, "")],
                                 "domain string, name string, file string, priority int, description string")
    rows = readers.statute_texts(spark, doms, d).collect()
    assert [r.domain for r in rows] == ["criminal"]


def test_eval_samples_defaults_and_fallback(spark):
    d = _tmp()
    p = os.path.join(d, "e.jsonl")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(json.dumps({"question": "q"}) + "\n")
    r = readers.eval_samples(spark, p).collect()[0]
    assert (r.ground_truth, r.expected_sources, r.category) == ("", [], "general")
    fb = spark.createDataFrame([("q", "", [], "general")], "question string, ground_truth string, "
                               "expected_sources array<string>, category string")
    assert readers.eval_samples(spark, os.path.join(d, "none.jsonl"), fallback=fb).count() == 1


def test_binary_text_file_quality(spark):
    from quarry.sources import quality as Q
    d = _tmp()
    with open(os.path.join(d, "good.txt"), "w", encoding="utf-8") as fh:
        fh.write("标题\n\n第一条 " + "内容" * 400 + "\n第一章 总则\n第二条 内容\n")
    with open(os.path.join(d, "bad.txt"), "wb") as fh:
        fh.write(b"\xff\xfe broken " * 200 + b"\nline\nline\n")
    with open(os.path.join(d, "small.txt"), "w", encoding="utf-8") as fh:
        fh.write("a\nb\nc\n")
    files = Q.binary_text_files(spark, os.path.join(d, "*.txt"))
    rows = {os.path.basename(r.file): r for r in
            Q.text_file_quality(files, bytes_col="size_bytes", valid_col="utf8").collect()}
    assert rows["good.txt"].passed and rows["good.txt"].has_articles and rows["good.txt"].has_chapters
    assert rows["bad.txt"].reason == "not_utf8"
    assert rows["small.txt"].reason == "too_small"
    s = Q.quality_summary(Q.text_file_quality(files, bytes_col="size_bytes", valid_col="utf8")).collect()[0]
    assert (s.passed, s.total, s.all_passed) == (1, 3, False)


def test_case_records_bom_folder_and_no_default_limit(spark):
    d = _tmp()
    rec = {"fact": "甲" * 60, "accusation": ["盗窃"], "law_articles": [1], "prison_term": 2}
    for name, lead in (("a", b"\xef\xbb\xbf\n "), ("b", b"\n" * 100)):
        with open(os.path.join(d, f"{name}.json"), "wb") as fh:
            fh.write(lead + json.dumps([rec, rec]).encode())
        assert readers.case_records(spark, "file://" + os.path.join(d, f"{name}.json")).count() == 2
    folder = os.path.join(d, "many")
    os.makedirs(folder)
    for k in range(2):
        with open(os.path.join(folder, f"{k}.jsonl"), "w") as fh:
            fh.write((json.dumps(rec) + "\n") * 3)
    assert sorted(r.case_index for r in readers.case_records(spark, folder).collect()) == list(range(6))
    assert readers.case_records(spark, folder, limit=0).count() == 0


def test_rebuild_removes_partitions_that_are_gone_and_upsert_reads_uris(spark):
    d = _tmp()
    root, schema = "file://" + os.path.join(d, "idx"), "chunk_id long, content string, type string, domain string"
    old = spark.createDataFrame([(1, "x", "statute", "a=b"), (2, "y", "case", "a=b"), (3, "z", "case", "c")], schema)
    assert sinks.upsert_index(spark, old, root).count() == 3
    sinks.write_index(old, root, "chunk_id")
    assert sinks.upsert_index(spark, old, root).count() == 0
    sinks.rebuild_domain(spark, spark.createDataFrame([(4, "n", "statute", "a=b")], schema), root, "a=b", os.path.join(d, "bak"))
    assert {(r.chunk_id, r.domain) for r in sinks.open_index(spark, root).collect()} == {(4, "a=b"), (3, "c")}


def test_empty_meta_is_flat_and_empty_term_has_no_verdict(spark):
    d = _tmp()
    recs = [{"fact": "甲" * 60, "meta": {}, "accusation": ["盗窃"], "law_articles": [264], "prison_term": 7},
            {"fact": "乙" * 60, "meta": {"accusation": ["诈骗"], "term_of_imprisonment": {}}}]
    with open(os.path.join(d, "a.jsonl"), "w", encoding="utf-8") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in recs)
    out = C.compose_cases(C.normalise_cases(readers.case_records(spark, os.path.join(d, "a.jsonl")))).orderBy("case_index").collect()
    assert out[0].accusation_csv == "盗窃" and out[0].content.endswith("有期徒刑7个月")
    assert out[1].accusation_csv == "诈骗" and "判决结果" not in out[1].content


def test_colliding_ids_are_found_and_both_texts_stay(spark):
    from quarry.functions.text import stable_id
    from quarry.sources.quality import id_collisions, with_retrieval_key
    head = "甲" * 100
    rows = [(1, "s", head + "one"), (2, "s", head + "two"), (3, "s", head + "one"), (4, "t", head + "one"), (5, "s", "short"), (6, "s", None)]
    df = spark.createDataFrame(rows, "n int, source string, content string").withColumn("chunk_id", stable_id(F.col("content"), F.col("source")))
    got = id_collisions(df).collect()
    assert [(r.n_contents, r.n_rows) for r in got] == [(2, 3)]
    keyed = {r.n: r.retrieval_key for r in with_retrieval_key(df).collect()}
    assert keyed[1] == keyed[3] != keyed[2] and keyed[4] != keyed[1] and "-" not in keyed[5] and keyed[6] is None and len(set(keyed.values())) == 5
    assert with_retrieval_key(df).dropDuplicates(["retrieval_key"]).select("content").distinct().count() == df.select("content").distinct().count()


def test_hallucination_rate_of_what_is_answered(spark):
    from quarry.operators.evaluate import metrics
    base = {"is_correct": True, "confidence": 0.5, "citation_precision": 1.0, "citation_recall": 1.0, "citation_f1": 1.0, "relevance_score": 0.5, "latency": 1.0}
    rows = [{**base, "category": c, "has_hallucination": h} for c, h in (("out_of_scope", True), ("out_of_scope", True), ("general", True), ("general", False), (None, False))]
    df = spark.createDataFrame(rows)
    r = metrics(df).first()
    assert r.hallucination_rate == 0.6 and abs(r.hallucination_rate_answered - 1 / 3) < 1e-12
    assert metrics(df.withColumn("answered", F.col("category") == "general")).first().hallucination_rate_answered == 0.5
    assert metrics(df.where("category = 'out_of_scope'")).first().hallucination_rate_answered is None
