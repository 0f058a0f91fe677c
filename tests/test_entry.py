"""The driver contract: entry runs; every oracle key is a query key."""

import __spark_entry__ as ent


def test_entry_runs(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["qid", "status", "detected_domain", "n_docs", "doc_ids", "confidence", "is_uncertain",
                          "answer", "citations"]


def test_registry_shape():
    qs, sqls = ent.queries(), ent.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 60
