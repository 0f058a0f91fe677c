"""The fused per-question step equals the stage-by-stage operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import fused
from quarry.operators import rank as K
from quarry.operators import retrieve as R


def _setup(spark, only_cases=False, seed=5):
    rng = np.random.default_rng(seed)
    n, q, dim = 240, 12, 6
    c = rng.normal(size=(n, dim))
    rows = [(i, f"text {i} the and {'tion' if i % 3 else ''}", ("case" if only_cases or i % 2 else "statute"),
             ["criminal", "civil", "labor"][i % 3], f"src{i % 4}", "", "", c[i].tolist()) for i in range(n)]
    corpus = spark.createDataFrame(rows, "doc_id long, content string, type string, domain string, source string, "
                                         "article string, accusation string, embedding array<double>")
    qs = spark.createDataFrame([(1000 + i, "the tion question", rng.normal(size=dim).tolist()) for i in range(q)],
                               "qid long, question string, qvec array<double>")
    judge = spark.createDataFrame([(i, float(i % 11), i % 4 != 0) for i in range(0, n, 2)],
                                  "doc_id long, score double, relevant boolean")
    qrows = qs.select("qid", F.lit(0).cast("bigint").alias("ord"), "qvec")
    if only_cases:   # statutes absent and cases only from a non-original query: both branches empty
        qrows = qrows.withColumn("ord", F.lit(1).cast("bigint")).unionByName(qrows)
    pool = R.pool(corpus, qrows, R.fetch_size(16))
    return corpus, qs, judge, pool


def _rows(df):
    return sorted((r.qid, r.pos, r.doc_id, round(r.distance, 9)) for r in df.collect())


@pytest.mark.parametrize("with_judge", [True, False])
def test_fused_equals_stagewise(spark, with_judge):
    corpus, qs, judge, pool = _setup(spark)
    words = ["the", "tion"]
    bonus = R.keyword_bonus_table(R.hybrid_candidates(pool, 16), qs, corpus, words)
    d16 = R.hybrid(pool, bonus, qs, 16)
    d8 = R.hybrid(pool, bonus, qs, 8)
    want = K.rerank_policy(d16, d8, judge) if with_judge else d16.where(F.col("pos") <= 8)
    got = fused.final_docs(pool, bonus, judge if with_judge else None)
    assert _rows(got) == _rows(want)


def test_fused_fallback(spark):
    corpus, qs, judge, pool = _setup(spark)
    base = pool.where(F.col("ord") == 0)
    # neither branch can use these rows (cases only at ord 1, ord-0 rows of another type):
    # every question falls back to its unfiltered top-k of the original query
    pool = base.withColumn("ord", F.lit(1).cast("bigint")).where(F.col("type") == "case") \
        .unionByName(base.withColumn("type", F.lit("other")))
    bonus = R.keyword_bonus_table(R.hybrid_candidates(pool, 16), qs, corpus, ["the"])
    want = R.hybrid(pool, bonus, qs, 16).where(F.col("pos") <= 8)
    got = fused.final_docs(pool, bonus, None)
    rows = _rows(got)
    assert rows == _rows(want) and len(rows) == 12 * 8
