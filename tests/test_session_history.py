"""The answer stream feeds its answers back into later prompts of their session."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry import lexicon as L
from quarry.operators import answer as A
from quarry.session import scratch_path
from quarry.streaming import answers as SA
from quarry.streaming.operators import render_history
from quarry.streaming.session_history import Turns, generate_in_sessions

ASK = "qid long, session string, ord long, question string, context string, answer string"
PAST = "session string, batch_id long, ord long, qid long, question string, answer string"
TEMPLATE = "{context}|{history}|{question}"


def _corpus(spark):
    rows = [(100 + i, f"text {i} " * 20, "statute" if i % 2 else "case", "criminal", "d", f"src{i}", "", "", v)
            for i, v in enumerate([[1.0, 0.0], [0.9, 0.1]])]
    return spark.createDataFrame(rows, "doc_id long, content string, type string, domain string, domain_name string, "
                                       "source string, article string, accusation string, embedding array<float>")


def test_generation_goes_through_a_session_in_order(spark):
    model = lambda prompts: [f"<{p.rsplit('|', 1)[1]}>" for p in prompts]   # noqa: E731 - pickled by value
    rows, want = [], {}
    said = {"a": (["q0", "q{history}"], ["old0", ""])}
    for i in range(300):
        session = "a" if i % 3 else f"s{i % 7}"
        fixed = f"refused {i}" if i % 10 == 4 else None
        rows.append((i, session, i, f"ask {i}" if i % 11 else None, f"ctx {i}", fixed))
        q, a = said.setdefault(session, ([], []))
        prompt = None if fixed else f"ctx {i}|{render_history(q[-15:], a[-15:])}|{rows[-1][3] or ''}"
        want[i] = (prompt, fixed or f"<{rows[-1][3] or ''}>")
        said[session] = (q + [rows[-1][3] or ""], a + [want[i][1]])
    rows += [(900, None, 0, "lone", "c", None), (901, None, 1, "lone", "c", None)]
    past = spark.createDataFrame([("a", 0, 5, 1, "q0", "old0"), ("a", 1, 1, 2, "q{history}", None), ("other", 0, 1, 3, "x", "y")], PAST)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "32")
    try:
        got = {r.qid: (r.prompt, r.answer) for r in
               generate_in_sessions(spark.createDataFrame(rows, ASK), past, model, TEMPLATE).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.pop(900) == got.pop(901) == (f"c|{A.NO_HISTORY}|lone", "<lone>")
    assert got == want
    assert generate_in_sessions(spark.createDataFrame([], ASK), past, model, TEMPLATE).count() == 0


def test_turns_of_earlier_batches_only(spark):
    turns = Turns(spark, scratch_path(spark, tempfile.mktemp(prefix="turns-", dir="")), keep=3, every=4)
    asked = "qid long, session string, ord long, question string, answer string"

    def write(b, mark=""):
        turns.write(b, spark.createDataFrame([(b * 10 + j, f"s{j % 2}", j, f"q{mark}", f"a{b}") for j in range(3)], asked))

    def last(b, n=3):
        rows = turns.before(b).where("session = 's0'").orderBy(F.desc("batch_id"), F.desc("ord")).limit(n).collect()
        return [(r.batch_id, r.ord) for r in rows]
    assert last(0) == []
    for b in range(10):
        write(b)
    assert last(3) == [(2, 2), (2, 0), (1, 2)] and last(4) == [(3, 2), (3, 0), (2, 2)]
    assert last(10) == [(9, 2), (9, 0), (8, 2)] and last(8) == [(7, 2), (7, 0), (6, 2)]
    assert turns.before(8).where("session = 's0'").count() == 3     # the snapshot alone
    before = sorted(map(tuple, turns.before(7).collect()))
    write(7, " again")                                              # replayed: earlier batches stay, its own rows are replaced
    assert sorted(map(tuple, turns.before(7).collect())) == before
    assert {r.question for r in turns.before(8).where("batch_id = 7").collect()} == {"q again"}


def test_second_batch_sees_the_first_answer_and_a_replay_changes_nothing(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quarry-test-sessions-"), "q")
    schema = "qid long, question string, qvec array<float>, conv string"
    batches = [[(1, "renew my loan", [1.0, 0.0], "x"), (2, "is there parking", [1.0, 0.0], "x"), (3, "overdue loan", [1.0, 0.0], "x"),
                (4, "lost loan", [1.0, 0.0], "y")],
               [(5, "another loan", [1.0, 0.0], "x"), (6, "last loan", [1.0, 0.0], "z")]]
    for k, rows in enumerate(batches):
        path = os.path.join(d, f"part-{k}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(os.path.join(path, f), (1_700_000_000 + k, 1_700_000_000 + k))
    kw = dict(scope_groups=L.EXAMPLE_SCOPE_GROUPS, rerank_words=L.EXAMPLE_RERANK_WORDS, min_relevance=0.0,
              prompt_template=TEMPLATE, generate_fn=lambda prompts: [f"[{p.split('|', 1)[1]}]" for p in prompts])
    questions = SA.file_stream(spark, os.path.join(d, "*"), spark.createDataFrame([], schema).schema)
    table = SA.answer_stream(questions, _corpus(spark), None, "t-sessions", session="conv", **kw)
    out = {r.qid: r for r in table.collect()}
    assert {q: r.batch_id for q, r in out.items()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1}
    assert out[1].said == f"[{A.NO_HISTORY}|renew my loan]" and out[2].status == "out_of_scope"
    assert out[4].said == f"[{A.NO_HISTORY}|lost loan]" and out[6].said == f"[{A.NO_HISTORY}|last loan]"
    assert out[3].said == f"[{render_history(['renew my loan', 'is there parking'], [out[1].said, out[2].said])}|overdue loan]"
    three = render_history(["renew my loan", "is there parking", "overdue loan"], [out[q].said for q in (1, 2, 3)])
    assert out[5].said == f"[{three}|another loan]" and f"{A.ASSISTANT_LABEL}[{A.NO_HISTORY}|renew" in out[5].said
    # replay of the second batch against the same history
    sink = os.path.dirname(os.path.dirname(table.inputFiles()[0].replace("file://", "")))
    turns = Turns(spark, os.path.join(os.path.dirname(sink), "history"))
    before = sorted(map(str, turns.before(2).collect()))
    batch = spark.createDataFrame(batches[1], schema)
    SA.answer_batch(batch, 1, _corpus(spark), None, sink, turns, "conv", **kw)
    assert sorted(map(str, spark.read.parquet(sink).collect())) == sorted(map(str, out.values()))
    assert sorted(map(str, turns.before(2).collect())) == before and len(before) == 6
