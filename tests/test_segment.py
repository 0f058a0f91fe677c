"""Statute segmentation on a hand-written Chinese text, and packing properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import segment as G

TEXT = "\n".join([
    "中华人民共和国示例法",
    "（二〇二〇年通过）为了规范示例行为，保护当事人的合法权益，根据宪法，制定本法。本法适用于全国范围内的所有示例活动，"
    "包括但不限于各类示例行为的认定、处理以及相关的监督管理工作，国务院有关部门应当依照本法履行职责。",
    "第一章 总则",
    "第一条　为了测试分条功能，制定本条，其内容需要超过二十个字符才能保留。",
    "第二条　短条文。",
    "第三条之一　这是带有之一后缀的条文，内容也需要足够长以便保留下来。",
    "第二章 分则",
    "第4条 阿拉伯数字编号的条文，同样需要足够长的内容才可以保留。",
])


def test_segment_articles(spark):
    df = spark.createDataFrame([(1, "示例法", TEXT)], "file_id long, domain_name string, text string")
    rows = {r.article: r for r in G.segment_articles(df).collect()}
    assert set(rows) == {"前言", "第一条", "第三条之一", "第4条"}          # 第二条 is <= 20 chars
    assert rows["第一条"].chapter == "第一章 总则"
    assert rows["第三条之一"].chapter == "第一章 总则"
    assert rows["第4条"].chapter == "第二章 分则"
    assert rows["第4条"].content.startswith("【第二章 分则】第4条 阿拉伯数字")
    assert "第二章" not in rows["第三条之一"].body                        # headings leave bodies
    assert len(rows["第一条"].chunk_id) == 12


def test_contents_page_is_not_a_preamble(spark):
    toc = "目　　录\n" + "第一章 总则 " * 30 + "\n第一条　" + "内容" * 20
    df = spark.createDataFrame([(1, "x", toc)], "file_id long, domain_name string, text string")
    assert [r.article for r in G.segment_articles(df).collect()] == ["第一条"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="甲乙丙丁 ", min_size=0, max_size=9), min_size=1, max_size=12),
       st.integers(min_value=3, max_value=20))
def test_packing_properties(spark, sentences, limit):
    text = "".join(s + "。" for s in sentences)
    df = spark.createDataFrame([(text, "a", "i")], "content string, article string, chunk_id string")
    parts = [r.content for r in G.pack_sentences(df, max_len=limit).orderBy("part").collect()]
    if len(text) <= limit:
        assert parts == [text]
        return
    for p in parts:                                   # within the limit unless one sentence is longer
        assert len(p) <= limit or p.count("。") <= 1
    assert "".join(parts).replace(" ", "") == text.replace(" ", "")


def test_anchors_anywhere_and_linear_time(spark):
    import time

    from quarry.operators import segment as G
    body = "本条规定的内容应当足够长以便保留下来成为一条"
    text = f"第一章 总则\n第一条 {body}见第二条{body}\n第二条 {body}\n第二章 分则\n第三条 {body}"
    df = spark.createDataFrame([("d", text), ("e", None), ("f", "")], "domain_name string, text string")
    line = G.segment_articles(df).orderBy("pos").collect()
    assert [(r.article, r.chapter) for r in line] == [("第一条", "第一章 总则"), ("第二条", "第一章 总则"), ("第三条", "第二章 分则")]
    some = G.segment_articles(df, anchor="anywhere").orderBy("pos").collect()
    assert [(r.pos, r.article, r.chapter) for r in some] == [
        (1, "第一条", "第一章 总则"), (2, "第二条", "第一章 总则"), (3, "第二条", "第一章 总则"), (4, "第三条", "第二章 分则")]
    seconds = []
    for n in (10_000, 100_000):      # one file; a heading for every tenth article
        big = "\n".join(("第一章 总则\n" if k % 10 == 0 else "") + f"第{k}条 {body}" for k in range(n))
        one = spark.createDataFrame([("d", big)], "domain_name string, text string")
        began = time.time()
        assert G.segment_articles(one).count() == n
        seconds.append(time.time() - began)
    assert seconds[1] < 30 * max(seconds[0], 0.3)


def test_parts_leave_in_bounded_batches(spark, monkeypatch):
    """The parts of many texts never stand in one batch: what a task holds grows with a bound, not with the texts."""
    import pyarrow as pa
    monkeypatch.setattr(G, "BATCH_CHARS", 2000)
    text = "\n".join(f"第{i}条 " + f"内容{i}" * 10 for i in range(1, 21))
    texts = [None if k % 10 == 3 else text for k in range(40)]
    batch = pa.RecordBatch.from_pydict({"file_id": list(range(40)), "text": texts})
    out = list(G._cutter(["file_id"], "line")(iter([batch, batch.slice(0, 0)])))
    assert sum(b.num_rows for b in out) == 36 * 21 and max(b.num_rows for b in out) == 21
    df = spark.createDataFrame([(k, "法", t) for k, t in enumerate(texts)], "file_id long, domain_name string, text string")
    got = G.segment_articles(df).groupBy("file_id").agg({"pos": "min", "article": "count"}).collect()
    assert len(got) == 36 and {(r["count(article)"], r["min(pos)"]) for r in got} == {(20, 1)}
