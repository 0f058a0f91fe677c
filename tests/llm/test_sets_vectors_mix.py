"""Fingerprints, Jaccard join, nearest neighbours, mixing: brute force and defined cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import ann, fingerprint, mixing, ngramjoin, queries
from quarry.llm.common import Shingler, Stage


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_texts(n, seed):
    """Some families of near copies, exact copies and strangers."""
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    out = []
    while len(out) < n:
        base = rnd.choices(words, k=rnd.choice((3, 5, 30, 80, 200)))
        for _ in range(rnd.choice((1, 1, 2, 6, 25))):
            copy = list(base)
            for _ in range(rnd.choice((0, 0, 1, 2, 3, 5))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(rnd.choice((" ", "\n", " \t ")).join(copy))
    return out[:n]


# --- shingles and fingerprints -----------------------------------------------------------------------------------------------
def test_shingle_hashes_are_sets_of_words():
    s = Shingler()
    for t in [*near_texts(200, 1), "", None, " \n", "é🤖 b", "a\x0bb\x0cc d e f g", "x" * (3 << 20) + " y", "ab " * (1 << 20)]:
        assert len(s.shingles(t)) == len(shingles(t))
    assert (s.shingles("a b  c\nd e f") == s.shingles("a b c d e f")).all()
    assert set(s.shingles("a b c d")).isdisjoint(s.shingles("a b c d e"))


def test_sketches_estimate_and_merge(spark):
    rows = [(i, t, i % 3, "x") for i, t in enumerate(near_texts(120, 2))] + [(500, None, 0, "x"), (501, "", 4, "x"), (0, "again", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, g int, sketch string")
    out = fingerprint.fingerprint(df, k=64)
    by = {(r.doc_id, r.text): r.sketch for r in out.collect()}
    assert by[500, None] == [] and by[501, ""] == [] and len(by) == len(rows)
    merged = {r.g: r.sketch for r in fingerprint.merge(out, "g", k=64).collect()}
    for g in {r[2] for r in rows}:
        every = sorted({h for (i, t), s in by.items() for h in s if (i, t, g, "x") in rows})
        assert merged[g] == every[:64]
    pair = out.alias("a").join(out.alias("b"), F.col("b.doc_id") == F.col("a.doc_id") + 1)
    a, b = F.col("a.sketch"), F.col("b.sketch")
    got = pair.select("a.text", F.col("b.text").alias("other"), fingerprint.resemblance(a, b, 64).alias("j"),
                      fingerprint.containment(a, b, 64).alias("c"), fingerprint.distinct_count(a, 64).alias("n")).collect()
    sketcher = fingerprint.Sketcher(64)
    for r in got:
        x, y = shingles(r.text), shingles(r.other)
        assert abs(r.j - jaccard(x, y)) < 0.25 and 0 <= r.c <= 1 and abs(r.n - len(x)) <= 0.5 * max(1, len(x))
        assert r.j == pytest.approx(sketcher.resemblance(sketcher(r.text), sketcher(r.other)))
    assert fingerprint.fingerprint(df.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_successors(spark, parts):
    rows = [(i * i, "t%d " % i * 20) for i in range(50)] + [(None, "n%d" % i) for i in range(5)] + [(7, None), (7, None)]
    for some in (rows, rows[:1], []):
        df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
        dealt = fingerprint.next_in_order(df, "doc_id", "text", parts)
        got = dealt.mapInArrow(queries._fingerprint_rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                         "edited_fingerprint string, near_edited double, near_next double").collect()
        h = {(r.doc_id, r.text): r.h for r in df.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
        order = sorted(some, key=lambda r: (r[0] is None, -(r[0] or 0), h[r]))
        want = []
        for r, after in zip(order, [*order[1:], *order[:1]]):
            t, u = r[1] or "", after[1] or ""
            want.append((r[0], hashlib.sha256((t[:len(t) - len(t) // 3] + u[:len(t) // 3]).encode()).hexdigest()))
        assert sorted(((r.doc_id, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)


# --- Jaccard join ----------------------------------------------------------------------------------------------------------------
def classes(rows):
    sets = [shingles(t) for _, t in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append(d)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in low.items()}
    return sorted(((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [4, 256])
def test_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngramjoin, "BLOCK_NODES", block)      # small blocks: long paths, dense buckets, pairs of blocks
    rows = list(enumerate(near_texts(350, 3)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, rows[0][1]), (0, rows[0][1]), (None, rows[5][1]), (None, "only here and nowhere else at all")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, n int")
    out = ngramjoin.join(df)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in out.collect()), key=str) == classes(rows)
    kept = ngramjoin.keep_one(df).collect()
    want = classes(rows)
    groups = {c for _, c, n in want if n} | {d for d, _, n in want if not n and d is not None}
    assert {r.doc_id for r in kept} - {None} == groups
    assert len(kept) == len(groups) + 1 and ngramjoin.join(df.limit(0)).count() == 0


def test_repeated_rows_of_a_node_come_in_once(spark, monkeypatch):
    text = "one text of some rows that are equal in id and text"
    rows = [(1, text)] * 400 + [(None, text + " and more")] * 400 + [(2, text + " and"), (3, "another text that has nothing to do with it")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    came, compare = [], ngramjoin.compare
    monkeypatch.setattr(ngramjoin, "compare", lambda texts, *a: came.append(texts.groupBy("bucket", "a", "b", "key").count().agg(F.max("count")).first()[0]) or compare(texts, *a))
    out = ngramjoin.join(df, threshold=0.7)
    assert out.count() == len(rows) and came[0] <= 2
    got = {(r.doc_id, r.class_id, r.n_links) for r in out.collect()}
    assert got == {(1, 1, 800), (None, 1, 800), (2, 1, 800), (3, 3, 0)}
    batch = pa.RecordBatch.from_pylist([{"bucket": 1, "a": 0, "b": 0, "half": 0, "key": ngramjoin.Signer().key(Shingler().shingles(text)), "copies": 9,
                                         "buckets": [1], "text": text}] * 9)
    assert [len(kept) for _, _, kept in ngramjoin.nodes_once(iter([batch, batch]), ngramjoin.Signer())] == [1]


def test_components_of_a_long_chain(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf1"), (b"\xf0", b"\xf0")]
    df = spark.createDataFrame(edges, "key binary, root binary")
    got = {bytes(r.key): bytes(r.root) for r in ngramjoin.components(df, Stage(spark, "test")).collect()}
    assert got == {**{bytes([i]): b"\0" for i in range(61)}, b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


# --- nearest neighbours ------------------------------------------------------------------------------------------------------------
def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 12)) * rng.lognormal(size=(700, 1))
    x[300:340] = x[7]           # copies
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    odd = [(2000, None, 0), (2020, [], 0), (2040, [0.0] * 12, 0), (2060, [float("nan")] * 12, 0), (2080, [None] + [1.0] * 11, 0),
           (2100, [float("inf")] + [1.0] * 11, 0), (2120, [1.0, 2.0], 0), (None, [1.0] * 12, 0), (20, rows[20][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int")
    out = defaultdict(list)
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=20, shard_vectors=200).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    assert set(out) == set(range(0, 700, 20))
    x64, hit = np.array([r[1] for r in rows]).astype(np.float32).astype(float), 0
    for q, got in out.items():
        s = x64 @ x64[q]
        want = [i for i in np.lexsort((np.arange(700), -s)) if i != q][:20]
        hit += len({i for i, _ in got} & set(want))
        assert len(got) == 20 and all(abs(sc - s[i]) < 1e-9 * max(1, abs(sc)) for i, sc in got)
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
    assert hit / (20 * len(out)) >= 0.95
    few = ann.nearest(df.filter("vec_id < 5"), df.filter("vec_id = 0"), k=20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4] and ann.nearest(df.limit(0), df, k=3).count() == 0


def test_long_vectors_do_not_hide_the_others(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 12)).astype(np.float32)
    x[0] *= 1e6
    x[300:] = x[300] + rng.normal(size=(300, 12)).astype(np.float32) * 1e-3     # a narrow cluster
    graph = ann.Graph(ann._unit(x.astype(float))).build()
    assert np.median((graph.edges >= 0).sum(1)) > 3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in ann.nearest(df, df.filter("vec_id % 20 = 10"), k=20, beam=32).collect():
        got[r.query_id].add(r.vec_id)
    x, hit = x.astype(float), 0
    for q in range(10, 600, 20):
        hit += len(got[q] & set([i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20]))
    assert hit / (20 * 30) >= 0.95


@pytest.mark.parametrize("kind,n", [("lengths 0.1", 2000), ("lengths 0.3", 2000), ("gauss", 2500), ("gauss", 4096), ("clusters", 4096)])
def test_recall_of_production_parameters(spark, kind, n):
    """Vectors of 64 dimensions and uneven length, at least 20 beams of them."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    if kind.startswith("lengths"):
        x *= np.exp(float(kind.split()[1]) * rng.normal(size=(n, 1))) / np.sqrt((x * x).sum(1, keepdims=True))
    elif kind == "clusters":
        x = 2 * rng.normal(size=(50, 64))[rng.integers(0, 50, n)] + x
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=20).collect():
        got[r.query_id].add(r.vec_id)
    hit = sum(len(got[q] & set([i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20])) for q in range(0, n, 20))
    assert hit / (20 * len(got)) >= 0.95


# --- mixing ------------------------------------------------------------------------------------------------------------------------
def fill(sizes, weights, cap=3.0):
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        level = rest / w if w else 0.0
        more = {s for s in sizes if s not in full and level * weights[s] > cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in full else level * weights[s] for s in sizes}
        full |= more


def test_splitting_tree_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(30):
        quotas = rng.integers(0, 50, rng.integers(1, 9))
        shards = int(rng.integers(1, 12))
        capacity = [int(quotas.sum()) // shards + (k < int(quotas.sum()) % shards) for k in range(shards)]
        table = mixing.split_tree(quotas, capacity, 5)
        assert (table >= 0).all() and (table.sum(1) == quotas).all() and table.sum(0).tolist() == capacity
        assert (table == mixing.split_tree(quotas, capacity, 5)).all()


def test_mix_targets_quotas_and_shards(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", "c", "d", None]), " x" * rnd.choice((0, 1, 30, 200, 2000)), 1) for i in range(300)]
    rows += [(i, "tiny", "one two three", 1) for i in range(900, 903)] + [(950, "empty", None, 1), (951, "empty", "", 1), (960, "a", "p\nq", 1), (960, "a", "p\nq", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int")
    size = Counter()
    for _, s, t, _ in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = fill(size, {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)})
    plan = mixing.plan(df, keep=[F.col("doc_id"), F.col("source")], block_words=100).collect()
    taken = Counter()
    for r in plan:
        taken[r.source] += r._words * r.copies
        assert r.copies <= 3 and r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]
    for s in size:
        assert abs(taken[s] - target[s]) <= 50
    shard = Counter(d.shard for r in plan for d in r.draws or [])
    assert max(shard.values()) - min(shard.values()) <= 1 and sum(shard.values()) == sum(r.copies for r in plan)
    mixed = mixing.mix(df, block_words=100).collect()
    words = Counter()
    for r in mixed:
        words[r.source] += len((r.text or "").split())
    assert all(words[s] == taken[s] for s in size) and mixed[0].asDict().keys() == {"doc_id", "source", "text", "shard"}
    again = mixing.mix(df.repartition(5), block_words=100).collect()
    assert Counter(map(str, mixed)) == Counter(map(str, again))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_pieces_make_up_the_text(spark):
    text = "  lead " + "\n".join("w%d" % i for i in range(95)) + " \t"
    df = spark.createDataFrame([(1, "s", text)], "doc_id long, source string, text string")
    got = mixing.plan(df, block_words=10, with_text=True).orderBy("_block").collect()
    assert "".join(r._piece for r in got) == text and [r._words for r in got] == [10] * 9 + [6]
