"""Hard negatives, prefix trie, secret scans: held against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hardneg, prefixtrie, queries, secrets
from quarry.llm.common import Stage

# --- hard negatives ---------------------------------------------------------------------------------------------------------


def mined(rows, anchors, positives, negatives, low=80, high=100):
    """Brute force over (id, label, vec) with whole components."""
    out = set()
    rows = set(rows)
    for a, label, v in {r for r in rows if r[0] in anchors}:
        score = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in rows if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in score if x[2] == label)[:positives]:
            near = sorted((t, i) for t, i, m in score if m != label and low * -s <= 100 * -t <= high * -s)[:negatives]
            out |= {(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(near)}
    return out


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "PART_ROWS", 90)
    monkeypatch.setattr(hardneg, "LEAST_ROWS", 40)
    monkeypatch.setattr(hardneg, "CHUNK_ANCHORS", 7)
    rnd = random.Random(5)
    rows = [(i, rnd.choice("aab"), tuple(rnd.randint(-9, 9) + 4 for _ in range(6))) for i in range(400)]
    rows += [(1000 + i, rnd.choice("ab"), (5, 5, 5, 5, 5, 5)) for i in range(60)]           # copies of one vector
    rows += [(2000 + i, "a", tuple(300 * rnd.randint(0, 3) for _ in range(6))) for i in range(20)]  # long ones, zero ones
    rows += [(3000 + i, "c", (i, 1)) for i in range(3)] + [(3010, "d", (1, 1)), (3011, "d", ())]
    anchors = {r[0] for r in rows if r[0] % 5 == 0}
    df = spark.createDataFrame([(i, m, [float(x) for x in v]) for i, m, v in rows + rows[:40]], "id long, label string, vec array<double>")
    df = df.unionByName(spark.createDataFrame([(5, None, [1.0] * 6), (10, "a", None), (15, "a", [1.0, None] + [0.0] * 4), (None, "a", [1.0] * 6),
                                               (20, "a", [float("nan")] * 6), (25, "b", [float("inf")] * 6), (30, "b", [1e12] * 6)], df.schema))
    df = df.withColumn("rank", F.lit("x")).withColumn("g", F.lit(1))
    ready = hardneg.prepare(df, "id", "label", "vec")
    got = hardneg.mine(ready, ready.filter(F.col("id").isin(list(anchors))), 4, 3).collect()
    want = mined(rows, anchors, 4, 3)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_hard_negatives_of_empty_tables(spark):
    none = spark.createDataFrame([], "id long, label int, vec array<double>")
    rows = hardneg.prepare(none, "id", "label", "vec")
    assert hardneg.mine(rows, rows).collect() == []


def test_pruning_keeps_every_row_above_the_angle():
    rng = np.random.default_rng(2)
    rows = rng.integers(-99, 99, (3000, 8)).astype(float)
    norms = np.sqrt((rows ** 2).sum(1))
    by = np.argsort(-norms)
    bucket = hardneg.Bucket(rows[by], norms[by], np.arange(3000))
    kept = 0
    for q in rng.normal(size=(50, 8)):
        q /= np.sqrt(q @ q)
        cosine = rows[by] @ q / norms[by]
        for least in (0.2, 0.9, float(cosine.max())):
            found = set(bucket.candidates(q, least).tolist())
            assert found >= set(np.flatnonzero(cosine >= least).tolist())
            kept += len(found) if least == 0.9 else 0
    assert kept < 0.3 * 50 * 3000


# --- prefix trie ------------------------------------------------------------------------------------------------------------
def tried(talks):
    """Brute force: conv -> list of (role, text)."""
    member = defaultdict(set)
    for c, seq in talks.items():
        for d in range(len(seq) + 1):
            member[tuple(seq[:d])].add(c)
    kids = defaultdict(list)
    for n in member:
        if n:
            kids[n[:-1]].append(n)

    def below(n):
        leaves, saved = (0 if kids[n] else 1), (len(member[n]) - 1) * (len(n[-1][1].encode()) if n else 0)
        for k in kids[n]:
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = set()
    for n, who in member.items():
        ends = ",".join(map(str, sorted(c for c in who if len(talks[c]) == len(n))))
        out.add((min(who), len(n), min(member[n[:-1]]) if n else None, len(who), len(kids[n]), *below(n),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def as_rows(talks):
    return [(c, t, r, x) for c, seq in talks.items() for t, (r, x) in enumerate(seq)]


def run_trie(spark, rows, ids, shard_paths):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("owner", F.lit(1)).withColumn("bytes", F.lit("x"))
    numbered = prefixtrie.number(prefixtrie.turns(df, "conv_id", "turn"), Stage(spark, "test"), "turns")
    got = prefixtrie.trie(numbered, spark.createDataFrame([(i,) for i in ids], "id long"), shard_paths).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


@pytest.mark.parametrize("shard_paths,chunk,ends", [(3, 4, 2), (1000, 4096, 1000)])
def test_trie_equals_brute_force(spark, monkeypatch, shard_paths, chunk, ends):
    monkeypatch.setattr(prefixtrie, "CHUNK", chunk)
    monkeypatch.setattr(prefixtrie, "ENDS", ends)
    rnd = random.Random(8)
    talks = {c: [("user" if t % 2 == 0 else "assistant", rnd.choice(["é", "bb", ""])) for t in range(rnd.randint(1, 6))] for c in range(-20, 90)}
    long = [("user", f"{t}") for t in range(25)]
    talks |= {200: long, 201: long[:8], 202: long[:23] + [("user", "x")], 203: long, 204: long[:12], 205: [("user", "own")] * 19}
    talks |= {300 + i: [("user", "same"), ("assistant", "same")] for i in range(12)}
    talks |= {400: []}
    assert run_trie(spark, as_rows(talks), [400, 200], shard_paths) == tried(talks)


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, "a"), (1, 0, "user", None), (2, 5, "", "a"), (2, 5, "user", ""), (None, 0, "user", "x"), (3, 1, "user", "z"), (3, 1, "user", "z")]
    got = run_trie(spark, rows, [], 10)
    assert {(r[0], r[1], r[3], r[5], r[6]) for r in got if r[0] == 3} == {(3, 1, 1, 1, 0), (3, 2, 1, 1, 0)}
    assert {r[:4] for r in got if r[1] == 0} == {(1, 0, None, 3)}
    assert run_trie(spark, [], [], 10) == set()


def test_parentheses_close_where_a_stack_says():
    rnd = random.Random(1)
    for n in (1, 5, 400, 3000):
        opens, depth, left = [], 0, n
        while left or depth:
            if left and (depth == 0 or rnd.random() < 0.52):
                opens.append(True)
                depth, left = depth + 1, left - 1
            else:
                opens.append(False)
                depth -= 1
        stack, close = [], {}
        for i, o in enumerate(opens):
            if o:
                stack.append(i)
            else:
                close[stack.pop()] = i
        tree = prefixtrie.Parentheses(np.array(opens))
        at = np.flatnonzero(opens)
        assert tree.findclose(at).tolist() == [close[i] for i in at.tolist()]
        assert tree.pairs[-1] == sum(a and not b for a, b in zip(opens, opens[1:]))


def test_rebuilt_conversations_of_the_query(spark):
    rnd = random.Random(3)
    talks = {c: [("user", f"{c} {t}") for t in range(rnd.randint(1, 12))] for c in range(0, 60) if c % 10}
    df = spark.createDataFrame(as_rows(talks), "conv_id long, turn long, role string, text string")
    numbered = prefixtrie.number(prefixtrie.turns(df, "conv_id", "turn"), Stage(spark, "test"), "turns")
    ids = df.select(F.col("conv_id").alias("conv")).distinct()
    made = {}
    for c in talks:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = talks.get(c - c % 5, [])[:h] + talks[c][h:]
    got = prefixtrie.trie(queries._rebuild(numbered, ids), ids.withColumnRenamed("conv", "id")).collect()
    assert {tuple(r) for r in got} == tried(made)


# --- secrets ----------------------------------------------------------------------------------------------------------------
def plain(text):
    """Brute force: expressions over the whole text, tests afterwards."""
    found = []
    for kind in secrets.KINDS:
        found += [(kind, m.start(), m.end()) for m in secrets.PATTERNS[kind].finditer(text or "") if secrets.TESTS[kind](m)]
    return sorted(found, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


def token(prefix, body):
    check, value = "", zlib.crc32(body.encode())
    for _ in range(6):
        value, r = divmod(value, 62)
        check = secrets.BASE62[r] + check
    return prefix + body + check


PIECES = ["password", "PassWd", "secret", "tOKen", "api_key", "APIKEY", "apikey", "=", ":", " = ", "\"", "'", "abc", "Zz9+/_.=-x", "AKIA", "akia", "AKIAAKIA",
          "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef", "DEADBEEF", " ", "\n", "é", "日", "ſecret", "toKen", "İ", "\ud800", "ghp_", "npm_", "x" * 36, "ÿ", "Ā"]


def test_scanner_equals_whole_text_expressions():
    rnd, scan = random.Random(4), secrets.Scanner()
    for _ in range(6000):
        t = "".join(rnd.choices(PIECES, k=rnd.randint(0, 30)))
        assert scan(t) == plain(t), t
    long = "é" * 300_000 + "password: hunter22 " + "0f" * 100_000 + "日 AKIA" + "Q7" * 9 + " token = abcdef"
    assert scan(long) == plain(long) and len(scan(long)) == 4


def test_checksums_decide():
    scan = secrets.Scanner()
    good = token("ghp_", "abcdefghijklmnopqrstuvwxyz0123")
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert scan(f"x {good} y") == [("crc", 2, 42)] and scan(f"x {bad} y") == []
    # from the public Bech32 specification: valid and invalid words
    assert secrets.bech32_holds("A12UEL5L") and secrets.bech32_holds("split1checkupstagehandshakeupstreamerranterredcaperred2y9e3w")
    assert not secrets.bech32_holds("A12UEL5Q")
    data = [secrets.BECH32[i % 32] for i in range(52)]
    key = bech32("age-secret-key-", "".join(data)).upper()
    assert scan(f"k={key}.") == [("bech32", 2, 2 + len(key))] and scan(f"k={key[:-1]}{'Q' if key[-1] != 'Q' else 'P'}.") == []


def bech32(prefix, data):
    def polymod(values):
        check = 1
        for v in values:
            top = check >> 25
            check = (check & 0x1FFFFFF) << 5 ^ v
            for i in range(5):
                check ^= secrets.BECH32_STEPS[i] if (top >> i) & 1 else 0
        return check
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [secrets.BECH32.index(c) for c in data]
    check = polymod(values + [0] * 6) ^ 1
    return prefix + "1" + data + "".join(secrets.BECH32[check >> 5 * (5 - i) & 31] for i in range(6))


def test_secret_query_and_operator(spark, tmp_path):
    secret = token("npm_", "Q" * 30)
    key = bech32("nsec", "".join(secrets.BECH32[i % 32] for i in range(52)))
    texts = [key, f"{secret}x {key[:-1]}z {secret[:-1]}! {key}", None, "", "password: hunter22, token=abc", "a" * 23, "b" * 24, f"é {secret} AKIA{'B' * 16}", "token: " + "0a" * 20]
    rows = [(i - 2, t, "clash", 1) for i, t in enumerate(texts)] + [(2, texts[4], "again", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, spans string, end int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op13_secret_scan"](spark, str(tmp_path)).collect()))
    want = []
    for i, t, *_ in rows:
        found = plain(t)
        line = lambda some: ",".join(f"{k}:{a}:{b}" for k, a, b in some)
        base = [x for x in found if x[0] in secrets.BASE]
        want.append((i, *(sum(x[0] == k for x in base) for k in secrets.BASE), hashlib.sha256(line(base).encode()).hexdigest(), line(found)))
    assert got == sorted(want)
    duckdb.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duckdb.sql(queries.ORACLES["op13_secret_scan"]).fetchall()) == sorted(want)
    duckdb.sql("DROP VIEW documents")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in secrets.scan(df, outputs=("spans", "redacted")).collect()}
    assert out[0]["redacted"] is None and out[1]["redacted"] == "" and out[5]["redacted"] == "é <crc> <access>"
    assert out[2]["redacted"] == "<assign>, token=abc" and set(out[2].asDict()) == {"doc_id", "spans", "end", "redacted"}
    assert secrets.scan(df.limit(0)).collect() == []


def test_patterns_are_the_stated_ones():
    assert re.fullmatch(secrets.PATTERNS["hex"], "0af") and not re.fullmatch(secrets.PATTERNS["hex"], "0AF")
    assert not re.match(secrets.PATTERNS["assign"], "ſecret: abcdef")
