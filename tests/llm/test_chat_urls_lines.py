"""Chat formatting, URL filter, line dedup: round trips, brute force and defined cases."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quarry.llm import chat, linededup, queries, urlfilter

NODE = "tree long, node long, parent long, role string, text string, score double, role2 string"


def tree(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], NODE)


def paths(rows):
    """tree -> (score, texts) of its best path, by walking."""
    by = {(r[0], r[1]): r for r in rows}
    parents = {(r[0], r[2]) for r in rows}
    out = defaultdict(list)
    for key, r in by.items():
        if key in parents:
            continue
        walk, at = [], r
        while at is not None:
            walk.append(at)
            at = by.get((at[0], at[2]))
        out[r[0]].append((sum(x[5] for x in walk), len(walk), -r[1], [(x[3], x[4]) for x in reversed(walk)]))
    return {t: sorted(p, key=lambda x: (-x[0], -x[1], str(-x[2]))) for t, p in out.items()}


def test_best_branches_of_random_trees(spark):
    rnd, rows = random.Random(1), []
    for t in range(6):
        for n in range(1, 40):
            rows.append((t, n, rnd.randint(1, n - 1) if n > 1 else None, rnd.choice(("user", "assistant")), f"t{t}n{n}", float(n * n % 17)))
    got = defaultdict(list)
    for r in chat.format_trees(tree(spark, rows), top_k=3).orderBy("tree", "branch").collect():
        turns = chat.parse(r.formatted)
        assert r.n_turns == len(turns)
        assert chat.masked(r.formatted, [(s.start, s.end) for s in r.loss_spans]) == "".join(x for role, x in turns if role == "assistant")
        got[r.tree].append((r.path_score, turns))
    want = paths(rows)
    for t in range(6):
        assert [s for s, _ in got[t]] == [p[0] for p in want[t][:3]]
        assert got[t][0][1] in [p[3] for p in want[t] if p[0] == got[t][0][0]]


def test_long_chain_orphans_cycles_and_repeats(spark):
    rows = [(1, n, n - 1 if n else None, "user", str(n), 0.0) for n in range(70)]
    rows += [(2, 1, 99, "user", "orphan", 0.0), (2, 1, 99, "user", "orphan", 0.0)]
    rows += [(3, 1, 2, "user", "c", 0.0), (3, 2, 1, "user", "c", 0.0), (3, 3, 2, "user", "below", 0.0)]
    rows += [(None, None, None, None, None, None)]
    out = {r.tree: r for r in chat.format_trees(tree(spark, rows)).collect()}
    assert set(out) == {1, 2, None}
    assert [x for _, x in chat.parse(out[1].formatted)] == [str(n) for n in range(70)]
    assert chat.parse(out[2].formatted) == [("user", "orphan")] and chat.parse(out[None].formatted) == [("", "")]
    assert chat.format_trees(tree(spark, rows).limit(0)).count() == 0


def test_control_strings_come_back(spark):
    rnd = random.Random(2)
    alphabet = ["<", "|", "\\", "<|", "<|im_end|>", "<|im_start|>user\n", "</s>", "[INST]", "[/INST]", "<s>", "\n", "a", "%0A", "%25", "é", "🤖"]
    rows = [(i, 1, None, "".join(rnd.choices(alphabet, k=2)), "".join(rnd.choices(alphabet, k=rnd.randint(0, 12))), 0.0) for i in range(400)]
    out = {r.tree: r.formatted for r in chat.format_trees(tree(spark, rows)).collect()}
    for i, _, _, role, text, _ in rows:
        assert chat.parse(out[i]) == [(role, text)]
        inside = out[i][len(chat.OPEN):-len(chat.CLOSE) - 1]
        assert not re.search(r"<\||</s>|<s>|\[/?INST\]", inside)


def test_conversations_in_order_of_turn(spark):
    rows = spark.createDataFrame([(1, 3, "user", "c"), (1, 1, "user", "a"), (1, 2, "assistant", None), (1, None, "system", "first")],
                                 "conv_id long, turn long, role string, text string")
    out = chat.format_trees(chat.chains(rows, "conv_id", "turn")).first()
    assert chat.parse(out.formatted) == [("system", "first"), ("user", "a"), ("assistant", ""), ("user", "c")]


# --- URL filter ------------------------------------------------------------------------------------------------------------
def plain(url):
    m = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fits = []
    for verdict, r in queries.URL_RULES:
        site, slash, rest = r.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith(slash + rest):
            fits.append((len(r), r, verdict))
    return max(fits)[1:] if fits else (None, None)


def test_url_rules_and_trees(spark):
    rnd = random.Random(4)
    urls = [f"http{rnd.choice(['', 's'])}://{rnd.choice(['', 'WWW.', 'm.'])}{rnd.choice(['example.org', 'a.com', 'xexample.org', 'org', 'b.net', 'É.com'])}"
            f"{rnd.choice(['', '/', '/es/1', '/en/12', '/de/9?x=1', '/fr/2#t', '/fr'])}" for _ in range(400)]
    urls += [None, "", "nothing", "a://", "x://y://z/es/", "http://h" + "a1" * 30000 + ".org/"] + urls[:1]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    out = urlfilter.judge(df, queries.URL_RULES).orderBy("page_id").collect()
    assert len(out) == len(urls)
    for r, u in zip(out, urls):
        host, path = plain(u)
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name), u
        assert r.verdict == verdict if name else r.verdict in ("allow", "block")


def test_url_without_labels(spark):
    df = spark.createDataFrame([(1, "http://x.net/a"), (2, "http://x.org/a")], "page_id long, url string")
    assert {r.verdict for r in urlfilter.judge(df.filter("page_id = 1"), queries.URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in urlfilter.judge(df, [("block", "org/")]).collect()} == {"block"}
    assert urlfilter.judge(df.limit(0), queries.URL_RULES).count() == 0


def test_trees_learn_from_labels(spark):
    rnd = random.Random(5)
    rows = [(i, f"http://{'spam-' * (i % 2)}{rnd.randint(1, 10 ** 6)}.com/{'x' * rnd.randint(1, 9)}{'?q=1&r=2' * (i % 2)}", float(1 - i % 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, label double")
    known = F.when(df["page_id"] < 400, df["label"])
    out = urlfilter.judge(df, [], label=known).join(df.select("page_id", "label"), "page_id").filter("page_id >= 400")
    assert out.filter("(verdict = 'allow') <> (label = 1)").count() <= 4


def test_a_rare_label_stays_in_a_thinned_sample(spark):
    rows = [(i, f"http://site{i % 7}.com/{i}", 1.0) for i in range(3000)] + [(5000 + i, f"http://spam-spam-{i}.com/?q=1&r=2&s=3", 0.0) for i in range(6)]
    df = spark.createDataFrame(rows + [(9000 + i, f"http://spam-spam-{50 + i}.com/?q=1&r=2&s=3", None) for i in range(5)], "page_id long, url string, label double")
    out = {r.page_id: r.verdict for r in urlfilter.judge(df, [], label=df["label"], max_rows=100).collect()}
    assert all((out[i] == "block") == (i >= 5000) for i in out)


# --- line dedup --------------------------------------------------------------------------------------------------------------
def dedup(rows, ratio, least, leave=None):
    total, count = Counter(r[1] for r in rows), Counter()
    for r in rows:
        for line in {x.strip(" ") for x in (r[2] or "").split("\n")} - {""}:
            count[r[1], line] += 1
    out = []
    for i, s, t in rows:
        gone = [x for x in (t or "").split("\n") if x.strip(" ") and count[s, x.strip(" ")] >= least and count[s, x.strip(" ")] > ratio * total[s]]
        kept = [x for x in (t or "").split("\n") if x not in gone]
        if leave is not None and t and sum(map(len, kept)) < (1 - leave) * len(t.replace("\n", "")):
            kept, gone = t.split("\n"), []
        out.append((i, None if t is None else "\n".join(kept), len(gone)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(300):
        site = rnd.choice(["a", "b", "c", None])
        lines = rnd.choices(["Menu", " Menu", "Terms", "", "  ", "é🤖"], k=rnd.randint(0, 4)) + [f"own {i} {j}" for j in range(rnd.randint(0, 3))]
        rows.append((i, site, "\n".join(lines)))
    rows += [(900, "a", None), (901, "a", ""), (902, "a", "Menu"), (902, "a", "Menu"), (903, "big", "own line\n" * 20000)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, source string, text string, n_dropped int, site string")
    for ratio, least, leave in ((0.05, 5, None), (0.3, 3, None), (0.05, 5, 0.5)):
        got = [(r.doc_id, r.text, r.n_dropped) for r in linededup.drop_frequent_lines(df, "source", "text", ratio, least, leave).collect()]
        assert sorted(got, key=str) == dedup(rows, ratio, least, leave)
    assert linededup.drop_frequent_lines(df.limit(0)).count() == 0


def test_small_hosts_lose_their_boilerplate(spark):
    """50 hosts of 8 pages, a line on half of each host's pages, and a line of each page's own."""
    rows = [(h * 8 + p, f"h{h}", f"own {h} {p}" + ("\nmenu of the host" if p % 2 else "")) for h in range(50) for p in range(8)]
    out = linededup.drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert {r.text for r in out} == {f"own {h} {p}" for h in range(50) for p in range(8)} and sum(r.n_dropped for r in out) == 200
