"""Registered queries of the training-data operators, with DuckDB twins where SQL can express them.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F

from quarry.llm import (ann, bpe, chat, fingerprint, hardneg, langid, linededup, mixing, ngramjoin, prefixtrie, secrets, tokencount,
                        urlfilter)
from quarry.llm.common import Stage, tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 4096


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _read_back(batches):
    """Digests of formatted conversations, taken from the formatted strings and their loss spans."""
    for batch in batches:
        rows = []
        for formatted, spans in zip(batch.column("formatted"), batch.column("loss_spans")):
            text = formatted.as_py()
            turns = chat.parse(text)
            loss = chat.masked(text, [(x["start"], x["end"]) for x in spans.as_py()])
            rows.append((len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), len(text)))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string()) * 2 + (pa.int64(),)))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||/s>|s>|INST\]|/INST\])', '\1\2\\\3', 'g')) AS text_len,
         length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'),
                               '([<\[])(\\*)(\||/s>|s>|INST\]|/INST\])', '\1\2\\\3', 'g')) AS role_len FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(role_len + text_len + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op1_chat_format", CHAT_SQL)
def op1(spark, sf_dir):
    """All conversations, and one made of control strings, formatted and read back."""
    talk = tables(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))], talk.schema)
    done = chat.format_trees(chat.chains(talk.unionByName(odd), "conv_id", "turn"))
    return done.select("tree", "formatted", "loss_spans").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _fingerprint_rows(batches):
    """Fingerprints of texts, their edited texts and their successors, from ``next_in_order``."""
    sketcher, names = fingerprint.Sketcher(), ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                              "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    rows, known = [], (None, None)

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 7, types)], names=names)

    for (doc, text), (_, after) in fingerprint.pairs_in_order(batches, "doc_id", "text"):
        n = len(text)
        edited = text[:n - n // 3] + after[:n // 3]
        own = known[1] if known[0] is text else sketcher(text)
        changed, following = sketcher(edited), sketcher(after)
        known = (after, following)
        rows.append((doc, n, _sha(edited), fingerprint.as_string(own), fingerprint.as_string(changed),
                     sketcher.resemblance(own, changed), sketcher.resemblance(own, following)))
        if len(rows) == 2000:
            yield batch()
            rows = []
    yield batch()


@query("op2_fingerprints")
def op2(spark, sf_dir):
    """Fingerprints of every whole document and of its edited text, and how near they are."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = fingerprint.next_in_order(tables(spark, sf_dir, "documents"), "doc_id", "text", parts)
    return dealt.mapInArrow(_fingerprint_rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                               "edited_fingerprint string, near_edited double, near_next double")


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


@query("op3_url_filter")
def op3(spark, sf_dir):
    """Verdict on every page's url: the rules', else that of trees learned from the urls the rules decide."""
    return urlfilter.judge(tables(spark, sf_dir, "pages"), URL_RULES)


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE c::DOUBLE / (na.n + nb.n - c) >= 0.8::DOUBLE
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, least(d.doc_id, coalesce(r.low, d.doc_id)) AS class_id, coalesce(l.n_links, 0) AS n_links
FROM documents d LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = d.doc_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) l ON l.a = d.doc_id
"""


@query("op4_ngram_jaccard", JACCARD_SQL)
def op4(spark, sf_dir):
    """Classes of near documents, and how many documents each is linked to."""
    return ngramjoin.join(tables(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op5_nearest_vectors")
def op5(spark, sf_dir):
    """The 20 nearest vectors found for every twentieth one, among all."""
    vectors = tables(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@query("op6_token_counts")
def op6(spark, sf_dir):
    """Tokens of every whole document under a sentencepiece model."""
    counts = tokencount.count_tokens(tables(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


LINE_SQL = """
WITH pages AS (SELECT row_number() OVER () AS id, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
total AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
often AS (
  SELECT source, line FROM (
    SELECT source, line, count(*) AS n
    FROM (SELECT DISTINCT id, source, line FROM (SELECT id, source, trim(unnest(lines), ' ') AS line FROM pages) WHERE line <> '')
    GROUP BY source, line)
  JOIN total t USING (source) WHERE n >= 2 AND n > 0.05::DOUBLE * t.pages
  ),
marked AS (
  SELECT p.id, p.pos, p.line, o.line IS NOT NULL AS gone
  FROM (SELECT id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM pages) p
  LEFT JOIN often o ON o.source = p.source AND o.line = trim(p.line, ' ')
),
rebuilt AS (
  SELECT id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text, count(*) FILTER (gone) AS n_dropped
  FROM marked GROUP BY id
)
SELECT p.doc_id, r.text, coalesce(r.n_dropped, 0) AS n_dropped FROM pages p LEFT JOIN rebuilt r USING (id)
"""


@query("op7_line_dedup", LINE_SQL)
def op7(spark, sf_dir):
    """Documents without the lines that are on more than a twentieth of their source's documents."""
    docs = tables(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_frequent_lines(docs).drop("source")


@query("op8_language_id")
def op8(spark, sf_dir):
    """Predicted language of every whole document; learned from two thirds of the labelled ones."""
    docs = tables(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = docs.withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))
    contents = langid.train(docs, where=fold != 1)
    return langid.identify(docs, contents, keep=["doc_id", "held_out"])


@query("op9_bpe_round_trip")
def op9(spark, sf_dir):
    """Digests of every whole document's ids and of what they decode to."""
    return bpe.encode_decode(tables(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                             outputs=("n_tokens", "ids_sha256", "decoded_sha256"), keep=["doc_id"])


@query("op10_mix_sources")
def op10(spark, sf_dir):
    """What the mix of all documents takes of each."""
    docs = tables(spark, sf_dir, "documents").select("doc_id", "source", "text")
    blocks = mixing.plan(docs, keep=[F.col("doc_id"), F.monotonically_increasing_id().alias("row")])
    return blocks.groupBy("row", "doc_id").agg(
        F.sum("_words").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum(F.col("_words") * F.size(F.coalesce("draws", F.array()))).alias("taken")).drop("row")


HARD_SQL = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.id AS a, c.id AS c, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM r a JOIN r c ON a.id % 100 = 0 AND c.id <> a.id AND len(a.v) = len(c.v)
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id, row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.score DESC, n.c)::INT AS rank,
       n.c AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", HARD_SQL)
def op11(spark, sf_dir):
    """The hard negatives of every hundredth vector's positives, among all vectors."""
    df = tables(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardneg.prepare(df, "vec_id", label, "embedding", scale=256)
    return hardneg.mine(rows, rows.filter(F.col("id") % 100 == 0), positives=5, negatives=5, low=80, high=100)


TRIE_SQL = """
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)
),
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT c, c - c % 5 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                         lambda a, b: xor(a // 256, tab.t[xor(a, b) % 256 + 1])), 4294967295) % 9 AS h
  FROM ids, tab
),
n AS (
  SELECT conv_id AS c, md5(coalesce(role, '') || chr(0) || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(0) || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
rebuilt AS (
  SELECT h.c, 0 AS own, n.pos, k, bytes FROM h JOIN n ON n.c = h.base AND n.pos <= h.h
  UNION ALL SELECT h.c, 1, n.pos, k, bytes FROM h JOIN n ON n.c = h.c AND n.pos > h.h
),
placed AS (SELECT c, k, bytes, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d FROM rebuilt),
member AS (
  SELECT c, d, bytes, md5(array_to_string(list(k) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING), ',')) AS node,
         d = max(d) OVER (PARTITION BY c) AS ends
  FROM placed
  UNION ALL SELECT c, 0, 0, 'root', c NOT IN (SELECT c FROM placed) FROM ids
),
node AS (
  SELECT node, d, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY node, d
),
edge AS (SELECT v.node, v.c, v.d, v.n, v.bytes, v.ends_sha256, u.node AS up FROM node v LEFT JOIN member u ON u.c = v.c AND u.d = v.d - 1),
kids AS (SELECT up AS node, count(*) AS kids FROM edge WHERE up IS NOT NULL GROUP BY up),
sub AS (
  SELECT a.node, count(*) FILTER (k.kids IS NULL) AS leaves, sum((v.n - 1) * v.bytes)::BIGINT AS saved
  FROM edge v JOIN member a ON a.c = v.c AND a.d <= v.d LEFT JOIN kids k ON k.node = v.node GROUP BY a.node
)
SELECT v.c AS conv_id, v.d::BIGINT AS depth, p.c AS parent_conv_id, v.n AS n_convs, coalesce(k.kids, 0) AS n_children, s.leaves AS n_leaves,
       s.saved AS saved_tokens, v.ends_sha256
FROM edge v LEFT JOIN node p ON p.node = v.up LEFT JOIN kids k ON k.node = v.node JOIN sub s ON s.node = v.node
"""


def _rebuild(numbered, ids):
    """Conversation c: the first h turns of conversation c - c % 5, then its own after the first h; h from a hash of c below 9."""
    own = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    base = F.col("conv") - F.col("conv") % 5
    heads = numbered.filter(F.col("pos") <= 8).withColumnRenamed("conv", "base")
    have = heads.groupBy("base").agg(F.max("pos").alias("have"))
    shared = (ids.select("conv", base.alias("base"), own.alias("h")).join(heads, "base").filter(F.col("pos") <= F.col("h"))
              .select("conv", "pos", "h1", "h2", "bytes"))
    salt = F.lit(prefixtrie.SALTS)
    have = have.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(prefixtrie.SALTS - 1).cast("long"))))
    rest = numbered.withColumn("h", own).filter(F.col("pos") > F.col("h")).withColumn("base", base).withColumn("salt", F.pmod("pos", salt).cast("long"))
    rest = rest.join(have, ["base", "salt"], "left")
    moved = F.col("pos") - F.col("h") + F.least("h", F.coalesce("have", F.lit(0)))
    return shared.unionByName(rest.select("conv", moved.alias("pos"), "h1", "h2", "bytes"))


@query("op12_prefix_trie", TRIE_SQL)
def op12(spark, sf_dir):
    """The prefix trie of all conversations, rebuilt so that they share beginnings."""
    talk = tables(spark, sf_dir, "conversations")
    numbered = prefixtrie.number(prefixtrie.turns(talk, "conv_id", "turn"), Stage(spark, "rebuild"), "turns")
    ids = talk.select(F.col("conv_id").cast("long").alias("conv")).filter("conv IS NOT NULL").distinct()
    return prefixtrie.trie(_rebuild(numbered, ids), ids.withColumnRenamed("conv", "id"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _secret_sql(kind: str, order: int, pattern: str, test: str) -> str:
    """All matches m of a pattern with their start, from the pieces of text between them."""
    return f"""
  SELECT id, {order} AS o, '{kind}' AS kind, start, stop FROM (
    SELECT id, t, m, start, start + length(m) AS stop, crc_table FROM (
      SELECT id, t, crc_table, unnest(ms) AS m, unnest(list_transform(range(len(ms)), lambda i:
        coalesce(list_sum(list_transform(gaps[1:i + 1], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(ms[1:i], lambda x: length(x))), 0)))::BIGINT AS start
      FROM (SELECT id, t, crc_table, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM d)))
  WHERE {test}"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = f"""(?:{'|'.join(map(_any_case, secrets.KEYWORDS['assign'][:4]))}|{_any_case('api')}_?{_any_case('key')})""" \
          r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_LAST = "NOT regexp_matches(substr(t, stop + 1, 1), '[A-Za-z0-9]')"
_BYTES = "list_transform(string_split({}, ''), lambda c: ord(c)::BIGINT)"
_CRC_TEST = f"""{_LAST} AND xor(list_reduce(list_prepend(4294967295, {_BYTES.format('substr(m, 5, 30)')}),
    lambda a, b: xor(a // 256, crc_table[xor(a, b) % 256 + 1])), 4294967295)
  = list_reduce(list_prepend(0::BIGINT, list_transform(string_split(right(m, 6), ''), lambda c: strpos('{secrets.BASE62}', c) - 1)), lambda a, b: a * 62 + b)"""
_STEP = "xor((c % 33554432) * 32, x)"
for _bit, _value in enumerate(secrets.BECH32_STEPS):
    _STEP = f"xor({_STEP}, (c // {33554432 << _bit}) % 2 * {_value})"
_BECH_TEST = f"""{_LAST} AND list_reduce(list_concat([1::BIGINT], list_transform({_BYTES.format('lower(left(m, length(m) - 59))')}, lambda c: c // 32), [0::BIGINT],
    list_transform({_BYTES.format('lower(left(m, length(m) - 59))')}, lambda c: c % 32),
    list_transform(string_split(lower(right(m, 58)), ''), lambda c: strpos('{secrets.BECH32}', c)::BIGINT - 1)), lambda c, x: {_STEP}) = 1"""
SECRET_SQL = f"""
WITH tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)
),
d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, tab.t AS crc_table FROM documents, tab),
found AS ({" UNION ALL ".join([
    _secret_sql("assign", 0, _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 1)) >= 6"),
    _secret_sql("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 20"), _secret_sql("hex", 2, "[0-9a-f]+", f"length(m) >= {secrets.HEX_RUN}"),
    _secret_sql("crc", 3, "(?:gh[pousr]|npm)_[A-Za-z0-9]{36}", _CRC_TEST),
    _secret_sql("bech32", 4, "AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}|nsec1[02-9ac-hj-np-z]{58}", _BECH_TEST)])}
),
line AS (
  SELECT id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans
  FROM found GROUP BY id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN line USING (id)
"""


@query("op13_secret_scan", SECRET_SQL)
def op13(spark, sf_dir):
    """The secrets of every whole document."""
    found = secrets.scan(tables(spark, sf_dir, "documents"), keep=["doc_id"])

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    count = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE]
    base = of(*secrets.BASE)
    return found.select("doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
