"""N-gram Jaccard join by chosen paths (operator 4).

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least ``threshold``.

1. Documents with equal sets are one node.  A node has a signature: the smallest of its shingles under each of 64 hash
   orders, that is a sample of its tokens which two sets share about as often as they are similar.
2. Chosen paths: a run starts with all nodes in one bucket and splits every bucket on two sampled tokens, so a node goes
   to two buckets, named by the path so far and the token.  Buckets of one node are dropped.  Small ones are done.  So
   are dense ones: the tokens they were to be split on are shared by at least half of all pairs, so most pairs are near
   and brute force wastes little.  The others are split again, up to ``MAX_LEVELS`` times; what is still large then is
   brute-forced too.  Nothing is capped.
3. Splitting in two on sampled tokens finds a pair of similarity s in one run with a probability of at least the fixed point
   of p = 1 - (1 - s p)^2 (for 0.8: 0.9375), however deep the paths are.  Runs are repeated until the probability that
   all of them miss a pair is below 1 - ``recall``.
4. In small buckets, pairs are first compared by signature, to drop nodes without a partner.  Then the whole texts come
   in, and every pair that may be near is compared exactly.  A pair that meets in several buckets belongs to the smallest
   one.  Buckets of many or large nodes are cut into blocks and dealt as pairs of blocks.  Tasks report counts per node
   and a spanning forest, never pairs, so a group of thousands of near copies doesn't square the output.
5. Classes are the connected components of the links.

Null and empty texts and texts without words have no shingles: they are linked to nothing and are classes of their own.
A text of fewer than five words has one shingle.  Equal rows are copies of each other; a task takes the text of one of them.  The class id is the smallest id of
the class (null only if all are).  An empty table gives an empty result; columns other than id and text are not used.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SHINGLE_WORDS, SIMILARITY, Shingler, Stage, groups

TOKENS = 64             # sampled tokens of a node
BLOCK_NODES = 256        # nodes of a bucket that is brute-forced as a whole
BLOCK_SHINGLES = 150_000
DENSE = 0.5
MAX_LEVELS = 12
RECALL = 0.9999
LEAST_ESTIMATE = 0.5    # of the signatures of pairs that are compared exactly; at 0.8 it is 6 standard deviations off
_FAN = 2
_WIDTH = 1 << 16


def runs_needed(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold is missed with probability 1 - recall at most."""
    p = 1.0
    for _ in range(1000):
        p = 1 - (1 - threshold * p) ** _FAN
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.Philox(key=[4, 4]))
    return rng.integers(1, 1 << 63, n, dtype=np.uint64), rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


class Signer:
    """Shingle sets, their keys and signatures."""

    def __init__(self, width: int = SHINGLE_WORDS, tokens: int = TOKENS):
        self.shingler = Shingler(width)
        self.xor, self.mul = _orders(tokens)

    def key(self, shingles: np.ndarray) -> bytes:
        return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()

    def sign(self, shingles: np.ndarray) -> bytes:
        low = None
        for at in range(0, len(shingles), 8192):
            part = ((shingles[at:at + 8192, None] ^ self.xor) * self.mul).min(axis=0)
            low = part if low is None else np.minimum(low, part)
        return low.astype(">u8").tobytes()


def nodes_of(df: DataFrame, id_col: str, text_col: str, stage: Stage, width: int) -> tuple[DataFrame, DataFrame]:
    """(documents: id, hash of the text, key) and (nodes: key, n, signature, copies, id and hash of one document)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(width)
        for batch in batches:
            keys, sizes, signs = [], [], []
            for value in batch.column(2):
                s = signer.shingler.shingles(value.as_py())
                keys.append(signer.key(s) if len(s) else None)
                sizes.append(len(s))
                signs.append(signer.sign(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                                              pa.array(signs, pa.binary())], names=["id", "th", "key", "n", "sign"])

    rows = df.select(df[id_col].alias("id"), F.xxhash64(df[text_col]).alias("th"), df[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    docs = stage.keep(rows.mapInArrow(run, f"id {id_type}, th long, key binary, n long, sign binary"), "docs")
    nodes = docs.filter("key IS NOT NULL").groupBy("key").agg(
        F.first("n").alias("n"), F.first("sign").alias("sign"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("one"))
    return docs.select("id", "th", "key"), stage.keep(nodes.select("key", "n", "sign", "copies", "one.id", "one.th"), "nodes")


def _token(sign: Column, at: Column) -> Column:
    return F.substring(sign, at * 8 + 1, 8)


def choose_paths(nodes: DataFrame, stage: Stage, runs: int) -> DataFrame:
    """(bucket, key, n, size, weight) of all buckets that are to be brute-forced."""
    first = F.array(*[F.xxhash64(F.lit(c), _token(F.col("sign"), F.lit(c))) for c in range(runs * _FAN)])
    members = nodes.select("key", "n", F.explode(first).alias("bucket"))
    done, names = [], []
    for level in range(1, MAX_LEVELS + 1):
        size = members.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("weight")).filter("size > 1")
        at = stage.keep(members.join(size, "bucket").select("bucket", "key", "n", "size", "weight"), f"level{level}")
        done.append(at.filter(F.col("size") <= BLOCK_NODES))
        large = at.filter(F.col("size") > BLOCK_NODES)
        if large.isEmpty():
            break
        if level == MAX_LEVELS:
            done.append(large)
            break
        picks = F.array(*[F.struct(F.lit(j).alias("way"), F.pmod(F.xxhash64("bucket", F.lit(j)), F.lit(TOKENS)).cast("int").alias("at"))
                          for j in range(_FAN)])
        kids = large.join(nodes.select("key", "sign"), "key").withColumn("pick", F.explode(picks))
        kids = kids.select("bucket", "key", "n", "size", F.col("pick.way").alias("way"),
                           F.xxhash64("bucket", "pick.way", F.expr("substring(sign, pick.at * 8 + 1, 8)")).alias("child"))
        kids = stage.keep(kids, f"kids{level}")
        names += [f"kids{level}"]
        near = kids.groupBy("bucket", "size", "child").agg(F.count("*").cast("double").alias("c")).groupBy("bucket").agg(
            (F.sum(F.col("c") * F.col("c") / F.col("size") / F.col("size")) / _FAN).alias("near"))
        near = stage.keep(near.select("bucket", (F.col("near") >= DENSE).alias("dense")), f"dense{level}")
        done.append(large.join(near.filter("dense"), "bucket", "left_semi"))
        members = kids.join(near.filter("NOT dense"), "bucket", "left_semi").select("key", "n", F.col("child").alias("bucket"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = stage.keep(out, "leaves")
    stage.drop(*names)
    return out


# --- brute force -----------------------------------------------------------------------------------------------------------
def owned(bucket: int, left: list, right: list) -> np.ndarray:
    """Which pairs belong to this bucket: no smaller one has both.  left, right: the buckets of every node."""
    out = np.ones((len(left), len(right)), bool)
    by: dict[int, tuple[list, list]] = {}
    for side, lists in enumerate((left, right)):
        for i, buckets in enumerate(lists):
            for b in buckets:
                if b < bucket:
                    by.setdefault(b, ([], []))[side].append(i)
    for rows, cols in by.values():
        if rows and cols:
            out[np.ix_(rows, cols)] = False
    return out


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    every = np.concatenate(left + right)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    token = np.cumsum(new) - 1
    often = (np.bincount(token) > 1)[token]
    row, token = row[often], token[often]
    out = np.zeros((len(left), len(right)))
    if not len(token):
        return out
    token = np.cumsum(np.concatenate(([True], token[1:] != token[:-1]))) - 1
    for low in range(0, int(token[-1]) + 1, _WIDTH // 16):
        part = slice(*np.searchsorted(token, (low, low + _WIDTH // 16)))
        x = np.zeros((len(left) + len(right), _WIDTH // 16), np.float32)
        x[row[part], token[part] - low] = 1
        out += x[:len(left)] @ x[len(left):].T
    return out


def _prune(leaves: DataFrame, nodes: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """Of the small buckets, (bucket, key) of the nodes that have a partner by signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())],
                                              names=["bucket", "key"])

        for (bucket,), rows in groups(batches, 1):
            keys, n, buckets = [r[1] for r in rows], np.array([r[2] for r in rows], float), [r[4] for r in rows]
            sign = np.frombuffer(b"".join(r[3] for r in rows), ">u8").reshape(len(rows), -1)
            near = np.zeros((len(rows), len(rows)), np.int32)
            for c in range(sign.shape[1]):
                near += sign[:, c, None] == sign[None, :, c]
            may = (near >= LEAST_ESTIMATE * sign.shape[1]) & (np.minimum.outer(n, n) >= threshold * np.maximum.outer(n, n))
            np.fill_diagonal(may, False)
            if may.any():
                may &= owned(bucket, buckets, buckets)
                out += [(bucket, keys[i]) for i in np.flatnonzero(may.any(1))]
            if len(out) > 5000:
                yield batch()
                out.clear()
        yield batch()

    rows = leaves.join(nodes.select("key", "sign"), "key").join(lists, "key").select("bucket", "key", "n", "sign", "buckets")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "key").mapInArrow(run, "bucket long, key binary")


def _forest(linked: np.ndarray, keys: list) -> dict:
    """node -> smallest node of its component, over the True entries of a square matrix."""
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, row in enumerate(linked):
        for j in np.flatnonzero(row):
            a, b = find(i), find(int(j))
            if a != b:
                if keys[b] < keys[a]:
                    a, b = b, a
                root[b] = a
    return {keys[i]: keys[find(i)] for i in range(len(keys))}


def once(rows: DataFrame, by: int, text: int) -> DataFrame:
    """Drops the rows whose columns ``by`` and ``text`` a task has had before, so repeats aren't shuffled with their text.

    A task holds a node's key and a hash for each text that meets another.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            new = []
            for row in zip(batch.column(by).to_pylist(), map(hash, batch.column(text).to_pylist())):
                new.append(row not in seen)
                seen.add(row)
            yield batch.filter(pa.array(new, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def nodes_once(batches: Iterator[pa.RecordBatch], signer: Signer) -> Iterator[tuple]:
    """(bucket, nodes as (key, copies, buckets, shingles, half)) of each block pair; a node is held once, however often its row is repeated."""
    at, seen, kept = None, set(), []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != at:
                if kept:
                    yield at[0], at[1] == at[2], kept
                at, seen, kept = row[:3], set(), []
            if row[4] not in seen:      # a hash of texts that clash may have given a node more than one text
                shingles = signer.shingler.shingles(row[7])
                if signer.key(shingles) == row[4]:
                    seen.add(row[4])
                    kept.append((row[4], row[5], row[6], shingles, row[3]))
    if kept:
        yield at[0], at[1] == at[2], kept


def compare(texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """(key, root, links, near): for each node and block pair, links to documents, and a forest of the links.

    ``texts``: (bucket, a, b, half, key, copies, buckets, text); a and b are the blocks that meet, half says whether the
    node is of block a (0) or b (1).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, out = Signer(width), []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int64()))],
                                              names=["key", "root", "links"])

        for bucket, same, kept in nodes_once(batches, signer):
            left = [k for k in kept if k[4] == 0]
            right = left if same else [k for k in kept if k[4] == 1]
            if not left or not right or len(kept) < 2:
                continue
            both = common([k[3] for k in left], [k[3] for k in right])
            n, m = (np.array([len(k[3]) for k in side], float) for side in (left, right))
            linked = both / (n[:, None] + m[None, :] - both) >= threshold
            if same:
                np.fill_diagonal(linked, False)
            if linked.any():
                linked &= owned(bucket, [k[2] for k in left], [k[2] for k in right])
            if not linked.any():
                continue
            copies = [np.array([k[1] for k in side]) for side in (left, right)]
            count = dict(zip((k[0] for k in left), (linked * copies[1]).sum(1).tolist()))
            if same:
                keys, square = [k[0] for k in left], linked
            else:
                count |= dict(zip((k[0] for k in right), (linked * copies[0][:, None]).sum(0).tolist()))
                keys, square = [k[0] for k in kept], np.zeros((len(kept), len(kept)), bool)
                square[:len(left), len(left):] = linked
                keys = [k[0] for k in left] + [k[0] for k in right]
            root = _forest(square, keys)
            out += [(k, root[k], int(c)) for k, c in count.items() if c]
            if len(out) > 5000:
                yield batch()
                out.clear()
        yield batch()

    return texts.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "key").mapInArrow(
        run, "key binary, root binary, links long")


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(key, root): the smallest node of each node's component, from edges (key, root).

    Rounds of: take the smallest label around, then the label of that label.  Labels are written each round.
    """
    edges = stage.keep(edges.filter("key <> root").distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("root").alias("key"), F.col("key").alias("root")))
    label = stage.keep(both.groupBy("key").agg(F.min("root").alias("l")).select("key", F.least("l", "key").alias("l")), "label0")
    turn = 0
    while True:
        turn += 1
        other = label.select(F.col("key").alias("root"), F.col("l").alias("lo"))
        around = both.join(other, "root").groupBy("key").agg(F.min("lo").alias("lo"))
        step = label.join(around, "key").select("key", F.col("l").alias("old"), F.least("l", "lo").alias("l"))
        jump = label.select(F.col("key").alias("l"), F.col("l").alias("further"))
        step = step.join(jump, "l", "left").select("key", "old", F.least("l", F.coalesce("further", "l")).alias("l"))
        step = stage.keep(step, f"label{turn}")
        changed = not step.filter("old <> l").isEmpty()
        stage.drop(f"label{turn - 1}")
        label = step.select("key", "l")
        if not changed:
            return label.withColumnRenamed("l", "root")


def places(meet: DataFrame, lists: DataFrame) -> DataFrame:
    """(key, places): the block pairs (bucket, a, b, half) of a bucket that each of its nodes goes to.

    A bucket that is small enough is one block.  In another one, a node's home matters, the smallest of its buckets: nodes of
    one home have been compared there, so elsewhere only nodes of different homes meet.  The nodes of a common home
    get blocks of their own, the others share blocks, and two blocks of one home meet at home alone.  So a group of near
    copies, which meets in every run, is compared once, and apart from that only with its few strays.
    """
    fits = (F.col("size") <= BLOCK_NODES) & (F.col("weight") <= BLOCK_SHINGLES)
    zero = F.lit(0).cast("long")
    place = "array<struct<bucket:bigint,a:bigint,b:bigint,half:int>>"
    one = meet.filter(fits).select("key", F.array(F.struct("bucket", zero.alias("a"), zero.alias("b"), F.lit(0).alias("half"))).cast(place).alias("places"))
    many = meet.filter(~fits).join(lists.select("key", F.col("buckets")[0].alias("home")), "key")
    homes = many.groupBy("bucket", "home").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    common_home = (F.col("m") * 2 >= BLOCK_NODES) | (F.col("home") == F.col("bucket"))
    homes = homes.withColumn("common", common_home).withColumn("kind", F.when(common_home, F.col("home")).otherwise(F.lit(-1)))
    kinds = homes.groupBy("bucket", "kind").agg(F.greatest(F.ceil(F.sum("m") / BLOCK_NODES), F.ceil(F.sum("w") / BLOCK_SHINGLES)).alias("c"))
    blocks = kinds.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("kind", "c"))).alias("kinds"))
    blocks = blocks.withColumn("blocks", F.flatten(F.transform("kinds", lambda k: F.transform(
        F.sequence(zero, k["c"] - 1), lambda j: F.struct(k["kind"].alias("kind"), j.alias("j"))))))
    many = many.join(homes.select("bucket", "home", "kind", "common"), ["bucket", "home"]).join(blocks, "bucket")
    own = F.struct(F.col("kind"), F.pmod(F.xxhash64("key", "bucket"), F.filter("kinds", lambda k: k["kind"] == F.col("kind"))[0]["c"]).alias("j"))
    many = many.withColumn("x", F.array_position("blocks", own) - 1)
    met = F.col("common") & (F.col("home") != F.col("bucket"))
    where = F.transform("blocks", lambda block, y: F.struct(
        F.col("bucket"), F.least("x", y.cast("long")).alias("a"), F.greatest("x", y.cast("long")).alias("b"),
        (F.col("x") > y).cast("int").alias("half"), (met & (block["kind"] == F.col("kind"))).alias("met")))
    where = F.transform(F.filter(where, lambda p: ~p["met"]), lambda p: F.struct(p["bucket"], p["a"], p["b"], p["half"]))
    return one.unionByName(many.select("key", where.cast(place).alias("places")))


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY, recall: float = RECALL,
         width: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: id, class_id (smallest id of its class), n_links (documents linked to it), th (hash of the text), first.

    ``first`` is true for one (id, th) of each class.
    """
    stage = Stage(df.sparkSession, "ngramjoin")
    docs, nodes = nodes_of(df, id_col, text_col, stage, width)
    leaves = choose_paths(nodes, stage, runs_needed(threshold, recall))
    lists = stage.keep(leaves.groupBy("key").agg(F.array_sort(F.collect_list("bucket")).alias("buckets")), "lists")
    small = _prune(leaves.filter(F.col("size") <= BLOCK_NODES), nodes, lists, threshold)
    meet = leaves.join(small, ["bucket", "key"], "left_semi").unionByName(leaves.filter(F.col("size") > BLOCK_NODES))

    meet = places(meet, lists).groupBy("key").agg(F.flatten(F.collect_list("places")).alias("places")).join(lists, "key")
    meet = stage.keep(meet.join(nodes.select("key", "copies", F.col("id").alias("one_id"), F.col("th").alias("one_th")), "key"), "meet")
    texts = df.select(df[id_col].alias("_i"), F.xxhash64(df[text_col]).alias("_t"), df[text_col].alias("text"))
    texts = texts.join(meet, texts["_t"].eqNullSafe(meet["one_th"]) & texts["_i"].eqNullSafe(meet["one_id"]))
    texts = once(texts.select("key", "copies", "buckets", "text", "places"), 0, 3)
    texts = texts.select("key", "copies", "buckets", "text", F.explode("places").alias("place"))
    texts = texts.select("place.bucket", "place.a", "place.b", "place.half", "key", "copies", "buckets", "text")
    found = stage.keep(compare(texts, threshold, width), "found")

    root = components(found.select("key", "root"), stage)
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    classes = nodes.select("key", "copies", "id", "th").join(root, "key", "left").join(links, "key", "left")
    classes = stage.keep(classes.select("key", F.coalesce("root", "key").alias("root"), "id", "th",
                                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    heads = classes.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("head"))
    classes = classes.drop("id", "th").join(heads, "root").select("key", "n_links", F.col("head.id").alias("class_id"), F.col("head.th").alias("head_th"))
    out = docs.join(classes, "key", "left")
    first = F.col("key").isNull() | (F.col("id").eqNullSafe(F.col("class_id")) & F.col("th").eqNullSafe(F.col("head_th")))
    return out.select(F.col("id").alias(id_col), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "th", first.alias("first"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The table with one document of each class: the one with the smallest id.  Rows equal in id and text count once."""
    first = join(df, id_col, text_col, **options).filter("first").select(F.col(id_col).alias("__id"), F.col("th").alias("__t")).distinct()
    rows = df.withColumn("__th", F.xxhash64(df[text_col])).dropDuplicates([id_col, "__th"])
    return rows.join(first, rows[id_col].eqNullSafe(first["__id"]) & rows["__th"].eqNullSafe(first["__t"]), "left_semi").drop("__th")
