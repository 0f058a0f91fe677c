"""Conversation prefix trie with balanced parentheses per shard (operator 12).

A node is a distinct sequence of first turns (role, text); a conversation is a member of the nodes of all its prefixes, from
the textless root to its end.  A prefix has a 128-bit key: the exclusive or of the hashes of its turns with their places, so
keys of all prefixes come from running sums, in chunks of ``CHUNK`` turns with the earlier chunks' totals carried over, and a
conversation of any length is spread over tasks.  Counting the members, children and smallest member of a node is a grouping
by key.

What holds for whole subtrees comes from the shards.  Nodes with the same members form a chain, a chain is one pair of
parentheses, and a conversation is the list of its chains: at most about sqrt(2 * turns) of them, as their member counts fall,
plus one for every ``CHUNK`` turns it shares.  Distinct conversations are sorted by their lists, which puts the members of a chain side by side, and cut
anywhere into shards.  A shard's trie is a string of parentheses with its excess in blocks under a tree of their minima:
``findclose`` gives where a chain's subtree ends, the rank of the pairs "()" counts its leaves, and a cumulative array its
savings.  A chain that lies in several shards (their shared spine) gets the sum of its parts; its own saving counts in the one
shard that holds its smallest member.  The saving of a node in the middle of a chain follows from running byte counts.

Null roles and texts are empty.  Repeated rows are turns of their own; ties of the order are broken by the hash of the turn.  Rows
without conversation id take no part.  Turnless conversations are members of the root and end there.  No conversation at all
gives no node.  Long texts are hashed where they are read and moved no further.  Only the columns named are used, so clashing
ones don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stage

CHUNK = 4_096           # turns of one conversation in a window
SALTS = 16              # a common prefix meets its members under so many keys
SHARD_PATHS = 20_000    # distinct conversations in one string of parentheses, at most
ENDS = 1_000            # ids in one piece of a list of ends
BLOCK = 64              # parentheses in a block of the excess tree
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- order and running keys -------------------------------------------------------------------------------------------------
def turns(df: DataFrame, id_col: str, order_col: str, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, h1, h2, bytes): every turn with two hashes of its role and text and its text's length in UTF-8."""
    role, text = F.coalesce(df[role_col], F.lit("")), F.coalesce(df[text_col], F.lit(""))
    rows = df.select(df[id_col].cast("long").alias("conv"), df[order_col].alias("at"), F.xxhash64(F.lit(1), role, text).alias("h1"),
                     F.xxhash64(F.lit(2), text, role).alias("h2"), F.octet_length(text).cast("long").alias("bytes"))
    return rows.filter(F.col("conv").isNotNull())


def number(rows: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Adds pos, from 1, the place of a turn in its conversation, null order first.

    Turns are sorted into ranges, so a large conversation lies in many; a range's places start after those of the earlier ranges.
    """
    order = ["conv", F.col("at").asc_nulls_first(), "h1", "h2"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id())
    ranged = stage.keep(ranged, f"{name}_ranges")
    counts = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("before > 0").drop("n")
    own = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order[1:]))
    placed = ranged.withColumn("own", own).join(counts, ["conv", "range"], "left")
    return placed.withColumn("pos", F.col("own") + F.coalesce("before", F.lit(0))).drop("range", "own", "before", "at")


def _chunk(pos: Column) -> Column:
    return F.floor((pos - 1) / CHUNK)


def running(numbered: DataFrame, ids: DataFrame, stage: Stage) -> DataFrame:
    """(conv, pos, k1, k2, sum, bytes, last): keys and byte counts of all prefixes, with the empty one at pos 0."""
    rows = numbered.select("conv", "pos", F.xxhash64(F.lit(3), "pos", "h1").alias("z1"), F.xxhash64(F.lit(4), "pos", "h2").alias("z2"), "bytes",
                           _chunk(F.col("pos")).alias("chunk"))
    rows = stage.keep(rows, "turns")
    totals = rows.groupBy("conv", "chunk").agg(F.bit_xor("z1").alias("t1"), F.bit_xor("z2").alias("t2"), F.sum("bytes").alias("t"),
                                               F.max("pos").alias("top"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = totals.select("conv", "chunk", *[F.coalesce(f(c).over(before), zero).alias(n) for f, c, n in (
        (F.bit_xor, "t1", "c1"), (F.bit_xor, "t2", "c2"), (F.sum, "t", "c"))], F.max("top").over(Window.partitionBy("conv")).alias("top"))
    inside = Window.partitionBy("conv", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    steps = rows.select("conv", "chunk", "pos", "bytes", F.bit_xor("z1").over(inside).alias("z1"), F.bit_xor("z2").over(inside).alias("z2"),
                        F.sum("bytes").over(inside).alias("s")).join(carried, ["conv", "chunk"])
    steps = steps.select("conv", "pos", F.col("z1").bitwiseXOR(F.col("c1")).alias("k1"), F.col("z2").bitwiseXOR(F.col("c2")).alias("k2"),
                         (F.col("s") + F.col("c")).alias("sum"), "bytes", (F.col("pos") == F.col("top")).alias("last"))
    empty = rows.select("conv").distinct().withColumn("some", F.lit(True))
    roots = ids.select(F.col("id").cast("long").alias("conv")).filter("conv IS NOT NULL").distinct().join(empty, "conv", "full_outer")
    roots = roots.select("conv", zero.alias("pos"), zero.alias("k1"), zero.alias("k2"), zero.alias("sum"), zero.alias("bytes"),
                         F.col("some").isNull().alias("last"))
    return stage.keep(steps.withColumn("pos", F.col("pos").cast("long")).unionByName(roots), "steps")


# --- balanced parentheses ---------------------------------------------------------------------------------------------------
class Parentheses:
    """A balanced string: excess after each place, and the least excess of blocks in a binary tree over them."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        n = len(opens)
        blocks = 1 << max(0, (-(-n // BLOCK) - 1)).bit_length()
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:n] = self.excess
        self.blocks = padded.reshape(blocks, BLOCK)
        self.levels = [self.blocks.min(1)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].reshape(-1, 2).min(1))
        pair = opens[:-1] & ~opens[1:]
        self.pairs = np.concatenate(([0], np.cumsum(pair), [int(pair.sum())]))      # "()" that start before a place
        self.opened = np.concatenate(([0], np.cumsum(opens)))                       # "(" before a place

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The place that closes each "(": the first one after it whose excess is below its own."""
        want = self.excess[at] - 1
        out = np.empty(len(at), np.int64)
        for low in range(0, len(at), 1 << 14):
            some = slice(low, low + (1 << 14))
            out[some] = self._close(at[some], want[some])
        return out

    def _in_block(self, block: np.ndarray, start: np.ndarray, want: np.ndarray) -> np.ndarray:
        hit = (self.blocks[block] <= want[:, None]) & (np.arange(BLOCK) >= start[:, None])
        return np.where(hit.any(1), block * BLOCK + hit.argmax(1), -1)

    def _close(self, at: np.ndarray, want: np.ndarray) -> np.ndarray:
        out = self._in_block(at // BLOCK, at % BLOCK + 1, want)
        left = np.flatnonzero(out < 0)
        node, level = at[left] // BLOCK, np.zeros(len(left), np.int64)
        todo = np.arange(len(left))
        for k, least in enumerate(self.levels[:-1]):        # up, until the right-hand neighbour holds the place
            even = node[todo] % 2 == 0
            near = np.where(even, node[todo] + 1, node[todo])
            found = even & (least[near] <= want[left[todo]])
            node[todo[found]], level[todo[found]] = near[found], k
            todo = todo[~found]
            node[todo] //= 2
        for k in range(len(self.levels) - 2, -1, -1):       # and down again, to the left where that is enough
            some = np.flatnonzero(level > k)
            down = 2 * node[some]
            node[some] = np.where(self.levels[k][down] <= want[left[some]], down, down + 1)
        out[left] = self._in_block(node, np.zeros(len(left), np.int64), want[left])
        return out


class Shard:
    """The trie of consecutive distinct conversations, each a list of chains (owner, top, saving)."""

    def __init__(self):
        self.opens: list[bool] = []
        self.chains: list[tuple[int, int]] = []
        self.saving: list[int] = []
        self.stack: list[tuple[tuple[int, int], int]] = []
        self.paths, self.open_leaf = 0, False

    def add(self, conv: int, path: list[tuple[int, int, int]], childless: bool) -> None:
        keep = 0
        while keep < min(len(path), len(self.stack)) and self.stack[keep][0] == path[keep][:2]:
            keep += 1
        self.opens += [False] * (len(self.stack) - keep)
        del self.stack[keep:]
        for owner, top, _ in path[keep:]:
            self.stack.append(((owner, top), len(self.chains)))
            self.opens.append(True)
            self.chains.append((owner, top))
            self.saving.append(0)
        for (owner, _, saving), (_, place) in zip(path, self.stack):
            if owner == conv:
                self.saving[place] = saving
        self.paths, self.open_leaf = self.paths + 1, not childless

    def sums(self) -> list[tuple[int, int, int, int]]:
        """(owner, top, leaves, saved) of every chain: its subtree within this shard."""
        opens = np.array(self.opens + [False] * len(self.stack), bool)
        tree = Parentheses(opens)
        at = np.flatnonzero(opens)
        close = tree.findclose(at)
        leaves = tree.pairs[close] - tree.pairs[at]
        if self.open_leaf:      # the last conversation goes on in the next shard, so its "()" is no leaf
            leaves[[place for _, place in self.stack]] -= 1
        total = np.concatenate(([0], np.cumsum(np.array(self.saving, np.int64))))
        saved = total[tree.opened[close]] - total[tree.opened[at]]
        return [(o, t, n, s) for (o, t), n, s in zip(self.chains, leaves.tolist(), saved.tolist())]


def _shards(shard_paths: int):
    names, types = ["owner", "top", "leaves", "saved"], [pa.int64()] * 4

    def out(shard: Shard) -> pa.RecordBatch:
        columns = list(zip(*shard.sums())) if shard.paths else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for conv, chains, childless in zip(*(batch.column(c).to_pylist() for c in ("conv", "chains", "childless"))):
                if shard.paths == shard_paths or len(shard.opens) > 100 * shard_paths:
                    yield out(shard)
                    shard = Shard()
                shard.add(conv, [(c["owner"], c["top"], c["saving"]) for c in chains], childless)
        yield out(shard)

    return run


# --- ends -------------------------------------------------------------------------------------------------------------------
def _runs(batches: Iterator[pa.RecordBatch], last: str) -> Iterator[tuple[tuple[int, int], object]]:
    for batch in batches:
        for owner, depth, value in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", last))):
            yield (owner, depth), value


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins consecutive ids of one node, at most ``ENDS`` in a piece."""
    rows: list = []

    def out():
        columns = list(zip(*((o, d, ids[0], ",".join(map(str, ids))) for (o, d), ids in rows))) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["owner", "depth", "first", "ids"])

    for key, conv in _runs(batches, "conv"):
        if rows and rows[-1][0] == key and len(rows[-1][1]) < ENDS:
            rows[-1][1].append(conv)
        else:
            if len(rows) == 10_000:
                yield out()
                rows = []
            rows.append((key, [conv]))
    yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feeds a node's pieces, in order, to its SHA-256; only its state is held."""
    rows: list = []
    at, state = None, None

    def out():
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                          names=["owner", "depth", "ends_sha256"])

    for key, ids in _runs(batches, "ids"):
        if key == at:
            state.update(b"," + ids.encode())
            continue
        if state:
            rows.append((*at, state.hexdigest()))
            if len(rows) == 10_000:
                yield out()
                rows = []
        at, state = key, hashlib.sha256(ids.encode())
    if state:
        rows.append((*at, state.hexdigest()))
    yield out()


def end_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) from (owner, depth, conv): ids in ascending order, comma-joined.

    Sorted ranges join ids to pieces first, so of a node's many ends one task sees a thousandth of the rows, in a stream.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(parts, "owner", "depth", "conv").sortWithinPartitions("owner", "depth", "conv").mapInArrow(
        _pieces, "owner long, depth long, first long, ids string")
    return pieces.repartition(parts, "owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(
        _digests, "owner long, depth long, ends_sha256 string")


# --- the trie ---------------------------------------------------------------------------------------------------------------
def trie(numbered: DataFrame, ids: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """All nodes of the conversations (conv, pos, h1, h2, bytes), pos from 1 without gaps, and of those that ``ids`` (id) adds.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree,
    members beyond the first times bytes of the last text), ends_sha256.
    """
    spark = numbered.sparkSession
    stage = Stage(spark, "prefixtrie")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = running(numbered, ids, stage)
    key = ["pos", "k1", "k2"]
    nodes = stage.keep(steps.groupBy(*key).agg(F.count("*").alias("n_convs"), F.min("conv").alias("owner")), "nodes")
    shared = nodes.filter("n_convs > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = steps.withColumn("salt", F.pmod(F.xxhash64("conv"), F.lit(SALTS)).cast("int")).join(shared, [*key, "salt"], "left").drop("salt")
    met = met.withColumn("n_convs", F.coalesce("n_convs", F.lit(1).cast("long"))).withColumn("owner", F.coalesce("owner", "conv"))

    # chains: a row at the end of a chunk is also the first of the next one, where it only lends its values
    chunk = F.floor(F.col("pos") / CHUNK)
    both = F.when((F.col("pos") % CHUNK == 0) & (F.col("pos") > 0), F.array(chunk - 1, chunk)).otherwise(F.array(chunk))
    rows = met.withColumn("chunk", F.explode(both)).withColumn("lends", (F.col("pos") % CHUNK == 0) & (F.col("pos") > 0)
                                                                & (F.col("chunk") * CHUNK == F.col("pos")))
    order = Window.partitionBy("conv", "chunk").orderBy("pos")
    rows = rows.withColumn("above", F.lag("owner").over(order)).withColumn("n_above", F.lag("n_convs").over(order))
    starts = F.col("n_above").isNull() | (F.col("n_above") != F.col("n_convs")) | F.coalesce(F.lag("lends").over(order), F.lit(False))
    rows = rows.withColumn("starts", ~F.col("lends") & starts)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("top", F.max(F.when(F.col("starts"), F.col("pos"))).over(so_far))
    rows = rows.withColumn("base", F.max(F.when(F.col("starts"), F.col("sum") - F.col("bytes"))).over(so_far))
    rows = stage.keep(rows.filter("NOT lends").select("conv", *key, "sum", "bytes", "last", "n_convs", "owner", "above", "top", "base"), "met")

    own = rows.filter("owner = conv")
    children = own.filter("pos > 0").groupBy(F.col("above").alias("conv"), (F.col("pos") - 1).alias("pos")).agg(
        F.count("*").alias("n_children"))
    own = own.join(children, ["conv", "pos"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = stage.keep(own, "own")

    # one entry for each chain of a distinct conversation; of its own private turns, one chain for all
    bottom = rows.groupBy("conv", "owner", "top", "n_convs").agg(F.max("sum").alias("sum"), F.max("base").alias("base"))
    entries = bottom.filter("n_convs > 1").unionByName(
        bottom.filter("n_convs = 1").groupBy("conv", "owner", "n_convs").agg(F.min("top").alias("top"), F.max("sum").alias("sum"), F.min("base").alias("base")))
    heads = entries.withColumn("saving", (F.col("n_convs") - 1) * (F.col("sum") - F.col("base")))
    distinct = own.filter("last").select("conv", (F.col("n_children") == 0).alias("childless"))
    paths = heads.join(distinct, "conv").groupBy("conv", "childless").agg(
        F.array_sort(F.collect_list(F.struct("top", "owner", "saving"))).alias("chains"))
    order_by = F.transform("chains", lambda c: F.struct(c["top"], c["owner"]))
    paths = paths.select("conv", "childless", "chains", order_by.alias("key"))
    summed = (paths.repartitionByRange(parts, "key").sortWithinPartitions("key").select("conv", "chains", "childless")
              .mapInArrow(_shards(shard_paths), "owner long, top long, leaves long, saved long"))
    summed = summed.groupBy("owner", "top").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    summed = stage.keep(summed.withColumnRenamed("owner", "conv"), "summed")

    ended = end_digests(rows.filter("last").select("owner", F.col("pos").alias("depth"), "conv"))
    out = own.join(summed, ["conv", "top"], "left").join(
        ended.select(F.col("owner").alias("conv"), F.col("depth").alias("pos"), "ends_sha256"), ["conv", "pos"], "left")
    private = F.col("n_convs") == 1
    over = (F.col("n_convs") - 1) * (F.col("sum") - F.col("bytes") - F.col("base"))
    return out.select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), F.col("above").alias("parent_conv_id"), "n_convs", "n_children",
        F.when(private, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"),
        F.when(private, F.lit(0).cast("long")).otherwise(F.col("saved") - over).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
