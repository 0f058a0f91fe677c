"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 10).

* A document's size is its number of words.  It is cut into blocks of at most ``block_words`` words; most documents
  are one block.
* A source's target is its weight's share of all words, at most ``cap`` times its size; what is cut off is shared
  again by weight among the others until none is above.
* A source's blocks are permuted by a seeded hash.  The mix takes the whole permutation floor(target / size) times and
  then its beginning, up to the block boundary next to the target.  That makes an exact quota of blocks per source.
* The tree splits the vector of quotas among the output shards: at every node the left half of the shards draws its
  blocks from all sources without replacement, so a leaf has an exact quota of every source.  The shards' quotas cut a
  source's drawn sequence into disjoint ranges.  Within a shard the blocks stand in the order of another hash.

Nothing of a source is gathered in one task: permutations are ranked in cells of some hundred blocks.  Equal input
and seed give an equal mix, whatever the partitioning; rows equal in all of source, ``key`` and text share a hash and are
interchangeable.  Null texts have no words and are blocks of size 0, a null source is a source.  An empty table gives an
empty mix.  Other columns only pass through ``keep``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, Stage

BLOCK_WORDS = 512
CELL_BLOCKS = 512
SHARDS = 64
CAP = 3.0
SEED = 20
GROUPS = 1024           # sources are split by groups first, so the driver's table is GROUPS x shards at most


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


# --- targets -----------------------------------------------------------------------------------------------------------
def cycle_weights(sources: DataFrame, stage: Stage, weights=(5.0, 2.0, 1.0)) -> DataFrame:
    """Adds ``weight``: the given ones in turn, over the sources in code-point order, null last.

    The sources are sorted in ranges and numbered in each, so there may be any number of them.
    """
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage.keep(sources.repartitionByRange(parts, F.col("source").asc_nulls_last()).withColumn("_p", F.spark_partition_id()), "ranges")
    counts = dict(dealt.groupBy("_p").count().collect())
    if not counts:
        return sources.withColumn("weight", F.lit(0.0))
    before, start = 0, []
    for p in sorted(counts):
        start += [F.lit(p), F.lit(before)]
        before += counts[p]
    rank = F.create_map(*start)[F.col("_p")] + F.row_number().over(Window.partitionBy("_p").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))).drop("_p")


def set_targets(sources: DataFrame, stage: Stage, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to (source, size, weight): weights' shares of the sum of sizes, none above cap * size."""
    sources = stage.keep(sources, "weighted")
    top = F.col("size") * cap
    total = float(sources.agg(F.sum("size")).first()[0] or 0)
    level, full = 0.0, F.lit(False)
    while True:
        fixed, weight, n = sources.agg(F.sum(F.when(full, top)), F.sum(F.when(~full, F.col("weight"))),
                                       F.sum(full.cast("long"))).first()
        if not weight:
            break
        level = (total - (fixed or 0.0)) / weight
        above = F.lit(level) * F.col("weight") > top
        if sources.agg(F.sum(above.cast("long"))).first()[0] == n:
            break
        full = above        # the level only rises, so who is full stays so
    return sources.withColumn("target", F.when(full, top).otherwise(F.lit(level) * F.col("weight")))


# --- the splitting tree --------------------------------------------------------------------------------------------------
def _drawn(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """How many of n draws without replacement are good; beyond a billion balls by the normal approximation."""
    if good + bad < 10 ** 9:
        return int(rng.hypergeometric(good, bad, n)) if good + bad else 0
    total, p = good + bad, good / (good + bad)
    sd = math.sqrt(n * p * (1 - p) * (total - n) / max(1, total - 1))
    return int(min(good, n, max(0, n - bad, round(rng.normal(n * p, sd)))))


def split_tree(quotas, capacity, seed: int) -> np.ndarray:
    """Blocks by (source, shard): rows sum to the quotas, columns to the capacities."""
    out = np.zeros((len(quotas), len(capacity)), np.int64)

    def node(have: list[int], lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = have
            return
        mid = (lo + hi) // 2
        rng = np.random.Generator(np.random.Philox(key=[seed, lo << 32 | hi]))
        left, n, rest = [], int(sum(capacity[lo:mid])), int(sum(have))
        for x in have:
            rest -= x
            left.append(_drawn(x, rest, n, rng))
            n -= left[-1]
        node(left, lo, mid)
        node([x - y for x, y in zip(have, left)], mid, hi)

    if len(quotas):
        node([int(x) for x in quotas], 0, len(capacity))
    return out


def shard_bounds(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(_s, bounds): where the ranges of shards 1, 2, ... begin in each source's drawn sequence; from (_s, quota)."""
    grouped = quotas.withColumn("_g", F.pmod(F.xxhash64("_s"), F.lit(GROUPS)))
    totals = {r["_g"]: r["n"] for r in grouped.groupBy("_g").agg(F.sum("quota").alias("n")).collect()}
    order, all_ = sorted(totals), sum(totals.values())
    matrix = split_tree([totals[g] for g in order], [all_ // shards + (k < all_ % shards) for k in range(shards)], seed)
    by_group = {g: matrix[i] for i, g in enumerate(order)}

    def split(pdf):
        pdf = pdf.sort_values("_s")
        g = int(pdf["_g"].iloc[0])
        table = split_tree(pdf["quota"].tolist(), by_group[g], seed + 1 + g)
        return pdf[["_s"]].assign(bounds=list(np.cumsum(table, axis=1)[:, :-1]))

    return grouped.groupBy("_g").applyInPandas(split, "_s string, bounds array<long>")


# --- blocks ----------------------------------------------------------------------------------------------------------------
def _blocks(df: DataFrame, source: str, text: str, key: str, keep, block_words: int, seed: int, with_text: bool) -> DataFrame:
    """One row per block: _s, keep, _doc (hash of the document), _block, _words, _u (place in the permutation)."""
    rows = df.select(_key(df[source]).alias("_s"), *keep, df[text].alias("_text"), word_count(df[text]).alias("_n"),
                     F.xxhash64(F.lit(seed), df[key], df[source], df[text]).alias("_doc"))
    last = F.greatest(F.ceil(F.col("_n") / block_words), F.lit(1)) - 1
    if with_text:
        white = r"\x20\x09-\x0D"
        tokens = F.split("_text", rf"(?<=[{white}])(?=[^{white}])")
        tokens = F.when(F.col("_text").rlike(rf"^[{white}]"), F.concat(F.array(F.concat(tokens[0], F.coalesce(F.get(tokens, F.lit(1)), F.lit("")))),
                                                                     F.slice(tokens, F.lit(3), F.greatest(F.size(tokens), F.lit(1))))).otherwise(tokens)
        piece = F.when(last == 0, F.array("_text")).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda b: F.array_join(
            F.slice(tokens, (b * block_words + 1).cast("int"), F.lit(block_words)), "")))
        rows = rows.select("*", F.posexplode(piece).alias("_block", "_piece"))
    else:
        rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.drop("_text").withColumn("_words", F.when(F.col("_block") < last, F.lit(block_words).cast("long"))
                                         .otherwise(F.col("_n") - last * block_words))
    return rows.withColumn("_u", F.xxhash64("_doc", F.col("_block").cast("long")))


def plan(df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", keep=(), weigh=cycle_weights,
         cap: float = CAP, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, with_text: bool = False) -> DataFrame:
    """Every block with what the mix does with it.

    Columns: ``keep`` (Columns), _doc, _block, _words, source_size, target, copies, draws (array of (shard, place) structs,
    place giving the order inside the shard), and _piece, the block's text, if asked for.
    ``weigh`` maps (source, size) and a Stage to the same with ``weight``.
    """
    stage = Stage(df.sparkSession, "mixing")
    narrow = _blocks(df, source, text, key, [df[source].alias("_source")], block_words, seed, False)
    cell_of = F.shiftrightunsigned("_u", 64 - 20)       # finest cells; merged below
    fine = stage.keep(narrow.groupBy("_s", cell_of.alias("_fine")).agg(
        F.first("_source").alias("source"), F.sum("_words").alias("words"), F.count("*").alias("n")), "fine")
    total = fine.agg(F.sum("n")).first()[0] or 0
    bits = max(0, min(20, math.ceil(math.log2(max(1, total) / CELL_BLOCKS)) if total else 0))

    sources = fine.groupBy("_s").agg(F.first("source").alias("source"), F.sum("words").alias("size"), F.sum("n").alias("blocks"))
    goals = set_targets(weigh(sources, stage), stage, cap)
    times = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    goals = goals.withColumn("times", times).withColumn("rest", F.col("target") - F.col("times") * F.col("size"))
    goals = stage.keep(goals.select("_s", "size", "target", "blocks", "times", "rest"), "goals")

    cells = fine.groupBy("_s", F.shiftright("_fine", 20 - bits).alias("_cell")).agg(F.sum("words").alias("words"), F.sum("n").alias("n"))
    along = Window.partitionBy("_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("_s", "_cell", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("words0"),
                         F.coalesce(F.sum("n").over(along), F.lit(0)).alias("n0")).join(goals, "_s")
    cells = stage.keep(cells, "cells")
    cell = F.shiftright(F.shiftrightunsigned("_u", 64 - 20), 20 - bits).alias("_cell")

    def ranked(blocks: DataFrame) -> DataFrame:
        """Adds rank and copies, inside cells."""
        order = Window.partitionBy("_s", "_cell").orderBy("_u", "_doc")
        run = F.col("words0") + F.coalesce(F.sum("_words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        out = blocks.select("*", cell).join(cells, ["_s", "_cell"])
        out = out.withColumn("_rank", F.col("n0") + F.row_number().over(order) - 1).withColumn("_before", run)
        return out.withColumn("copies", F.col("times") + (F.col("_before") + F.col("_words") / 2 <= F.col("rest")).cast("long"))

    quotas = stage.keep(ranked(narrow).groupBy("_s").agg(F.sum("copies").alias("quota")), "quotas")
    bounds = stage.keep(shard_bounds(quotas, shards, seed), "bounds")
    blocks = _blocks(df, source, text, key, list(keep), block_words, seed, with_text)
    out = ranked(blocks).join(F.broadcast(bounds) if bounds.count() * shards <= 1_000_000 else bounds, "_s", "left")
    draw = F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), lambda e: F.struct(
        F.size(F.filter("bounds", lambda b: b <= e * F.col("blocks") + F.col("_rank"))).alias("shard"),
        F.xxhash64(F.lit(seed), F.col("_u"), e).alias("place")))
    return out.withColumn("draws", F.when(F.col("copies") > 0, draw)).withColumnRenamed("size", "source_size").drop(
        "_s", "_cell", "_u", "_n", "words0", "n0", "blocks", "times", "rest", "_rank", "_before", "bounds")


def mix(df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: all columns of the table, once per drawn block, with the block's text; and shard.

    Rows are dealt by shard and stand in the shard's shuffled order, so written files are the shards.
    """
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    drawn = plan(df, source, text, key, keep=[df[c].alias(n) for c, n in names.items() if c != text], with_text=True, **options)
    drawn = drawn.withColumn("_draw", F.explode("draws"))
    drawn = drawn.repartition("_draw.shard").sortWithinPartitions("_draw.shard", "_draw.place", "_doc", "_block")
    return drawn.select(*[F.col("_piece").alias(c) if c == text else F.col(n).alias(c) for c, n in names.items() if c != "shard"],
                        F.col("_draw.shard").alias("shard"))
