"""Approximate nearest neighbours on robust-pruned directed graphs (operator 5).

Distinct vectors are dealt to shards by narrow range of norm (``NORM_RANGE``), within a range by hash.  Each shard has a
graph: it starts random; then, in two passes, a greedy
beam search for every vector proposes neighbours, and relaxed distance pruning keeps the diverse ones: a candidate goes
if a kept neighbour, ``alpha`` times its distance, is no farther from it than the vector is.  Edges are added both ways
and pruned to ``degree`` again.  The graphs are written to the shared folder.  A query is answered by a beam search in
every shard, exact scores of the beam, and a merge of the shards' best.

Nearness is the largest inner product.  Divided by the shard's largest norm and given one more coordinate, all vectors of
a shard get length 1, so the order by inner product is the order by Euclidean distance that the graphs are built for.  A query's
own added coordinate is 0, so it lies beside the nodes; the narrow range keeps their coordinates, and with them that gap, small.
Distances are doubles and come from differences, so neither a few long vectors nor a narrow cluster round them away.

Copies of a vector are one node, with the smallest k + 1 of its ids, which are all that k results can need.  Vectors
that are null, empty, zero or hold null or non-finite components, and rows without id, take no part, neither as queries
nor as candidates.  Vectors of different lengths never meet.  Repeated rows count once.  An empty table or query set
gives an empty result.  Equal scores rank by id.  Columns other than id and vector are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stage

SHARD_VECTORS = 16_384
DEGREE, BUILD_BEAM, ALPHA = 28, 64, 1.2
SEARCH_BEAM = 96
NORM_RANGE = 1.1        # largest norm over smallest, within a shard
EXPAND = 4              # nodes expanded at a time
BATCH = 256             # searches that go step by step together


class Graph:
    """One shard: unit vectors, float64, and out-edges as an (n, degree) table padded with -1."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None):
        self.x = points
        self.edges = edges
        self.entry = int((self.x @ self.x.mean(0)).argmax()) if len(points) else 0

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes nearest to each query found by greedy search, nearest first, padded with -1; and distances."""
        b, n = len(q), len(self.x)
        rows = np.arange(b)[:, None]
        ids = np.full((b, beam), -1)
        dist = np.full((b, beam), np.inf)
        fresh = np.zeros((b, beam), bool)
        seen = np.zeros((b, n + 1), bool)
        seen[:, [self.entry, n]] = True
        ids[:, 0], dist[:, 0], fresh[:, 0] = self.entry, ((q - self.x[self.entry]) ** 2).sum(1), True
        live = np.arange(b)
        while len(live):
            order = np.where(fresh[live], dist[live], np.inf)
            pick = np.argpartition(order, EXPAND - 1, axis=1)[:, :EXPAND] if beam > EXPAND else np.argsort(order, axis=1)
            ok = np.take_along_axis(fresh[live], pick, 1)
            some = ok.any(1)
            live, pick, ok = live[some], pick[some], ok[some]
            if not len(live):
                break
            at = live[:, None]
            fresh[at, pick] = False
            near = self.edges[np.where(ok, ids[at, pick], -1)].reshape(len(live), -1)
            near = np.where(np.repeat(ok, self.edges.shape[1], axis=1), near, n)
            near = np.where(near < 0, n, near)
            near.sort(axis=1)
            new = ~seen[at, near]
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[at, near] = True
            width = max(1, int(new.sum(1).max()))
            if new.shape[1] > width:
                keep = np.argsort(~new, axis=1, kind="stable")[:, :width]
                near, new = np.take_along_axis(near, keep, 1), np.take_along_axis(new, keep, 1)
            off = self.x[np.where(new, near, 0)]
            off -= q[live][:, None]
            d = np.where(new, np.einsum("bnd,bnd->bn", off, off), np.inf)
            all_ids = np.concatenate([ids[live], np.where(new, near, -1)], 1)
            all_d = np.concatenate([dist[live], d], 1)
            all_f = np.concatenate([fresh[live], new], 1)
            best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam] if all_d.shape[1] > beam else np.argsort(all_d, axis=1)
            ids[live], dist[live], fresh[live] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_d, all_f))
        order = np.argsort(dist, axis=1, kind="stable")
        return ids[rows, order], dist[rows, order]

    def prune(self, nodes: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """Relaxed pruning of candidates (padded with -1) of each node; at most ``degree`` stay."""
        b = len(nodes)
        cand = np.sort(np.where(cand == nodes[:, None], -1, cand), axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        off = self.x[np.maximum(cand, 0)]
        off -= self.x[nodes][:, None]
        d = np.where(cand >= 0, np.einsum("bnd,bnd->bn", off, off), np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, :int((cand >= 0).sum(1).max()) or 1]
        cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
        off = np.take_along_axis(off, order[:, :, None], 1)
        near = np.einsum("bnd,bnd->bn", off, off)       # seen from the node, so that rounding is small beside d
        between = near[:, :, None] + near[:, None, :] - 2 * (off @ off.transpose(0, 2, 1))
        alive = np.isfinite(d)
        out, rows = np.full((b, degree), -1), np.arange(b)
        for i in range(degree):
            first = alive.argmax(1)
            ok = alive[rows, first]
            if not ok.any():
                break
            out[ok, i] = cand[ok, first[ok]]
            alive &= ~((alpha * alpha * between[rows, first] <= d) & ok[:, None])
            alive[rows, first] = False
        return out

    def build(self, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> Graph:
        """While it is built, a node has room for twice the degree, so it is pruned once for many reverse edges."""
        n, rng = len(self.x), np.random.default_rng(seed)
        self.edges = np.full((n, 2 * degree), -1)
        start = min(degree // 2, n - 1)
        if start > 0:
            first = rng.integers(0, n - 1, (n, start))
            self.edges[:, :start] = first + (first >= np.arange(n)[:, None])
        for a in (1.0, alpha):
            for lot in np.array_split(rng.permutation(n), max(1, -(-n // BATCH))):
                found, _ = self.search(self.x[lot], beam)
                kept = self.prune(lot, np.concatenate([found, self.edges[lot]], 1), degree, a)
                self.edges[lot, :degree], self.edges[lot, degree:] = kept, -1
                self._back(lot, kept, degree, a)
        out = np.full((n, degree), -1)
        for lot in np.array_split(np.arange(n), max(1, -(-n // BATCH))):
            out[lot] = self.prune(lot, self.edges[lot], degree, alpha)
        self.edges = out
        return self

    def _back(self, lot: np.ndarray, kept: np.ndarray, degree: int, alpha: float) -> None:
        """Adds the reverse of the lot's edges; nodes without room are pruned."""
        to, src = kept.ravel(), np.repeat(lot, kept.shape[1])
        src, to = src[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, src = to[order], src[order]
        nodes, start, count = np.unique(to, return_index=True, return_counts=True)
        have = (self.edges[nodes] >= 0).sum(1)
        place = np.arange(len(to)) - np.repeat(start, count) + np.repeat(have, count)
        room = np.repeat(have + count <= 2 * degree, count)
        self.edges[to[room], place[room]] = src[room]
        full = np.flatnonzero(have + count > 2 * degree)
        for part in np.array_split(full, max(1, -(-len(full) // BATCH))):
            if len(part):
                extra = np.full((len(part), int(count[part].max())), -1)
                for row, i in enumerate(part):
                    extra[row, :count[i]] = src[start[i]:start[i] + count[i]]
                some = nodes[part]
                self.edges[some, :degree] = self.prune(some, np.concatenate([self.edges[some], extra], 1), degree, alpha)
                self.edges[some, degree:] = -1


def _rows(x: pa.Array, kind=np.float64) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(x), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """A shard's vectors at length 1: scaled by the largest norm, with one more coordinate."""
    x = vectors / np.abs(vectors).max()
    x /= np.sqrt((x * x).sum(1).max())
    return np.concatenate([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))[:, None]], 1)


def prepare(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec): the rows that take part; vec holds doubles."""
    vec = df[vector_col].cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(df[id_col].cast("long").alias("id"), vec.alias("vec"))
    return rows.filter(F.col("id").isNotNull() & df[vector_col].isNotNull() & finite & F.exists(vec, lambda x: x != 0))


def build_index(rows: DataFrame, stage: Stage, k: int, shard_vectors: int = SHARD_VECTORS, degree: int = DEGREE,
                beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[DataFrame, dict[int, int]]:
    """Writes the graphs of all distinct vectors; gives them and the number of shards by dimension.

    A shard has about ``shard_vectors`` nodes, or fewer if its range of norms has fewer, so one task holds it; the driver
    gets a row for each dimension and range, of which doubles have some 15,000 and lengths within a factor of a million 145.
    """
    first = rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("r") <= k + 1)
    nodes = first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("vec"))
    top = F.array_max(F.transform("vec", F.abs))
    norm = F.log2(top) + F.log2(F.aggregate("vec", F.lit(0.0), lambda s, x: s + (x / top) * (x / top))) / 2
    nodes = stage.keep(nodes.withColumn("range", F.round(norm / math.log2(NORM_RANGE)).cast("int")), "nodes")
    shards, start, sizes = [], [], {}
    for r in nodes.groupBy("dim", "range").agg(F.count("*").alias("n")).orderBy("dim", "range").collect():
        key, n = F.lit(f"{r['dim']} {r['range']}"), -(-r["n"] // shard_vectors)
        shards += [key, F.lit(n)]
        start += [key, F.lit(sizes.get(r["dim"], 0))]
        sizes[r["dim"]] = sizes.get(r["dim"], 0) + n
    if not sizes:
        return nodes.select(F.lit(0).cast("long").alias("shard"), F.lit(0).alias("pos"), "vec", "ids", F.array().cast("array<int>").alias("edges")), {}
    key = F.concat_ws(" ", "dim", "range")
    number = F.create_map(*start)[key] + F.pmod(F.xxhash64("vec"), F.create_map(*shards)[key].cast("long"))
    nodes = nodes.withColumn("shard", F.col("dim").cast("long") * (1 << 32) + number)

    def build(batches: Iterator[pa.Table] | pa.Table) -> pa.Table:
        table = batches
        shard = table.column("shard")[0].as_py()
        vectors = _rows(table.column("vec").combine_chunks())
        graph = Graph(_unit(vectors)).build(degree, beam, alpha, seed=shard)
        edges = [row[row >= 0] for row in graph.edges.astype(np.int32)]
        return pa.table({"shard": table.column("shard"), "pos": pa.array(np.arange(len(edges), dtype=np.int32)), "vec": table.column("vec"),
                         "ids": table.column("ids"), "edges": pa.array(edges, pa.list_(pa.int32()))})

    parts = 4 * sum(sizes.values())
    index = nodes.repartition(parts, "shard").groupBy("shard").applyInArrow(
        build, "shard long, pos int, vec array<double>, ids array<long>, edges array<int>")
    index = stage.keep(index, "index")
    stage.drop("nodes")
    return index, sizes


def _best(ids: list, scores: list, k: int) -> tuple[list, list]:
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    return [ids[i] for i in order], [scores[i] for i in order]


def search(index: DataFrame, sizes: dict, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, degree: int = DEGREE) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id, vec) queries.  A query's own id is not among its results.

    A task streams the queries past one shard's graph; another streams the shards' answers of a query into its best k.
    """
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return queries.sparkSession.createDataFrame([], empty)
    parts = 4 * sum(sizes.values())
    shards = F.create_map(*[F.lit(x) for size in sizes.items() for x in size])
    dim = F.size("vec")
    asked = (queries.distinct().filter(dim.isin(list(sizes)))
             .withColumn("number", F.explode(F.sequence(F.lit(0), shards[dim] - 1)))
             .select((dim.cast("long") * (1 << 32) + F.col("number")).alias("shard"), F.lit(1).alias("kind"), F.lit(0).alias("pos"),
                     F.col("id").alias("query"), F.xxhash64("vec").alias("of"), "vec", F.array().cast("array<long>").alias("ids"),
                     F.array().cast("array<int>").alias("edges")))
    both = index.select("shard", F.lit(0).alias("kind"), "pos", F.lit(None).cast("long").alias("query"), F.lit(0).cast("long").alias("of"),
                        "vec", "ids", "edges").unionByName(asked)

    def answer(graph: Graph, vectors, ids, rows) -> pa.RecordBatch:
        q = np.array([r[2] for r in rows])
        length = np.abs(q).max(1, keepdims=True)
        unit = q / length
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        found, _ = graph.search(np.concatenate([unit, np.zeros((len(q), 1))], 1), min(beam, len(vectors)))
        names, scores = [], []
        for (own, _, _), vec, near in zip(rows, q, found):
            near = near[near >= 0]
            score = vectors[near] @ vec
            got = [(i, s) for node, s in zip(near.tolist(), score.tolist()) for i in ids[node] if i != own]
            n, s = _best([i for i, _ in got], [s for _, s in got], k)
            names.append(n)
            scores.append(s)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array(names, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))],
                                          names=["query", "of", "ids", "scores"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, nodes, graph, wait = None, [], None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "query", "of", "vec", "ids", "edges"))):
                if row[0] != shard or (row[1] == 0 and graph is not None):
                    if wait:
                        yield answer(graph, vectors, ids, wait)
                    shard, nodes, graph, wait = row[0], [], None, []
                if row[1] == 0:
                    nodes.append(row[4:])
                    continue
                if graph is None:
                    vectors = np.array([v for v, _, _ in nodes])
                    ids = [i for _, i, _ in nodes]
                    edges = np.full((len(nodes), degree), -1)
                    for i, (_, _, e) in enumerate(nodes):
                        edges[i, :len(e)] = e
                    graph, nodes = Graph(_unit(vectors), edges), []
                wait.append((row[2], row[3], row[4]))
                if len(wait) == BATCH:
                    yield answer(graph, vectors, ids, wait)
                    wait = []
        if wait:
            yield answer(graph, vectors, ids, wait)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            flat = [(q, r + 1, i, s) for q, ids, scores in rows for r, (i, s) in enumerate(zip(ids, scores))]
            cols = list(zip(*flat)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))],
                                              names=["query_id", "rank", "vec_id", "score"])

        key, ids, scores, done = None, [], [], []
        for batch in batches:
            for q, of, i, s in zip(*(batch.column(c).to_pylist() for c in ("query", "of", "ids", "scores"))):
                if (q, of) != key:
                    if key:
                        done.append((key[0], ids, scores))
                    key, ids, scores = (q, of), [], []
                    if len(done) == 1000:
                        yield out(done)
                        done = []
                ids, scores = _best(ids + i, scores + s, k)
        if key:
            done.append((key[0], ids, scores))
        yield out(done)

    answers = both.repartition(parts, "shard").sortWithinPartitions("shard", "kind", "pos", "query").mapInArrow(
        visit, "query long, of long, ids array<long>, scores array<double>")
    return answers.repartition("query").sortWithinPartitions("query", "of").mapInArrow(merge, empty)


def nearest(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            shard_vectors: int = SHARD_VECTORS, beam: int = SEARCH_BEAM) -> DataFrame:
    """The k nearest found of every query row, among all rows of ``df``."""
    stage = Stage(df.sparkSession, "ann")
    index, sizes = build_index(prepare(df, id_col, vector_col), stage, k, shard_vectors)
    return search(index, sizes, prepare(queries, id_col, vector_col), k, max(beam, k + 1))
