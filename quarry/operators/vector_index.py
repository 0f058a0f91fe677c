"""A vector index with trained cells (R3), and threshold search pruned by pivots.

**Index.**  A quantiser is trained by k-means on a bounded sample: centroids of cells, and codebooks of what is left of a vector
in its cell, one for each group of coordinates.  ``build_index`` writes every row's code, a byte for each group, into the folder of its
cell; a row on a boundary goes to the second nearest cell too.  A cell with many rows is cut into shards by its own size.
``search_index`` sends a query to the shards of its nearest cells.  A task looks up the code distances of one shard's rows and
keeps the best few of each query; over all shards, the best ``rerank`` of a query are compared exactly.  So of a probed row only
the code is read, an eighth of a byte or so for a bit of its vector, and exact distances are computed for ``rerank`` rows.

**Threshold search.**  The centroids are pivots.  A row has its distance to its own pivot, and a cell the least and largest of them.  By
the triangle inequality a query skips every cell that its ball can't reach, and within a cell, whose rows are sorted by that distance,
all but one run of rows.  The result is exact.  How much is skipped depends on the data: much on clustered vectors, nothing on
vectors spread evenly over a sphere of many dimensions, where all distances are alike.

Distances are squared Euclidean, in doubles; equal ones rank by id.  Rows without vector or id are not indexed and queries
without vector find nothing.  All vectors have one length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params
from quarry.operators.knn import _matrix, _query_blocks

SAMPLE_ROWS = 16_384        # bound of the training sample
ROUNDS = 12
CODE_BYTES = 16
BOUNDARY = 0.05             # second cells up to this much farther (squared) than the first
_SLACK = 1e-9


# --- training -----------------------------------------------------------------------------------------------------------------
def _square(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T), 0.0)


def _k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from rows far from each other's centres (k-means++); fewer than k distinct rows are all centres."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    centres, far = x[rng.integers(len(x))][None, :], None
    while len(centres) < k:
        d = _square(x, centres[-1:])[:, 0]
        far = d if far is None else np.minimum(far, d)
        centres = np.concatenate([centres, x[rng.choice(len(x), p=far / far.sum())][None, :]])
    for _ in range(ROUNDS):
        own = _square(x, centres).argmin(1)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class Quantiser:
    centroids: np.ndarray
    books: tuple[np.ndarray, ...]

    def nearest(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The n nearest cells of each row and the squared distances to their centroids; ties to the smaller number."""
        d = _square(x, self.centroids)
        order = np.argsort(np.round(d, 9), axis=1, kind="stable")[:, :n]
        return order, np.take_along_axis(d, order, 1)

    def groups(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, np.cumsum([b.shape[1] for b in self.books])[:-1], axis=1)

    def encode(self, rest: np.ndarray) -> np.ndarray:
        return np.stack([_square(part, book).argmin(1).astype(np.uint8) for part, book in zip(self.groups(rest), self.books)], axis=1)

    def tables(self, rest: np.ndarray) -> np.ndarray:
        """Squared distances of a query's groups to all code words: (groups, 256), padded."""
        out = np.zeros((len(self.books), 256))
        for j, (part, book) in enumerate(zip(self.groups(rest[None, :]), self.books)):
            out[j, :len(book)] = _square(part, book)[0]
        return out


def sample(df: DataFrame, vec_col: str, rows: int) -> np.ndarray:
    """Distinct vectors with the smallest hashes, at most ``rows``: thinned in the tasks, so the driver gets no more."""
    vectors = df.filter(F.col(vec_col).isNotNull()).select(F.col(vec_col).cast("array<double>").alias("v")).withColumn("h", F.xxhash64("v"))
    n = vectors.agg(F.approx_count_distinct("h")).first()[0] or 0
    share = min(1.0, 2.0 * rows / max(1, n))
    kept = vectors.filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("h").agg(F.first("v").alias("v"))
    return np.array([r["v"] for r in kept.orderBy("h").limit(rows).collect()], dtype=np.float64)


def train(df: DataFrame, cells: int, vec_col: str = "embedding", sample_rows: int = SAMPLE_ROWS, code_bytes: int = CODE_BYTES,
          seed: int = 7) -> Quantiser:
    """A quantiser fitted to at most ``sample_rows`` distinct vectors of the table; without any, one that fits no vector."""
    x = sample(df, vec_col, sample_rows)
    if not len(x):
        return Quantiser(np.zeros((1, 1)), ())
    model = Quantiser(_k_means(x, cells, seed), ())
    rest = x - model.centroids[model.nearest(x, 1)[0][:, 0]]
    parts = np.array_split(rest, min(code_bytes, x.shape[1]), axis=1) if code_bytes else []
    return Quantiser(model.centroids, tuple(_k_means(p, 256, seed + 1 + j) for j, p in enumerate(parts)))


# --- the written index --------------------------------------------------------------------------------------------------------
def build_index(corpus: DataFrame, model: Quantiser, root: str, id_col: str = "doc_id", vec_col: str = "embedding",
                shard_rows: int = params.KNN_PART_ROWS, boundary: float = BOUNDARY) -> None:
    """Writes ``root``/codes (one folder per cell), /cells (rows and shards of each), /vectors and /model."""
    spark = corpus.sparkSession
    rows = corpus.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def encode(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = _matrix(pdf["vec"])
            cell, d = model.nearest(x, 2)
            out = []
            for j in range(cell.shape[1]):
                some = np.flatnonzero(d[:, j] <= d[:, 0] * (1 + boundary)) if j else np.arange(len(x))
                codes = model.encode(x[some] - model.centroids[cell[some, j]])
                out.append(pd.DataFrame({"id": pdf["id"].iloc[some].to_numpy(), "cell": cell[some, j].astype(np.int32),
                                         "code": [c.tobytes() for c in codes]}))
            yield pd.concat(out, ignore_index=True)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType())])
    coded = rows.mapInPandas(encode, schema)
    coded.write.mode("overwrite").parquet(f"{root}/coded")
    coded = spark.read.parquet(f"{root}/coded")
    cells = coded.groupBy("cell").agg(F.count("*").alias("rows")).withColumn("shards", F.ceil(F.col("rows") / shard_rows).cast("int"))
    cells.coalesce(1).write.mode("overwrite").parquet(f"{root}/cells")
    cells = spark.read.parquet(f"{root}/cells")                 # a row for each centroid
    dealt = coded.join(F.broadcast(cells), "cell").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards").cast("long")).cast("int"))
    (dealt.select("cell", "shard", "id", "code").repartition("cell", "shard").sortWithinPartitions("cell", "shard")
     .write.mode("overwrite").partitionBy("cell").parquet(f"{root}/codes"))
    rows.write.mode("overwrite").parquet(f"{root}/vectors")
    saved = [("centroid", 0, i, c.tolist()) for i, c in enumerate(model.centroids)]
    saved += [("book", j, i, w.tolist()) for j, b in enumerate(model.books) for i, w in enumerate(b)]
    spark.createDataFrame(saved, "kind string, part int, pos int, word array<double>").coalesce(1).write.mode("overwrite").parquet(f"{root}/model")


def load_model(spark: SparkSession, root: str) -> Quantiser:
    by: dict = {}
    for r in spark.read.parquet(f"{root}/model").orderBy("kind", "part", "pos").collect():
        by.setdefault((r["kind"], r["part"]), []).append(r["word"])
    books = [np.array(words) for (kind, _), words in sorted(by.items()) if kind == "book"]
    return Quantiser(np.array(by["centroid", 0]), tuple(books))


def search_index(spark: SparkSession, root: str, queries: DataFrame, k: int, probes: int, rerank: int, qid_col: str = "qid",
                 qvec_col: str = "qvec", exclude_own: bool = False, block_bytes: int = params.KNN_BLOCK_BYTES) -> DataFrame:
    """(qid, doc_id, distance, rk): the k nearest found of every query.  ``exclude_own`` leaves out the row whose id equals the query's."""
    model = load_model(spark, root)
    cells, codes = spark.read.parquet(f"{root}/cells"), spark.read.parquet(f"{root}/codes")
    asked = queries.filter(F.col(qvec_col).isNotNull()).select(F.col(qid_col).alias("qid"), F.col(qvec_col).cast("array<double>").alias("q"))

    def nearest(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(model.nearest(_matrix(vectors), probes)[0].astype(np.int32)))

    nearest.__annotations__ = {"vectors": pd.Series, "return": pd.Series}
    blocks = _query_blocks(asked, "q", block_bytes)
    sent = asked.withColumn("cell", F.explode(F.pandas_udf(nearest, "array<int>")("q"))).join(F.broadcast(cells), "cell")
    sent = sent.select("qid", "q", "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                       F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("block"))
    shards = codes.select("cell", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "code")
    total = cells.agg(F.sum("shards")).first()[0] or 1
    key, tasks = ["cell", "shard", "block"], int(min(total * blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total * blocks // 16)))
    schema = T.StructType([T.StructField("qid", asked.schema["qid"].dataType), T.StructField("id", codes.schema["id"].dataType),
                           T.StructField("near", T.DoubleType())])

    def visit(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asks):
            code = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
            ids = rows["id"].to_numpy()
            for qid, q in zip(asks["qid"], _matrix(asks["q"])):
                table = model.tables(q - model.centroids[int(rows["cell"].iloc[0])])
                near = np.zeros(len(code))
                for j in range(code.shape[1]):
                    near += table[j][code[:, j]]
                some = np.argpartition(near, rerank - 1)[:rerank] if len(near) > rerank else np.arange(len(near))
                out.append(pd.DataFrame({"qid": qid, "id": ids[some], "near": near[some]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"qid": [], "id": [], "near": []})

    found = shards.repartition(tasks, *key).groupBy(*key).cogroup(sent.repartition(tasks, *key).groupBy(*key)).applyInPandas(visit, schema)
    if exclude_own:
        found = found.filter(F.col("qid") != F.col("id"))
    found = found.groupBy("qid", "id").agg(F.min("near").alias("near"))         # boundary rows are found in two cells
    best = Window.partitionBy("qid").orderBy("near", "id")
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= rerank).select("qid", "id")
    exact = found.join(spark.read.parquet(f"{root}/vectors"), "id").join(asked, "qid")
    distance = F.aggregate(F.zip_with("q", "vec", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    last = Window.partitionBy("qid").orderBy(F.round("distance", 9), "id")
    ranked = exact.select("qid", "id", distance.alias("distance")).withColumn("rk", F.row_number().over(last))
    return ranked.filter(F.col("rk") <= k).select(F.col("qid").alias(qid_col), F.col("id").alias("doc_id"), "distance", F.col("rk").cast("long").alias("rk"))


# --- threshold search -----------------------------------------------------------------------------------------------------------
def within_pivots(corpus: DataFrame, queries: DataFrame, radius: float, model: Quantiser, *, qid_col: str = "qid", qvec_col: str = "qvec",
                  id_col: str = "doc_id", vec_col: str = "embedding", exclude_own: bool = False, counts: bool = False,
                  part_rows: int = params.KNN_PART_ROWS, block_bytes: int = params.KNN_BLOCK_BYTES) -> DataFrame:
    """(qid, doc_id, distance) of all rows within a squared distance of ``radius`` of each query.

    With ``counts``, (qid, n_compared) instead: how many rows each query was compared with, in parts.
    """
    spark, reach = corpus.sparkSession, math.sqrt(max(0.0, radius)) + _SLACK

    def own_cell(vectors: pd.Series) -> pd.DataFrame:
        cell, d = model.nearest(_matrix(vectors), 1)
        return pd.DataFrame({"cell": cell[:, 0].astype(np.int32), "away": np.sqrt(d[:, 0])})

    own_cell.__annotations__ = {"vectors": pd.Series, "return": pd.DataFrame}
    rows = corpus.filter(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("at", F.pandas_udf(own_cell, "cell int, away double")("vec")).select("id", "vec", "at.cell", "at.away")
    stats = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("away").alias("least"), F.max("away").alias("most")).collect()
    schema = T.StructType([T.StructField(qid_col, queries.schema[qid_col].dataType), *(
        [T.StructField("n_compared", T.LongType())] if counts else
        [T.StructField(id_col, corpus.schema[id_col].dataType), T.StructField("distance", T.DoubleType())])])
    if not stats or radius < 0:
        return spark.createDataFrame([], schema)
    number = np.array([s["cell"] for s in stats])
    least, most = (np.array([s[c] for s in stats]) for c in ("least", "most"))
    shards = {s["cell"]: -(-s["n"] // part_rows) for s in stats}            # a number for each centroid

    def reached(vectors: pd.Series) -> pd.Series:
        d = np.sqrt(_square(_matrix(vectors), model.centroids))
        to = d[:, number]
        near = (to - reach <= most + _SLACK) & (to + reach >= least - _SLACK) & (to - d.min(1, keepdims=True) <= 2 * reach + _SLACK)
        return pd.Series([number[n].astype(np.int32) for n in near])

    reached.__annotations__ = {"vectors": pd.Series, "return": pd.Series}
    cut = spark.createDataFrame([(int(c), int(n)) for c, n in shards.items()], "cell int, shards int")
    asked = queries.filter(F.col(qvec_col).isNotNull()).select(F.col(qid_col).alias("qid"), F.col(qvec_col).cast("array<double>").alias("q"))
    blocks = _query_blocks(asked, "q", block_bytes)
    sent = asked.withColumn("cell", F.explode(F.pandas_udf(reached, "array<int>")("q"))).join(F.broadcast(cut), "cell")
    sent = sent.select("qid", "q", "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                       F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("block"))
    dealt = rows.join(F.broadcast(cut), "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("shards").cast("long")).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "vec", "away")
    key, total = ["cell", "shard", "block"], sum(shards.values()) * blocks
    tasks = int(min(total, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 16)))
    columns = schema.fieldNames()

    def visit(part: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(part) and len(asks):
            part = part.sort_values("away", kind="stable")
            x, away, ids = _matrix(part["vec"]), part["away"].to_numpy(), part["id"].to_numpy()
            centre = model.centroids[int(part["cell"].iloc[0])]
            for qid, q in zip(asks["qid"], _matrix(asks["q"])):
                to = math.sqrt(float(((q - centre) ** 2).sum()))
                low, high = np.searchsorted(away, to - reach - _SLACK, "left"), np.searchsorted(away, to + reach + _SLACK, "right")
                if counts:
                    out.append(pd.DataFrame({columns[0]: [qid], columns[1]: [high - low]}))
                    continue
                d = ((x[low:high] - q) ** 2).sum(1)
                hit = np.flatnonzero(np.round(d, 9) <= radius)
                out.append(pd.DataFrame({columns[0]: qid, columns[1]: ids[low:high][hit], columns[2]: d[hit]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: [] for c in columns})

    found = dealt.repartition(tasks, *key).groupBy(*key).cogroup(sent.repartition(tasks, *key).groupBy(*key)).applyInPandas(visit, schema)
    return found.filter(F.col(qid_col) != F.col(id_col)) if exclude_own and not counts else found
