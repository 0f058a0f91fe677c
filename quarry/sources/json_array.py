"""Large JSON arrays read by many tasks.

A file is read as text cut at every ``}``, which Spark splits into byte ranges like any text.  What a ``}`` means depends on
all that stands before it, so a first pass sums up each range for both cases, that it begins inside a string or outside: whether that
changes, and how the depth of brackets moves and how low it gets.  Running sums over a file's ranges then give every range its true
beginning, and a second pass cuts it into the objects directly inside the array.  An object that reaches over ranges leaves
pieces, which are put together by the range where it began.

A byte-order mark, white space and elements that are no objects are passed over.  A file that ends inside an object loses that object
alone.  An empty file or array has no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_QUOTE, _ESCAPE = ord('"'), ord("\\")
_OPEN, _CLOSE = (ord("["), ord("{")), (ord("]"), ord("}"))
_LATE = (1 << 62)


def _quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes."""
    quote = data == _QUOTE
    escape = np.flatnonzero(data == _ESCAPE)
    if len(escape):
        first = np.concatenate(([True], np.diff(escape) != 1))
        start = np.maximum.accumulate(np.where(first, np.arange(len(escape)), 0))
        odd = escape[(np.arange(len(escape)) - start) % 2 == 0] + 1       # the byte after an odd run, or inside one
        odd = odd[odd < len(data)]
        quote[odd] = False
    return quote


def _steps(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For bytes that begin outside a string: which are inside one, and +1 or -1 for brackets wherever they stand."""
    quote = _quotes(data)
    inside = (np.cumsum(quote) - quote) % 2 == 1
    step = np.isin(data, _OPEN).astype(np.int8) - np.isin(data, _CLOSE).astype(np.int8)
    return inside, step


def _ranges(batches: Iterator[pa.RecordBatch], wanted: tuple[str, ...]) -> Iterator[tuple[tuple, bytes, bool]]:
    """(range, bytes, last) of consecutive rows of one range; the last fragment of a range comes with ``last``, and alone."""
    held, key = [], None

    def closed():
        return b"".join(v.encode("utf-8", "surrogatepass") + b"}" for v in held[:-1])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in wanted)))
        for at, value in zip(keys, batch.column("value").to_pylist()):
            if at != key:
                if len(held) > 1:
                    yield key, closed(), False
                if held:
                    yield key, held[-1].encode("utf-8", "surrogatepass"), True
                key, held = at, []
            elif len(held) > 2000:
                yield key, closed(), False
                held = held[-1:]
            held.append(value)
        if len(held) > 1:
            yield key, closed(), False
            held = held[-1:]
    if held:
        yield key, held[-1].encode("utf-8", "surrogatepass"), True


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, at = [], None
    for key, data, last in _ranges(batches, ("file", "start")):
        if at != key:
            at, turns, bytes_, depth, least = key, 0, 0, [0, 0], [0, 0]
        # the file's very last fragment has no bracket behind it; if this is it, the depth after it doesn't matter any more
        data = np.frombuffer(data + b"}" if last else data, np.uint8)
        inside, step = _steps(data)
        for case in (0, 1):
            moves = np.where(inside == bool((turns + case) % 2), step, 0).cumsum(dtype=np.int64) + depth[case]
            if len(moves):
                depth[case], least[case] = int(moves[-1]), min(least[case], int(moves.min()))
        turns, bytes_ = (turns + int(_quotes(data).sum())) % 2, bytes_ + len(data)
        if last:
            rows.append((*key, turns, bytes_, depth[0], least[0], depth[1], least[1]))
    columns = list(zip(*rows)) or [()] * 8
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 7))],
                                     names=["file", "start", "turns", "bytes", "d0", "l0", "d1", "l1"])


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole objects (part 0) and pieces of those that reach over ranges: (file, start, seq, part, text)."""
    rows: list = []

    def out():
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 3, pa.binary()))],
                                          names=["file", "start", "seq", "part", "text"])

    at = None
    for key, data, last in _ranges(batches, ("file", "start", "inside", "depth", "began", "whole")):
        file, start, inside_at, depth, began, whole = key
        if at != key:
            at, inside, level, open_, seq = key, inside_at, depth, [] if depth >= 2 else None, 0
            home = began if depth >= 2 else start
        data += b"}" if last and whole else b""
        flat = np.frombuffer(data, np.uint8)
        within, step = _steps(flat)
        moves = np.where(within == bool(inside), step, 0)
        after = moves.cumsum(dtype=np.int64) + level
        begins = np.flatnonzero((moves == 1) & (after == 2) & (flat == _OPEN[1]))
        ends = np.flatnonzero((moves == -1) & (after == 1) & (flat == _CLOSE[1]))
        marks = sorted([(int(i), True) for i in begins] + [(int(i), False) for i in ends])
        low = 0
        for place, begin in marks:
            if begin:
                open_, low, home = [], place, start
            elif open_ is not None:
                text = b"".join([*open_, data[low:place + 1]])
                rows.append((file, start, seq, 0, text) if home == start else (file, home, _LATE, start, text))
                seq, open_ = seq + 1, None
        if open_ is not None:
            open_.append(data[low:])
        inside = (inside + int(_quotes(flat).sum())) % 2
        level = int(after[-1]) if len(after) else level
        if last and open_ is not None:
            rows.append((file, home, _LATE, start, b"".join(open_)))
        if len(rows) > 5000:
            yield out()
            rows = []
    yield out()


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, seq, text): the text of every object directly inside the arrays of some files, in order of file, start and seq."""
    text = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))
    sums = text.select("value", "file", "start").mapInArrow(
        _summaries, "file string, start long, turns long, bytes long, d0 long, l0 long, d1 long, l1 long")
    sums = sums.join(text.groupBy("file").agg(F.max("size").alias("size")), "file")
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    state = sums.withColumn("inside", F.coalesce(F.sum("turns").over(before), zero) % 2)
    delta, least = F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")), F.when(F.col("inside") == 0, F.col("l0")).otherwise(F.col("l1"))
    state = state.withColumn("delta", delta).withColumn("least", least).withColumn("depth", F.coalesce(F.sum("delta").over(before), zero))
    opens = (F.col("depth") + F.col("delta") >= 2) & ((F.col("depth") < 2) | (F.col("depth") + F.col("least") < 2))
    state = state.withColumn("began", F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before))
    # all fragments counted with a bracket make one byte more than the file if its last one has none
    state = state.withColumn("whole", (F.col("start") != F.max("start").over(Window.partitionBy("file")))
                             | (F.sum("bytes").over(Window.partitionBy("file")) == F.col("size")))
    state = state.select("file", "start", "inside", "depth", F.coalesce("began", F.col("start")).alias("began"), "whole")
    # a row for each range, against the rows of that range: the ranges are never shuffled, as their fragments have to stay in order
    found = text.select("value", "file", "start").join(F.broadcast(state), ["file", "start"]).select(
        "value", "file", "start", "inside", "depth", "began", "whole").mapInArrow(_objects, "file string, start long, seq long, part long, text binary")
    one = found.filter(F.col("seq") < _LATE).select("file", "start", "seq", F.col("text").cast("string").alias("text"))
    pieces = found.filter(F.col("seq") == _LATE).groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"))
    bytes_ = F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["text"]))
    return one.unionByName(pieces.select("file", "start", F.lit(_LATE).alias("seq"), bytes_.cast("string").alias("text")))
