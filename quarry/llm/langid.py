"""Language ID by compression (operator 8).

Every language has a raw-content zstandard dictionary of labelled text, lower-cased.  A text is cut into blocks, every
block is compressed with every dictionary, and the language with the smallest total wins.  The blocks keep a long text from
becoming its own dictionary; all of them count, so whole texts decide.  The score is the share by which the smallest
total is below the second smallest; a text whose score is under the margin is rejected, as is one without letters.  The margin is
``min_margin`` less ``slack`` bytes: a compressor gains whole bytes, so the shorter a text the less a narrow win means.

The dictionaries are fitted on a bounded sample of the labelled rows: of each language the ``docs_per_language`` rows
with the smallest hashes of their text, thinned by hash to a share of the distinct texts, up to ``dict_bytes`` bytes; of
a text of more than ``max_doc_chars`` code points as many from its first letter on.  Every language that has a text with a
letter is learned; where there are more than ``GROUP``, a batch of texts passes one group of dictionaries after the other.

Null text, empty text, text without a letter: 'und', score 0, rejected.  One learned language: score 1.  No learned
language: 'und' for all.  Ties go to the language with the most labelled rows, then to the first in
code-point order.  Null languages are not learned from.
Rows are judged one by one, so repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DICT_BYTES = 131_072
DOCS_PER_LANGUAGE = 400
MAX_DOC_CHARS = 8_192
GROUP = 64              # dictionaries whose compressors are held at a time
BLOCK_BYTES = 4_096
ROWS = 500              # a batch of results is passed on with as many rows
LEVEL = 6
MIN_MARGIN, SLACK = 0.005, 0.32     # share of the second smallest total, and bytes
UNKNOWN = "und"


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", where: Column | None = None,
          dict_bytes: int = DICT_BYTES, docs_per_language: int = DOCS_PER_LANGUAGE, max_doc_chars: int = MAX_DOC_CHARS) -> dict[str, bytes]:
    """Language -> dictionary content, from the rows that ``where`` admits; the commonest language first.

    A language's rows are thinned by their text's hash to a few times ``docs_per_language`` before they are shuffled,
    and copies count once, so neither a common language nor a group of copies gathers in a task.  The driver receives
    at most ``dict_bytes`` and one document for each language, and broadcasts a number for each.
    """
    rows = df if where is None else df.filter(where)
    rows = rows.select(rows[lang_col].alias("lang"), rows[text_col].alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    piece = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, max_doc_chars)
    rows = rows.withColumn("text", F.when(F.length("text") <= max_doc_chars, F.col("text")).otherwise(piece)).withColumn("h", F.xxhash64("text"))
    most = (rows.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("h").alias("texts"))
            .orderBy(F.desc("count"), "lang").collect())
    if not most:
        return {}
    share = df.sparkSession.createDataFrame([(lang, min(1.0, 4.0 * docs_per_language / max(1, n))) for lang, _, n in most],
                                            "lang string, share double")
    drawn = (rows.join(F.broadcast(share), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
             .groupBy("lang", "h").agg(F.min("text").alias("text")))
    order = Window.partitionBy("lang").orderBy("h")
    sample = (drawn.withColumn("rank", F.row_number().over(order))
              .withColumn("before", F.sum(F.octet_length("text") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)))
              .filter((F.col("rank") <= docs_per_language) & (F.coalesce("before", F.lit(0)) < dict_bytes))
              .orderBy("lang", "rank").select("lang", "text").collect())
    out = {lang: b"" for lang, *_ in most}
    for lang, text in sample:
        out[lang] += (text.lower() + "\n").encode("utf-8", "surrogatepass")
    return {lang: content[:dict_bytes] for lang, content in out.items() if content}


class Judge:
    """The compressors of all languages."""

    def __init__(self, contents: dict[str, bytes], level: int):
        import zstandard as z

        self.by = []
        params = z.ZstdCompressionParameters.from_level(level, write_content_size=False, write_checksum=False,
                                                        write_dict_id=False)
        for content in contents.values():
            words = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=params)
            self.by.append(z.ZstdCompressor(dict_data=words, compression_params=params).compress)

    def sizes(self, blocks: list[bytes]) -> list[int]:
        """The text's compressed size for each language."""
        return [sum(len(compress(b)) for b in blocks) for compress in self.by]


def blocks_of(text: str | None, block_bytes: int) -> list[bytes]:
    """The lower-cased text in blocks; none if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return []
    data = text.lower().encode("utf-8", "surrogatepass")
    return [data[i:i + block_bytes] for i in range(0, len(data), block_bytes)]


def verdict(names: list[str], sizes: list[int], min_margin: float, slack: float) -> tuple[str, float, bool]:
    """(language, score, accepted) from the compressed sizes of a text with letters."""
    best = min(sizes)
    rest = sorted(sizes)[1:]
    score = 1.0 - best / rest[0] if rest else 1.0
    return names[sizes.index(best)], score, not rest or score >= min_margin - slack / rest[0]


def identify(df: DataFrame, contents: dict[str, bytes], text_col: str = "text", keep=None, min_margin: float = MIN_MARGIN,
             slack: float = SLACK, level: int = LEVEL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds lang_pred, score and accepted to the columns of ``keep`` (all if None), replacing clashing names.

    One narrow pass; every task holds the dictionaries, the compressors of ``GROUP`` of them, and one Arrow batch.
    """
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
            T.StructField("accepted", T.BooleanType())]
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("lang_pred", "score", "accepted")]
    schema = T.StructType([df.schema[c] for c in keep] + made)

    names = list(contents)
    groups = [{n: contents[n] for n in names[i:i + GROUP]} for i in range(0, len(names), GROUP)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(groups[0], level) if len(groups) == 1 else None
        for batch in batches:
            texts, sizes = batch.column(place), [[] for _ in range(batch.num_rows)]
            for group in groups:
                held = judge or Judge(group, level)
                for mine, value in zip(sizes, texts):
                    blocks = blocks_of(value.as_py(), block_bytes)
                    if blocks:
                        mine += held.sizes(blocks)
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                got = [verdict(names, mine, min_margin, slack) if mine else (UNKNOWN, 0.0, False) for mine in sizes[at:at + ROWS]]
                columns = zip(zip(*got), (pa.string(), pa.float64(), pa.bool_()))
                yield pa.RecordBatch.from_arrays([*rows.columns[:len(keep)], *(pa.array(c, t) for c, t in columns)],
                                                 names=[f.name for f in schema])

    # a text that is kept is sent once
    place = keep.index(text_col) if text_col in keep else len(keep)
    sent = [df[c] for c in keep] + ([df[text_col].alias("_judged")] if place == len(keep) else [])
    return df.select(*sent).mapInArrow(run, schema)
