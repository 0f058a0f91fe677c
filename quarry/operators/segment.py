"""Corpus-side text projection and segmentation.

Every operator is per-row work on one file / chunk (split, extract, fold,
posexplode, rows from Arrow batches): no grouping, no shuffle, so segmentation scales with the number of
input rows and never gathers a file's articles into one task beyond its own row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params
from quarry.functions.keywords import any_of, contained
from quarry.functions.text import ARTICLE_NUMERALS, WS_CLASS, clean_text, col_, stable_id

# Anchors, headings, table-of-contents markers and labels of the statute format.
CHINESE_DIGITS = "一二三四五六七八九十"
ANCHOR = rf"第[{ARTICLE_NUMERALS}\d]+条(?:之[{CHINESE_DIGITS}]*)?"
HEADING = rf"第[{CHINESE_DIGITS}]+(?:编|章|节)[^\n]*"
TOC_MARKERS = ["目录", "第一编", "第二编"]
PREAMBLE_ARTICLE = "前言"
PREAMBLE_SOURCE_SUFFIX = "前言"
MADE = ["pos", "article", "chapter", "raw"]      # what is made of a text
BATCH_CHARS, ROW_CHARS = 1 << 20, 200       # a batch of parts is passed on with as many characters; what a row weighs beside its text


def strip_ws(c) -> F.Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(col_(c), rf"^{WS_CLASS}+|{WS_CLASS}+$", "")


def normalise_layout(c) -> F.Column:
    """S1 pre-processing: full-width space U+3000 and tab become a space."""
    return F.regexp_replace(col_(c), "[　\t]", " ")


def _cutter(keep: list[str], anchor: str) -> Callable:
    """The pass of ``_parts`` over Arrow batches of the columns ``keep`` and the text."""
    numerals = ANCHOR.replace(r"\d", "0-9")
    find = re.compile(rf"(?m)^ *({numerals})\s*" if anchor == "line" else rf"({numerals})\s*")
    headings = re.compile(rf"(?m)^ *({HEADING})")

    def cut(text: str) -> Iterator[tuple]:
        pos, at, article, chapter, heading = 0, 0, PREAMBLE_ARTICLE, "", ""
        for m in chain(find.finditer(text), [None]):
            raw = text[at:m.start()] if m else text[at:]
            yield pos, article, chapter, raw
            pos += 1
            if m:
                if "第" in raw:
                    heading = (headings.findall(raw) or [heading])[-1]
                at, article, chapter = m.end(), m.group(1), heading

    def batch_of(batch: pa.RecordBatch, of: list, rows: list) -> pa.RecordBatch:
        columns = [c.take(pa.array(of, pa.int32())) for c in batch.columns[:len(keep)]]
        parts = [pa.array(values, pa.string() if k else pa.int32()) for k, values in enumerate(zip(*rows))]
        return pa.RecordBatch.from_arrays([*columns, *parts], names=[*keep, *MADE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows, chars = [], [], 0
            for i, value in enumerate(batch.column(len(keep))):
                text = value.as_py()
                if text is None:
                    continue
                found = list(cut(text))
                of += [i] * len(found)
                rows += found
                chars += len(text) + ROW_CHARS * len(found)
                if chars >= BATCH_CHARS:
                    yield batch_of(batch, of, rows)
                    of, rows, chars = [], [], 0
            if rows:
                yield batch_of(batch, of, rows)

    return run


def _parts(df: DataFrame, text_col: str, anchor: str) -> DataFrame:
    """The columns before the last, ``text_col``, with pos, article, chapter and raw: a row for each text between anchors, with
    its anchor and the heading before it; none for a null text.

    One scan over the text emits anchors, and one over each part the headings in it; the latest heading is carried along, so the
    time grows with the text and not with articles times headings.  A task holds one Arrow batch of texts, and of results about
    ``BATCH_CHARS`` characters and the rows of one text."""
    keep = [c for c in df.columns if c != text_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("pos", T.IntegerType())] + [
        T.StructField(c, T.StringType()) for c in MADE[1:]])
    return df.select(*keep, text_col).mapInArrow(_cutter(keep, anchor), schema)


def segment_articles(files: DataFrame, text_col: str = "text", domain_name_col: str = "domain_name",
                     min_body: int = params.MIN_ARTICLE_CHARS, min_preamble: int = params.MIN_PREAMBLE_CHARS,
                     anchor: str = "line") -> DataFrame:
    """T3-T7 (+T2): one row per article of each statute text.

    Anchors ``第…条(之…)`` are recognised at line start (indentation allowed), or with ``anchor='anywhere'`` also inside a line, where
    they may refer to another article; chapter / part / section headings are lines of their own, removed from bodies and carried
    forward onto the following articles.  Bodies are cleaned (T1) and kept when longer than ``min_body``;
    the text before the first anchor becomes a preamble chunk (article '前言') when longer
    than ``min_preamble`` and not a table of contents.  Output columns: all input columns
    except the text, plus pos (0 = preamble), article, chapter, body, content, chunk_id.
    """
    if anchor not in ("line", "anywhere"):
        raise ValueError(f"anchor is 'line' or 'anywhere', not {anchor!r}")
    keep = [c for c in files.columns if c != text_col]
    df = files.select(*keep, normalise_layout(F.col(text_col)).alias("_t"))
    raw = F.col("raw")
    body = clean_text(F.when(F.instr(raw, "第") > 0, F.regexp_replace(raw, rf"(?m)^ *{HEADING}$", "")).otherwise(raw))
    # cleaned inside a generator so that it is computed once (a filter on a projected column would be pushed below the
    # projection and evaluate the cleaning twice)
    item = F.struct("pos", "article", "chapter", body.alias("body"), "raw")
    ex = _parts(df, "_t", anchor).select(*keep, F.explode(F.array(item)).alias("it")).select(*keep, "it.*")
    is_pre = F.col("pos") == 0
    squeezed = F.regexp_replace(F.col("raw"), WS_CLASS + "+", "")
    toc = F.exists(F.array(*[F.lit(m) for m in TOC_MARKERS]), lambda m: F.instr(squeezed, m) > 0)
    ok = F.when(is_pre, (F.length(strip_ws(F.regexp_replace("raw", rf"(?m)^ *{HEADING}$", ""))) > min_preamble)
                & ~toc).otherwise(F.length("body") > min_body)
    ex = ex.where(ok)
    content = F.when(is_pre, F.col("body")).otherwise(F.concat(
        F.when(F.col("chapter") != "", F.concat(F.lit("【"), F.col("chapter"), F.lit("】"))).otherwise(F.lit("")),
        F.col("article"), F.lit(" "), F.col("body")))
    src = F.when(is_pre, F.concat(F.col(domain_name_col), F.lit(PREAMBLE_SOURCE_SUFFIX))).otherwise(
        F.col(domain_name_col))
    return ex.select(*keep, F.col("pos").cast("bigint").alias("pos"), "article", "chapter", "body",
                     content.alias("content"),
                     stable_id(F.when(is_pre, F.substring("body", 1, 100)).otherwise(F.col("body")), src)
                     .alias("chunk_id"))


def pack_sentences(chunks: DataFrame, content_col: str = "content", article_col: str = "article",
                   id_col: str = "chunk_id", max_len: int = params.CHUNK_SIZE, seps: str = "。；") -> DataFrame:
    """Chunks longer than ``max_len`` are split at the separators by greedy packing.

    Sentences (text + its separator) are appended while the part stays within ``max_len``;
    a sentence that does not fit starts a new part (an oversize sentence stays whole).
    Parts are stripped; when a chunk yields several parts, the article gets '(第n部分)' and
    the id '_i' (i from 0).  Chunks within the limit pass unchanged (part = 0).
    One pass over each text in Arrow batches: linear, where an array fold would copy the parts at every sentence."""
    sentence = re.compile(f"[^{re.escape(seps)}]*[{re.escape(seps)}]|[^{re.escape(seps)}]+")

    def parts_of(text: str) -> list:
        if text is None or len(text) <= max_len:
            return [text]
        done, cur, size = [], [], 0
        for s in sentence.findall(text):
            if size + len(s) > max_len:
                if cur:
                    done.append("".join(cur).strip())
                cur, size = [], 0
            cur.append(s)
            size += len(s)
        last = "".join(cur).strip()
        return done + [last] if last else done

    def pack(texts: pd.Series) -> pd.Series:
        return pd.Series([parts_of(t) for t in texts])

    pack.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    df = chunks.withColumn("_parts", F.pandas_udf(pack, "array<string>")(F.col(content_col)))
    keep = [c for c in chunks.columns]
    ex = df.select(*keep, F.posexplode("_parts").alias("part", "_text"), F.size("_parts").alias("_n"))
    multi = F.col("_n") > 1
    return ex.select(
        *[c for c in keep if c not in (content_col, article_col, id_col)],
        F.col("_text").alias(content_col),
        F.when(multi, F.concat(F.col(article_col), F.lit("(第"), (F.col("part") + 1).cast("string"), F.lit("部分)")))
        .otherwise(F.col(article_col)).alias(article_col),
        F.when(multi, F.concat(F.col(id_col), F.lit("_"), F.col("part").cast("string"))).otherwise(F.col(id_col))
        .alias(id_col),
        F.col("part").cast("bigint").alias("part"))


def overlap_chunks(df: DataFrame, text_col: str = "text", size: int = params.CHUNK_SIZE,
                   overlap: int = params.CHUNK_OVERLAP) -> DataFrame:
    """Fixed-size chunks of ``size`` characters starting every ``size - overlap``
    characters, the last start at or before ``len - overlap`` (one chunk for short texts)."""
    step = size - overlap
    starts = F.sequence(F.lit(1), F.greatest(F.length(text_col) - overlap, F.lit(1)), F.lit(step))
    keep = [c for c in df.columns if c != text_col]
    ex = df.select(*keep, F.col(text_col), F.posexplode(starts).alias("chunk_no", "_start"))
    return ex.select(*keep, F.col("chunk_no").cast("bigint").alias("chunk_no"),
                     F.substring(F.col(text_col), F.col("_start"), size).alias("chunk"))


def tag_keywords(df: DataFrame, tags, text_col: str = "content") -> DataFrame:
    """``tags`` column = labels (declared order) with at least one pattern contained; all patterns in one pass per text."""
    tags, labels, first = list(tags), [], 0
    for label, pats in tags:
        labels.append(F.when(any_of(F.col("_found"), first, len(pats)), F.lit(label)))
        first += len(pats)
    found = df.withColumn("_found", contained(text_col, [p for _, pats in tags for p in pats]))
    return found.withColumn("tags", F.filter(F.array(*labels) if labels else F.array().cast("array<string>"), lambda x: x.isNotNull())).drop("_found")


def corpus_stats(chunks: DataFrame, type_col: str = "type", content_col: str = "content") -> DataFrame:
    """Per type and overall (type null): n, total chars, mean length (0 when empty)."""
    n = F.count(F.lit(1))
    return chunks.rollup(type_col).agg(
        n.cast("bigint").alias("n_docs"),
        F.coalesce(F.sum(F.length(content_col)), F.lit(0)).cast("bigint").alias("total_chars"),
        F.coalesce(F.avg(F.length(content_col)), F.lit(0.0)).alias("avg_chars"),
        F.grouping(type_col).cast("int").alias("is_total"))


def spot_check(chunks: DataFrame, articles, preview: int = 60) -> DataFrame:
    """Named articles with a ``preview``-character excerpt."""
    return chunks.where(F.col("article").isin(list(articles))).select(
        "article", F.concat(F.substring("content", 1, preview), F.lit("...")).alias("preview"))
