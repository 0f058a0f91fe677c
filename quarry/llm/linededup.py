"""Line dedup by site-relative frequency (operator 7): DataFrame expressions only.

A line's frequency on a site is the share of the site's pages that contain it, however often.  Lines on more than
``max_ratio`` of their site's pages, and on at least ``min_pages`` of them, are boilerplate and dropped from all pages of
that site.  Lines are compared without the spaces around them; blank lines are neither counted nor dropped.

Null sites are one site.  A null text stays null, an empty one empty; a page of nothing but boilerplate becomes empty,
unless it is left whole.  ``leave_copies`` leaves pages whole whose whole text is on at least ``min_pages`` pages of
their site: they are copies, for a document-level dedup to judge, which could keep none of them otherwise.  ``leave_share``
leaves pages whole of which a larger share of the code points is boilerplate, copies or not.  Repeated rows are pages of
their own.  An empty table gives an empty result.  All other columns pass through; n_dropped replaces a clashing column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Stage

MAX_RATIO = 0.05
MIN_PAGES = 2           # on a single page a line is no boilerplate
SALTS = 32


def _salts() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))


def _key(site: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit("null"))


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def frequent_lines(df: DataFrame, site_col: str, text_col: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(__site, __lines): each site's boilerplate as hashes.

    A site has at most (mean distinct lines of its pages) / max_ratio of them, so the arrays are small however many
    pages there are.  Counts are combined before the shuffle; the sites' totals meet them under salted keys.
    """
    pages = df.select(_key(df[site_col]).alias("__site"), df[text_col].alias("__text"))
    total = pages.groupBy("__site").agg(F.count("*").alias("__pages"))
    total = total.withColumn("__salt", _salts())
    lines = F.filter(F.split("__text", "\n"), lambda x: F.trim(x) != "")
    count = (pages.select("__site", F.explode(F.array_distinct(F.transform(lines, _hash))).alias("__line"))
             .groupBy("__site", "__line").agg(F.count("*").alias("__n")).filter(F.col("__n") >= min_pages)
             .withColumn("__salt", F.pmod("__line", F.lit(SALTS))))
    often = count.join(total, ["__site", "__salt"]).filter(F.col("__n") > max_ratio * F.col("__pages"))
    return often.groupBy("__site").agg(F.collect_list("__line").alias("__lines"))


def repeated_texts(df: DataFrame, site_col: str, text_col: str, min_pages: int = MIN_PAGES) -> DataFrame:
    """(__site, __th, __copy): hashes of the whole texts that are on at least ``min_pages`` pages of a site."""
    texts = df.filter(df[text_col].isNotNull()).select(_key(df[site_col]).alias("__site"), F.xxhash64(df[text_col]).alias("__th"))
    often = texts.groupBy("__site", "__th").agg(F.count("*").alias("__n")).filter(F.col("__n") >= min_pages)
    return often.select("__site", "__th", F.lit(True).alias("__copy"))


def drop_frequent_lines(df: DataFrame, site_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO,
                        min_pages: int = MIN_PAGES, leave_share: float | None = None, leave_copies: bool = False) -> DataFrame:
    """The table with boilerplate lines taken out of ``text_col``, and n_dropped, the number of lines dropped.

    The sites' lists (and the hashes of repeated texts) are written first; where they are small the pages needn't move,
    otherwise pages and lists meet under salted keys, so a large site is dealt to many tasks.
    """
    stage = Stage(df.sparkSession, "linededup")
    lists = frequent_lines(df, site_col, text_col, max_ratio, min_pages)
    lists = stage.keep(lists.withColumn("__salt", _salts()), "lists")
    out = [c for c in df.columns if c != "n_dropped"]
    pages = df.select(*[df[c] for c in out], _key(df[site_col]).alias("__site"),
                      F.pmod(F.xxhash64(df[text_col]), F.lit(SALTS)).alias("__salt"))
    pages = pages.join(lists, ["__site", "__salt"], "left")
    text = F.col(text_col)
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains("__lines", _hash(x)))
    act = F.col("__lines").isNotNull() & text.isNotNull()
    pages = pages.withColumn("__kept", F.when(act, kept))
    if leave_share is not None:
        size = F.length(F.array_join("__kept", ""))
        pages = pages.withColumn("__kept", F.when(size >= (1.0 - leave_share) * F.length(F.replace(text, F.lit("\n"))), F.col("__kept")))
    if leave_copies:
        copies = stage.keep(repeated_texts(df, site_col, text_col, min_pages), "copies")
        pages = pages.withColumn("__th", F.xxhash64(text)).join(copies, ["__site", "__th"], "left")
        pages = pages.withColumn("__kept", F.when(F.col("__copy").isNull(), F.col("__kept")))
    dropped = F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0))
    return pages.select(*[F.coalesce(F.array_join("__kept", "\n"), text).alias(c) if c == text_col else F.col(c) for c in out],
                        F.when(F.col("__kept").isNull(), 0).otherwise(dropped).cast("long").alias("n_dropped"))
