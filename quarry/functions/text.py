"""Column -> Column text helpers (JVM-side built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.split()/\s sees it (Java's (?U)\s omits U+001C..U+001F).
WS_CLASS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Control characters removed by the cleaner.
CONTROL_CLASS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
# Fixed value: article anchor (Chinese or Arabic numerals, optional 之N suffix).
ARTICLE_NUMERALS = "一二三四五六七八九十百千零"
ARTICLE_REF = rf"第[{ARTICLE_NUMERALS}\d]+条"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Null -> ''; whitespace runs -> one space; control chars removed; '．' -> '.'; trim."""
    x = F.coalesce(col_(c), F.lit(""))
    x = F.regexp_replace(x, WS_CLASS + "+", " ")
    # control characters are rare: test once, replace only when present
    x = F.when(x.rlike(CONTROL_CLASS), F.regexp_replace(x, CONTROL_CLASS, "")).otherwise(x)
    x = F.replace(x, F.lit("．"), F.lit("."))
    return F.trim(x)           # only spaces can remain at the ends after folding whitespace


def clean_head(c, n: int) -> Column:
    """The first n characters of ``clean_text``.  Cleaning works from left to right, so the cleaned start of a text is the start of the
    cleaned text; only where n characters don't remain of it is the whole text cleaned."""
    x, start = col_(c), 2 * n
    folded = F.regexp_replace(F.coalesce(F.substring(x, 1, start), F.lit("")), WS_CLASS + "+", " ")
    head = _once(folded, lambda t: F.trim(F.replace(F.when(t.rlike(CONTROL_CLASS), F.regexp_replace(t, CONTROL_CLASS, "")).otherwise(t),
                                                    F.lit("．"), F.lit("."))))
    return _once(head, lambda t: F.substring(F.when((F.length(x) > start) & (F.length(t) < n), clean_text(x)).otherwise(t), 1, n))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def stable_id(content, source) -> Column:
    """First 12 hex chars of md5(source + ':' + first 100 chars of content)."""
    return F.substring(F.md5(F.concat(col_(source), F.lit(":"), F.substring(col_(content), 1, 100))), 1, 12)


def ws_words(c) -> Column:
    """Python ``str.split()``: whitespace-separated words, no empty strings."""
    return F.filter(F.split(col_(c), WS_CLASS + "+"), lambda w: F.length(w) > 0)


def cut(c, n: int, suffix: str = "...") -> Column:
    """First n characters, plus ``suffix`` when the text was longer."""
    x = col_(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit(suffix))).otherwise(x)


def lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")
