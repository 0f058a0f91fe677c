"""Which words of a list a text contains, for all words in one pass over the text.

An Aho-Corasick automaton is built once per task and run over Arrow batches, so the cost grows with the texts' length and not with
the number of words.  A word counts wherever it stands, inside other words too.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import col_


def automaton(words: Iterable[str]) -> ahocorasick.Automaton | None:
    """Finds the (distinct, non-empty) words; None if there are none."""
    found = ahocorasick.Automaton()
    for word in words:
        if word:
            found.add_word(word, word)
    if not len(found):
        return None
    found.make_automaton()
    return found


def words_in(text: str | None, words: ahocorasick.Automaton | None) -> set[str]:
    return {w for _, w in words.iter(text)} if text and words is not None else set()


def contained(text, words: Iterable[str]) -> Column:
    """array<int>: the places in ``words`` of those that the text contains, ascending; the empty word is in every text, none in a null."""
    listed = list(words)
    if not listed:
        return F.array().cast("array<int>")
    places: dict[str, list[int]] = {}
    for i, word in enumerate(listed):
        places.setdefault(word, []).append(i)
    always = places.get("", [])
    cache: list = []

    def find(texts: pd.Series) -> pd.Series:
        if not cache:
            cache.append(automaton(places))
        return pd.Series([[] if t is None else sorted(always + [i for w in words_in(t, cache[0]) for i in places[w]]) for t in texts])

    find.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(find, "array<int>")(col_(text))


def any_of(found: Column, first: int, count: int) -> Column:
    """Whether the places found include one of ``count`` from ``first`` on."""
    return F.exists(found, lambda i: (i >= first) & (i < first + count))
