"""BPE encoding and decoding with a contiguous rank array (operator 9).

A word is a list of parts and, beside it, the ranks of the adjacent pairs.  The smallest rank is looked for by a scan,
its boundary is deleted and the two neighbouring ranks are looked up again.  That is quadratic in a word's length but
has no pointers, so it wins on short words; words of more than ``SHORT`` parts take a heap over the same merges,
which gives the same parts.

Nulls and empty texts have no tokens and decode to the empty text.  Rows are independent: repeated rows give repeated
results, empty tables an empty result, and further columns pass through unless they clash with an output column,
in which case the output replaces them.

Ids equal the tokenizers library's; the two regular-expression engines know different Unicode versions, so letters
first assigned in Unicode 17 may be split elsewhere.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate
from sys import getsizeof

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHORT = 128
CACHE_BYTES = 48 << 20      # what a task remembers of words, and of chunks; beyond it the memory starts afresh
REMEMBERED = 64             # longer words and chunks are not remembered
BATCH_TOKENS = 1 << 19      # a batch of results is passed on with as many tokens
_ID, _NONE = (1 << 32) - 1, 1 << 63
_CONTROL = regex.compile(r"[\x1c-\x1f]")      # white space to str.split() alone
_SPACES = regex.compile(r"\s+")

OUTPUTS = {
    "n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "ids_sha256": T.StringType(),
    "decoded": T.StringType(), "decoded_sha256": T.StringType(),
}


def _byte_letters() -> dict[int, str]:
    """Byte -> printable letter, the byte-level alphabet: printable Latin-1 stands for itself, the rest follow at 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Memory(dict):
    """key -> ids; a key that isn't known yet is encoded and, unless it is long, remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.bytes = encode, 0

    def __missing__(self, word):
        out = self.encode(word)
        if len(word) <= REMEMBERED:
            self.bytes += getsizeof(word) + getsizeof(out) + 100       # 100: the table's entry
            if self.bytes > CACHE_BYTES:
                self.clear()
                self.bytes = 0
            self[word] = out
        return out


class Codec:
    """Reads a vocabulary file (BPE with word ends, byte-level alphabet, NFC and lower case) and encodes and decodes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.digits = [str(i) for i in range(len(self.tokens))]
        letters = _byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.last = [vocab[letters[b] + self.end] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.words = _Memory(self.encode_word)
        self.chunks = _Memory(self.encode_chunk)

    # -- one word ---------------------------------------------------------------------------------------------------
    def encode_word(self, word: str) -> bytes:
        """The word's ids, packed: 32 bits each."""
        data = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return array("I", self._scan(parts) if len(parts) <= SHORT else self._heap(parts)).tobytes()

    def _scan(self, parts: list[int]) -> list[int]:
        """``ranks[i]`` belongs to parts i and i + 1: rank << 32 | id of the merged part, ``_NONE`` without a merge."""
        get = self.merges.get
        ranks = [get(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)           # the leftmost of equal ranks
            parts[i] = new = best & _ID
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | new, _NONE)
            if i < len(ranks):
                ranks[i] = get(new << 32 | parts[i + 1], _NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        get, n = self.merges.get, len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(get(a << 32 | b), i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a << 32 | b in self.merges]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue                    # one of the two has been merged meanwhile
            parts[i], alive[j], after[i] = best & _ID, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    a, b = parts[left], parts[after[left]]
                    if a << 32 | b in self.merges:
                        heapq.heappush(heap, (get(a << 32 | b), left, a, b))
        return [p for p, x in zip(parts, alive) if x]

    def encode_chunk(self, chunk: str) -> bytes:
        """What stands between white space: no pre-token reaches over it.  A chunk that is one word is remembered once."""
        found = self.find(chunk)
        return self.encode_word(chunk) if found == [chunk] else b"".join([self.words[w] for w in found])

    # -- whole texts ------------------------------------------------------------------------------------------------
    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:            # lower case by code point: no final sigma
                return "".join(map(str.lower, text))
        return text.lower()

    def encode(self, text: str | None) -> list[int]:
        return array("I", self.encode_packed(text)).tolist()

    def encode_packed(self, text: str | None) -> bytes:
        """The text's ids, packed: 32 bits each."""
        out = []
        for part in self.cut(text or ""):
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
            elif part:
                part = self._normal(part)
                chunks = _SPACES.split(part) if _CONTROL.search(part) else part.split()
                out.extend(map(self.chunks.__getitem__, chunks))
        return b"".join(out)

    def decode(self, ids) -> str:
        """The file names no decoder: tokens joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode_decode(df: DataFrame, vocabulary: str, text_col: str = "text", outputs=("n_tokens", "ids", "decoded"),
                  keep=None) -> DataFrame:
    """Encode ``text_col`` of every row and decode the ids again.

    ``vocabulary`` is a path that exists on every executor.  ``keep`` lists the columns to pass through (all but the
    text if None); ``outputs`` picks from ``OUTPUTS``.  One narrow pass without a shuffle; memory: one Arrow batch of texts,
    packed ids of ``BATCH_TOKENS`` tokens and one text, and the caches.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in outputs and c != text_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, OUTPUTS[c]) for c in outputs])

    types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded": pa.string(),
             "decoded_sha256": pa.string()}

    def column(name: str, packed: list[bytes], made: dict) -> pa.Array:
        if name == "n_tokens":
            return pa.array([len(p) // 4 for p in packed], types[name])
        if name != "ids":
            return pa.array(made[name], types[name])
        ends = array("i", accumulate((len(p) // 4 for p in packed), initial=0))
        flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(packed))])
        return pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(ends), [None, pa.py_buffer(ends)]), flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        texts = [c for c in outputs if c not in ("n_tokens", "ids")]
        for batch in batches:
            start, tokens, packed, made = 0, 0, [], {c: [] for c in texts}
            for i, value in enumerate(batch.column(len(keep))):
                one = codec.encode_packed(value.as_py())
                tokens += len(one) // 4
                packed.append(one)
                ids = array("I", one) if texts else None
                for c, values in made.items():
                    if c == "ids_sha256":
                        values.append(_sha(" ".join(map(codec.digits.__getitem__, ids))))
                    elif c == "decoded":
                        values.append(codec.decode(ids))
                    else:
                        values.append(_sha(codec.decode(ids)))
                if tokens >= BATCH_TOKENS or i + 1 == batch.num_rows:
                    rows = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns[:len(keep)], *(column(c, packed, made) for c in outputs)], names=[*keep, *outputs])
                    start, tokens, packed, made = i + 1, 0, [], {c: [] for c in texts}

    return df.select(*[df[c] for c in keep], df[text_col]).mapInArrow(run, schema)
