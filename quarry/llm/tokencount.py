"""Token counts of whole texts by overlap resynchronisation (operator 6).

Texts of up to ``chunk_chars`` code points are encoded whole.  A longer one is encoded in overlapping chunks with
offsets: a chunk from a proven boundary to behind the next cut, and a short piece that begins before the cut.  Where
both have the same two tokens beside the same offset, the two can be spliced; if they have no such offset, or the
splice can't be proven, the chunk and its overlap are widened, in the end to the whole text.

The proof: merges of BPE are local, so a sequence of tokens is the encoding of its text exactly if every two
neighbours are the encoding of their joint text.  Inside a chunk they are so already; at every splice the last token
before it and the first one behind it, as finally encoded, are encoded together.  A splice that fails is taken back.

Null and empty texts have no tokens.  Every row is counted by itself, so ties and repeated rows don't matter, and an
empty table gives an empty result.  Output: the columns of ``keep``, n_bytes, n_tokens (replacing clashing names).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
_MARK = "\n"        # a byte token that merges with nothing; it keeps the model's own leading space off what follows


class Pieces:
    """A sentencepiece model; tokens are (begin, end, id), in code points."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.lead = self.model.encode(_MARK)

    def count(self, text: str) -> int:
        return len(self.model.encode(text))

    def tokens(self, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
        """Tokens of text[start:end], as they are behind a boundary at ``start``."""
        skip = len(self.lead) if start else 0
        got = self.model.EncodeAsOffsetMapping(_MARK + text[start:end] if start else text[:end])
        shift = start - len(_MARK) if start else 0
        return [(b + shift, e + shift, i) for (b, e), i in zip(got["offsets"][skip:], got["ids"][skip:])]

    def apart(self, left: str, right: str, a: int, b: int) -> bool:
        """Whether the tokens a, b are the encoding of their joint text."""
        return self.model.encode(_MARK + left + right) == [*self.lead, a, b]


def _boundaries(tokens) -> dict[int, tuple[int, int]]:
    """offset -> (tokens before it, ids beside it), between tokens that both take room."""
    return {x[1]: (k + 1, (x[2], y[2])) for k, (x, y) in enumerate(zip(tokens, tokens[1:])) if x[0] < x[1] == y[0] < y[1]}


def count_long(text: str, model: Pieces, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Number of tokens of the whole text."""
    done: list[tuple] = []      # states before each splice: (tokens so far, start, token before it, chunk, overlap)
    total, start, before, size, wide = 0, 0, None, chunk, overlap
    while True:
        end = start + size + wide // 2
        tokens = model.tokens(text, start, end)
        if before is not None:
            b, e, i = tokens[0]
            if e <= b or not model.apart(text[before[0]:before[1]], text[b:e], before[2], i):
                total, start, before, size, wide = done.pop()       # the splice doesn't hold: cut later
                size, wide = 2 * size, 4 * wide
                continue
        if end >= len(text):
            return total + len(tokens)
        near = start + size
        lo = max(start + 1, near - wide)
        one = _boundaries(tokens)
        two = _boundaries(model.tokens(text, lo, min(len(text), near + wide)))
        for at in sorted(one.keys() & two.keys(), key=lambda p: (abs(p - near), p)):
            n, (a, b) = one[at]
            if (a, b) == two[at][1]:
                done.append((total, start, before, size, wide))
                total, start, before, size, wide = total + n, at, tokens[n - 1], chunk, overlap
                break
        else:
            size, wide = 2 * size, 4 * wide


def count_tokens(df: DataFrame, model_path: str, text_col: str = "text", keep=("doc_id",),
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Exact token counts of every row's whole text; ``model_path`` exists on every executor.

    One narrow pass without a shuffle.  The library works on ``chunk_chars`` at a time, so its memory is bounded.
    """
    keep = [c for c in keep if c not in ("n_bytes", "n_tokens")]
    schema = T.StructType([df.schema[c] for c in keep]
                          + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces(model_path)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(len(keep)):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
                n_tokens.append(count_long(text, model, chunk_chars, overlap_chars) if len(text) > chunk_chars
                                else model.count(text) if text else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(n_bytes, pa.int64()),
                                              pa.array(n_tokens, pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    return df.select(*[df[c] for c in keep], df[text_col]).mapInArrow(run, schema)
