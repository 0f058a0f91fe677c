"""Secret scans (operator 13): a keyword prefilter, anchored expressions near its hits, checksums inside the secrets.

One Aho-Corasick automaton holds the keywords of all kinds.  A text is scanned once; only at a hit is the kind's expression
tried, anchored there, so it costs nothing where no keyword is.  A kind's matches are leftmost and don't overlap; a match that
fails the kind's test is dropped and still takes its place.  Runs of hexadecimal digits have no keyword: there the prefilter
is one key of 24 "digit" symbols over the text folded to two classes.

Kinds that carry a checksum are only reported if it holds and no further letter or digit follows:

* ``crc``: ``ghp_ gho_ ghu_ ghs_ ghr_ npm_`` and 36 letters and digits, of which the last six are the CRC-32 of the others, base 62
* ``bech32``: ``AGE-SECRET-KEY-1`` and ``nsec1`` and 58 symbols, whose Bech32 checksum includes the part before the last 1

Positions are code points, ends exclusive.  Keywords of ``assign`` are found in either case of ASCII letters; other characters that
fold to ASCII letters are not.  Null and empty texts have no secrets.  Whole texts are scanned, however long.  Rows are
independent: repeated rows get equal results, an empty table an empty result.  Further columns pass through unless they clash
with an output column, which replaces them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "crc", "bech32")
HEX_RUN = 24

# Keywords and expressions of the kinds, and the alphabets of their checksums.
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "crc": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"],
    "bech32": ["age-secret-key-1", "nsec1"],
}
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "crc": re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{36})"),
    "bech32": re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}|nsec1[02-9ac-hj-np-z]{58}"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_holds(body: str) -> bool:
    """Whether the last six of 36 symbols are the CRC-32 of the first thirty, in base 62."""
    value, digits = zlib.crc32(body[:30].encode("ascii")), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits == body[30:]


def bech32_holds(word: str) -> bool:
    """Whether a Bech32 word's checksum holds."""
    prefix, _, data = word.lower().rpartition("1")
    check = 1
    for x in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *map(BECH32.index, data)]:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ x
        for bit, step in enumerate(BECH32_STEPS):
            check ^= step if top >> bit & 1 else 0
    return check == 1


def _ends(m: re.Match) -> bool:
    """No further letter or digit follows."""
    return not re.match("[A-Za-z0-9]", m.string[m.end():m.end() + 1])


TESTS = {
    "assign": lambda m: m.end(2) - m.start(2) >= 6,
    "access": lambda m: m.end() - m.start() >= 20,
    "hex": lambda m: m.end() - m.start() >= HEX_RUN,
    "crc": lambda m: _ends(m) and crc_holds(m.group(1)),
    "bech32": lambda m: _ends(m) and bech32_holds(m.group()),
}


class Scanner:
    """The automaton of all keywords, and the two foldings that keep one symbol per code point."""

    def __init__(self):
        self.words = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.words.add_word(word, (kind, len(word)))
        self.words.make_automaton()
        lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        digits = set(b"0123456789abcdef")
        self.lower, self.classes = lower, bytes(104 if b in digits else 46 for b in range(256))
        self.run = b"h" * HEX_RUN

    def _hits(self, text: str) -> dict[str, list[int]]:
        flat = text.encode("latin-1", "replace")        # what isn't Latin-1 is in no keyword: one "?" each
        hits: dict[str, list[int]] = {kind: [] for kind in KINDS}
        for end, (kind, length) in self.words.iter(flat.translate(self.lower).decode("latin-1")):
            hits[kind].append(end - length + 1)
        classes = flat.translate(self.classes)
        at = classes.find(self.run)
        while at >= 0:
            hits["hex"].append(at)
            gap = classes.find(b".", at)
            at = classes.find(self.run, gap) if gap >= 0 else -1
        return hits

    def __call__(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then kind as listed."""
        found = []
        if not text:
            return found
        for kind, starts in self._hits(text).items():
            free, match, test = 0, PATTERNS[kind].match, TESTS[kind]
            for at in sorted(starts):
                m = match(text, at) if at >= free else None
                if m:
                    free = m.end()
                    if test(m):
                        found.append((kind, at, free))
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one, named by the first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


OUTPUTS = {
    "spans": T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                       T.StructField("end", T.LongType())])),
    "redacted": T.StringType(),
}


def scan(df: DataFrame, text_col: str = "text", outputs=("spans",), keep=None) -> DataFrame:
    """Adds the spans of all secrets in ``text_col``, and the text without them (``redacted``; null stays null) if asked for.

    ``keep`` lists the columns to pass through (all but the text if None).  One narrow pass without a shuffle; memory: one
    Arrow batch and a few copies of its longest text.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in outputs and c != text_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, OUTPUTS[c]) for c in outputs])
    kind = {"spans": pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])), "redacted": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            made: dict[str, list] = {c: [] for c in outputs}
            for value in batch.column(len(keep)):
                text = value.as_py()
                spans = scanner(text)
                for c, values in made.items():
                    values.append([{"kind": k, "start": a, "end": b} for k, a, b in spans] if c == "spans"
                                  else redact(text, spans) if text else text)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *(pa.array(made[c], kind[c]) for c in outputs)],
                                             names=[f.name for f in schema])

    return df.select(*[df[c] for c in keep], df[text_col].alias("_scanned")).mapInArrow(run, schema)
