"""Chinese numerals as column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import col_

# The numerals' digits, and their units by power of ten.
ZEROS = "零〇"
DIGITS = "一二三四五六七八九"
TWO = "两"
UNITS = (("十", 10), ("百", 100), ("千", 1000), ("万", 10000))
NUMERAL = f"[{ZEROS}{DIGITS}{TWO}{''.join(u for u, _ in UNITS)}]+"


def numeral_value(c) -> F.Column:
    """Value (bigint) of a numeral below 10^8; null if the text is null, empty or holds anything else.

    Without units its digits count by place (二〇二四 is 2024).  A unit without a digit counts once (十五 is 15), and a last digit right
    after a unit of a hundred or more counts tenths of it (一百五 is 150, 一百零五 is 105)."""
    c = col_(c)
    plain = F.translate(c, ZEROS + DIGITS + TWO, "00123456789" + "2")
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("total"), zero.alias("section"), zero.alias("digit"), F.lit(1).cast("bigint").alias("unit"))

    def unit_of(ch):
        out = F.lit(None).cast("bigint")
        for name, value in UNITS:
            out = F.when(ch == name, F.lit(value).cast("bigint")).otherwise(out)
        return out

    def step(s, ch):
        unit, digit = unit_of(ch), ch.try_cast("bigint")
        big = unit == UNITS[-1][1]
        whole = s["section"] + s["digit"]
        return F.struct(
            F.when(big, s["total"] + F.greatest(whole, F.lit(1)) * unit).otherwise(s["total"]).alias("total"),
            F.when(big, zero).when(unit.isNotNull(), s["section"] + F.greatest(s["digit"], F.lit(1)) * unit).otherwise(s["section"]).alias("section"),
            F.when(unit.isNotNull(), zero).otherwise(digit).alias("digit"),
            F.when(unit.isNotNull(), unit).when(digit == 0, F.lit(1).cast("bigint")).otherwise(s["unit"]).alias("unit"))

    def finish(s):
        last = s["digit"] * F.when(s["unit"] >= 100, (s["unit"] / 10).cast("bigint")).otherwise(F.lit(1))
        return s["total"] + s["section"] + last

    by_units = F.aggregate(F.split(plain, ""), start, step, finish)
    return F.when(c.rlike(f"^{NUMERAL}$"), F.coalesce(plain.try_cast("bigint"), by_units))


def numeral_text(n) -> F.Column:
    """The numeral of 0 to 9,999; null elsewhere."""
    n = col_(n).cast("int")
    digit = lambda p: F.substring(F.lit(ZEROS[0] + DIGITS), (F.floor(n / 10 ** p) % 10 + 1).cast("int"), 1)
    text = F.concat(digit(3), F.lit("千"), digit(2), F.lit("百"), digit(1), F.lit("十"), digit(0))
    text = F.regexp_replace(text, "(零[千百十]?)+", "零")
    text = F.regexp_replace(F.regexp_replace(text, "^零|零$", ""), "^一十", "十")
    return F.when(n == 0, F.lit("零")).when(n.between(1, 9999), text)


def numbers_before(c, marker: str) -> F.Column:
    """The numerals standing before a marker, as decimal strings in order."""
    found = F.regexp_extract_all(col_(c), F.lit(f"({NUMERAL}){marker}"), 1)
    return F.filter(F.transform(found, lambda x: numeral_value(x).cast("string")), lambda x: x.isNotNull())
