"""Chinese numerals: every number to 9,999, larger ones and texts that are none."""

from pyspark.sql import functions as F

from quarry.functions.numerals import numbers_before, numeral_text, numeral_value
from quarry.operators import evaluate as E

DIGITS = "零一二三四五六七八九"


def _written(n):
    out, gap = "", False
    for unit, value in (("千", 1000), ("百", 100), ("十", 10), ("", 1)):
        d = n // value % 10
        if d:
            out += ("零" if gap and out else "") + DIGITS[d] + unit
        gap = not d
    return (out[1:] if out.startswith("一十") else out) or "零"


def test_every_number_to_9999(spark):
    rows = [(n, _written(n)) for n in range(10_000)]
    df = spark.createDataFrame(rows, "n long, w string")
    wrong = df.where((numeral_value("w") != F.col("n")) | numeral_value("w").isNull() | ~numeral_text("n").eqNullSafe(F.col("w")))
    assert wrong.count() == 0


def test_other_forms(spark):
    known = {"两千": 2000, "二〇二四": 2024, "一二": 12, "一百五": 150, "一百零五": 105, "三千六": 3600, "一万五": 15000, "十万": 100000,
             "一万零三": 10003, "三万两千零五十": 32050, "一千二百万": 12000000, "千": 1000, "一十": 10, "〇": 0,
             "": None, None: None, "三年": None, "12": None, "abc": None}
    df = spark.createDataFrame([(k, v) for k, v in known.items()], "w string, n long")
    assert df.select("w", numeral_value("w").alias("n")).collect() == df.collect()
    assert numeral_text_of(spark, [-1, 10_000, None]) == [None, None, None]


def numeral_text_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n long").coalesce(1)
    return [r.t for r in df.select(numeral_text("n").alias("t")).collect()]


def test_numbers_of_years_in_the_correctness_rule(spark):
    rows = [("处三年以上十年以下有期徒刑", "处3年以上10年以下有期徒刑", True), ("处三年以上十年以下有期徒刑", "处五年以上七年以下有期徒刑", False),
            ("处三年以上十年以下有期徒刑", "处三年有期徒刑", True), ("处有期徒刑", "处三年有期徒刑", True), (None, "三年", False)]
    df = spark.createDataFrame(rows, "t string, p string, want boolean")
    got = df.select("want", E.correctness("p", "t", F.lit("criminal_law"), numerals=True).alias("got"),
                    E.correctness("p", "t", F.lit("criminal_law")).alias("plain"), numbers_before("t", "年").alias("years")).collect()
    assert [r.got for r in got] == [r.want for r in got] and got[1].plain and got[0].years == ["3", "10"]
