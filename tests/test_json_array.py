"""JSON arrays read by byte ranges, against the one-task reader and json.loads."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quarry.sources import readers
from quarry.sources.json_array import array_objects

ODD = ['a', '}', '{', '[', ']', '"', '\\', '\\"', '}}', '甲', '🤖', '\n', ' ', '', 'x' * 40, '\\\\', '","', '},{']


def _record(rnd, k):
    return {"fact": "".join(rnd.choices(ODD, k=rnd.randint(0, 30))), "meta": {"accusation": ["".join(rnd.choices(ODD, k=3)) for _ in range(rnd.randint(0, 3))],
            "term_of_imprisonment": {"imprisonment": k, "death_penalty": False, "life_imprisonment": rnd.random() < 0.5}}, "fine": k,
            "more": {"deep": [{"x": [[], {}]}, "]"]}}


@pytest.fixture
def ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield cut
    for n in names:
        spark.conf.unset(n)


@pytest.mark.parametrize("size,ascii_,indent,bom", [(97, True, None, False), (64, False, None, True), (300, False, 1, False), (1 << 20, True, None, True)])
def test_ranges_equal_json(spark, tmp_path, ranges, size, ascii_, indent, bom):
    rnd = random.Random(size)
    records = [_record(rnd, k) for k in range(120)] + [{}, {"fact": "y" * 3000}, {"fact": "z"}]
    path = tmp_path / "a.json"
    path.write_text(("﻿" if bom else "") + " \n" * bom + json.dumps(records, ensure_ascii=ascii_, indent=indent) + "\n" * (size % 2), encoding="utf-8")
    ranges(size)
    found = array_objects(spark, str(path))
    if size < 1000:
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 20
    got = [json.loads(r.text) for r in found.orderBy("file", "start", "seq").collect()]
    assert got == records


def test_reader_equals_the_one_task_reader(spark, tmp_path, ranges):
    rnd = random.Random(3)
    path = tmp_path / "a.json"
    path.write_text(json.dumps([_record(rnd, k) for k in range(80)], ensure_ascii=False), encoding="utf-8")
    want = spark.read.schema(readers.RAW_CASE_SCHEMA).option("multiLine", True).json(str(path)).collect()
    ranges(128)
    got = readers.case_records(spark, str(path)).orderBy("case_index").drop("case_index").collect()
    assert [r.asDict(True) for r in got] == [r.asDict(True) for r in want] and len(got) == 80


def test_odd_arrays(spark, tmp_path, ranges):
    ranges(16)
    texts = ['[]', ' [ ] ', '[1, "a}", null, {"fact": "x"}, [ {"fact": "inner"} ], {"fact": "y"}]', '[{"fact": "x"}, {"fact": "cut", "fine": 2',
             '[{"fact": "x"}, {"fact": "no bracket"}', "[{}]"]
    want = [[], [], [{"fact": "x"}, {"fact": "y"}], [{"fact": "x"}], [{"fact": "x"}, {"fact": "no bracket"}], [{}]]
    for k, (text, objects) in enumerate(zip(texts, want)):
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
        got = []
        for r in array_objects(spark, str(tmp_path / f"{k}.json")).orderBy("start", "seq").collect():
            try:
                got.append(json.loads(r.text))
            except ValueError:
                assert "cut" in r.text
        assert got == objects, text
    kept = readers.case_records(spark, str(tmp_path / "3.json")).where(F.col("fact").isNotNull()).collect()
    assert [r.fact for r in kept] == ["x"]


def test_several_files_and_a_hot_one(spark, tmp_path, ranges):
    ranges(200)
    for name, n in (("a", 3), ("b", 200), ("c", 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"fact": f"{name}{k}" * 5} for k in range(n)]), encoding="utf-8")
    got = readers.case_records(spark, str(tmp_path)).orderBy("case_index").collect()
    assert [r.fact for r in got] == [f"{n}{k}" * 5 for n, c in (("a", 3), ("b", 200), ("c", 1)) for k in range(c)]
    assert [r.case_index for r in got] == list(range(204))
