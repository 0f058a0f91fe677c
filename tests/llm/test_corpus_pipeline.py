"""The pipeline on a small table with planted cases, stage by stage, and the entry with and without the subpackage."""

import os
import random
import shutil
import subprocess
import sys
import tempfile

import pytest

import corpus_pipeline as pipeline
from quarry.llm import ngramjoin

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
EN = "the of and to in that was for on with as his they at be this from have or by one had not but what all were when".split()
DE = "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie".split()


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(11)

    def prose(words, n):
        return " ".join(rnd.choice(words) + rnd.choice(("", "", "a", "ing", "er")) for _ in range(n))

    rows = []
    for i in range(120):
        words, lang = (EN, "en") if i % 3 else (DE, "de")
        lines = [prose(words, 40) for _ in range(3)]
        if i % 4 == 0:
            lines.insert(1, "All rights reserved by this site")
        rows.append((i, "\n".join(lines), lang, f"s{i % 2}", 0))
    rows += [(200, rows[1][1], "en", "s0", 0), (201, rows[1][1] + " end", "en", "s1", 0), (202, rows[2][1], "en", "s0", 0)]
    rows += [(300, "12345 !!", "en", "s0", 0), (301, None, "en", "s0", 0), (302, "", None, None, None), (303, prose(EN, 60), None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, table):
    docs, columns = frame(spark, table), ["doc_id", "text", "lang", "source", "n_chars"]
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "mixing", "bpe"]
    spoken = pipeline.identify_language(spark, docs, "")
    assert spoken.columns == columns and {r.doc_id for r in spoken.collect()} == {r[0] for r in table} - {300, 301, 302}
    spoken = frame(spark, spoken.collect())
    clean = pipeline.drop_lines(spark, spoken, "")
    rows = clean.collect()
    assert clean.columns == columns and len(rows) == spoken.count()
    assert not any("All rights reserved" in r.text for r in rows) and all(r.n_chars == len(r.text) for r in rows)
    one = pipeline.join_near(spark, frame(spark, rows), "")
    kept = one.collect()
    assert one.columns == columns and {r.doc_id for r in kept} == {r.doc_id for r in rows} - {200, 201, 202}
    mixed = pipeline.mix_sources(spark, frame(spark, kept), "")
    parts = mixed.collect()
    texts = {r.doc_id: r.text for r in kept}
    assert mixed.columns == columns and all(r.text in texts[r.doc_id] for r in parts)
    coded = pipeline.encode(spark, frame(spark, parts), "")
    assert coded.count() == len(parts) and coded.filter("size(ids) <> n_tokens").count() == 0


def test_mostly_boilerplate_pages_are_cleaned_and_copies_stay(spark):
    menu, article = "Home | News | Contact | Imprint | All rights reserved", "\n".join(f"line {k} of an article on ten pages" for k in range(6))
    rows = [(i, f"{menu}\nshort {i}", "en", "s", 0) for i in range(30)] + [(i, f"own text {i}", "en", "s", 0) for i in range(30, 60)]
    rows += [(i, article, "en", "s", 0) for i in range(60, 70)] + [(70, f"{menu}\n{menu}", "en", "s", 0)]
    got = {r.doc_id: r.text for r in pipeline.drop_lines(spark, frame(spark, rows), "").collect()}
    assert got == {i: article if 60 <= i < 70 else "" if i == 70 else t.split("\n")[-1] for i, t, *_ in rows}
    kept = pipeline.join_near(spark, frame(spark, [(i, t, "en", "s", 0) for i, t in got.items()]), "").collect()
    assert [r.doc_id for r in kept if r.text == article] == [60]


def test_run_and_empty_table(spark, table):
    d = tempfile.mkdtemp(prefix="quarry-pipeline-")
    frame(spark, table).write.parquet(f"{d}/documents.parquet")
    out = pipeline.run(spark, d)
    assert out.count() > 0 and not {200, 201, 202, 300, 301, 302} & {r.doc_id for r in out.select("doc_id").collect()}
    empty = frame(spark, table).limit(0)
    for _, stage in pipeline.STAGES[:4]:
        assert stage(spark, empty, d).count() == 0


def test_a_document_stays_of_every_class(spark, table):
    rows = [r for r in table if r[1]]
    docs = frame(spark, rows)
    kept = {r.doc_id for r in pipeline.join_near(spark, docs, "").collect()}
    assert kept == {r.class_id for r in ngramjoin.join(docs).collect()}


def test_entry_without_the_subpackage():
    d = tempfile.mkdtemp(prefix="quarry-without-")
    shutil.copy(f"{REPO}/__spark_entry__.py", d)
    shutil.copytree(f"{REPO}/quarry", f"{d}/quarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'knn_exact' in q and not any(n.startswith('op') and n[2].isdigit() for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=d, check=True, env={**os.environ, "PYTHONPATH": d})
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' in q and len([n for n in q if n[:2] == 'op' and n[2].isdigit()]) == 13"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, env={**os.environ, "PYTHONPATH": REPO})
