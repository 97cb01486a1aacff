"""Each stage of the pipeline against a plain statement of it, and the odd rows through all stages."""

from __future__ import annotations

import re

import duckdb
import pytest
from rows import ODD, SCHEMA, docs
from test_lattice import expected as plain_ids
from test_near_duplicates import plain_groups

import corpus_pipeline
from riskloom.llm import lattice, q_decontaminate, q_lattice, q_line_quality
from riskloom.session import work_dir


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [frame]
    for name, stage in corpus_pipeline.STAGES:
        path = work_dir(spark, f"test-{name}")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [(f, {r.doc_id: r for r in f.collect()}) for f in out]


@pytest.fixture(scope="module")
def con(sf_dir, stages):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    for k, (frame, _) in enumerate(stages):
        rows = frame.select("doc_id", "text", "source").toPandas()  # noqa: F841
        connection.execute(f"CREATE TABLE docs{k} AS SELECT * FROM rows")
    return connection


def test_columns(stages):
    documents = stages[0][0].columns
    assert [f.columns for f, _ in stages[1:-1]] == [documents] * 4
    assert stages[-1][0].columns == [*documents, "ids", "n_tokens"]
    assert all(len(r) == f.count() for f, r in stages)
    assert all(r.n_chars == len(r.text) for r in stages[4][1].values())


def test_quality_rules(con, stages):
    steps = q_line_quality.STEPS
    found = con.execute(
        f"WITH docs AS (SELECT * FROM docs0), {steps} SELECT v.doc_id, coalesce(r.clean, d.text) "
        "FROM verdicts v JOIN docs d ON v.doc_id = d.doc_id LEFT JOIN rests r ON r.doc_id = v.doc_id WHERE kept"
    ).fetchall()
    assert {r.doc_id: r.text for r in stages[1][1].values()} == dict(found)
    assert len(found) < len(stages[0][1])


def test_near_duplicates(stages):
    before = stages[1][1]
    ids = list(before)
    wanted = {}
    for d, g in zip(ids, plain_groups([before[d].text for d in ids])):
        wanted[g] = min(d, wanted.get(g, d))
    assert set(stages[2][1]) == set(wanted.values())
    assert all(before[d] == r for d, r in stages[2][1].items())


def test_decontamination(con, stages):
    hit = con.execute(
        f"WITH docs AS (SELECT * FROM docs2), {q_decontaminate.HIT_STEPS} SELECT doc_id FROM hit_words"
    ).fetchall()
    assert set(stages[3][1]) == set(stages[2][1]) - {d for (d,) in hit}
    assert hit


def test_personal_data(stages):
    """Texts agree outside the replaced places, and planted data is gone."""
    plain = re.compile(r"[\w.]+@[\w.]+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b|AKIA\w{16}|(?<=password=)\w+|(?<=token = \")\w+")
    replaced = 0
    for doc_id, row in stages[3][1].items():
        new = stages[4][1][doc_id].text
        assert plain.split(row.text) == plain.split(new)
        old = plain.findall(row.text)
        replaced += len(old)
        assert not set(old) & set(plain.findall(new))
    assert replaced and set(stages[3][1]) == set(stages[4][1])


def test_encoding(stages):
    model = lattice.load_model(q_lattice.MODEL)
    table, memo = {p: (i, s) for p, i, s in model.pieces}, {}
    assert set(stages[4][1]) == set(stages[5][1])
    for row in list(stages[5][1].values())[:60]:
        assert row.ids == plain_ids(row.text, model, table, memo) and row.n_tokens == len(row.ids)
        assert lattice.decode(row.ids, model) == row.text


def test_run_is_the_stages(spark, sf_dir, stages):
    ran = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id: (r.text, r.ids) for r in ran.collect()} == {d: (r.text, r.ids) for d, r in stages[-1][1].items()}


def test_odd_rows(spark, sf_dir):
    words = " ".join(f"word{i}" for i in range(80))
    rows = [*ODD, (None, words), (30, f"{words} x"), (30, f"{words} x"), (31, words.upper())]
    frame = docs(spark, rows, ", h long, root int, kept string, n_words string, unit string, _found int, entities int", (1, 2, "k", "n", "u", 3, 4))
    for name, stage in corpus_pipeline.STAGES:
        path = work_dir(spark, f"odd-{name}")
        stage(spark, frame, sf_dir).write.parquet(path)
        frame = spark.read.parquet(path)
    found = frame.collect()
    assert [(r.doc_id, r.h, r.root, r.kept, r.n_words, r.unit, r._found, r.entities) for r in found] == [
        (30, 1, 2, "k", "n", "u", 3, 4)
    ]
    frame = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        path = work_dir(spark, f"empty-{name}")
        stage(spark, frame, sf_dir).write.parquet(path)
        frame = spark.read.parquet(path)
        assert frame.collect() == []
