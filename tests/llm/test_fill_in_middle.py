from __future__ import annotations

import random

import duckdb
import pytest
from rows import ODD, docs

from riskloom.llm import fill_in_middle as fim
from riskloom.llm import q_fill_in_middle

MIXED = "aé漢🙂"


def texts():
    rng = random.Random(1)
    yield ""
    yield "a"
    yield "🙂"
    yield "x" * 5000
    yield "漢" * 5000
    yield "a" * 3000 + "🙂" * 3000 + "é" * 3000
    for size in (2, 63, 400, 9000):
        yield "".join(rng.choice(MIXED) for _ in range(size))
        yield "".join(rng.choice(MIXED) * rng.randrange(1, 300) for _ in range(size // 50 + 1))


@pytest.mark.parametrize("error, block", [(100, 1 << 20), (1, 1 << 20), (0, 1 << 20), (3, 7), (100, 1)])
def test_every_boundary_is_exact(error, block):
    for text in texts():
        data = text.encode()
        index = fim.RankIndex(data, error, block)
        assert index.n == len(text)
        ranks = range(0, len(text) + 1, max(1, len(text) // 400))
        assert [index.offset(k) for k in ranks] == [len(text[:k].encode()) for k in ranks]
        assert len(index.residuals) == 0 or abs(index.residuals.astype(int)).max() <= error + 1


def test_lines_are_few_and_residuals_small():
    assert len(fim.RankIndex(b"x" * 200_000).slopes) == 1
    mixed = "".join(random.Random(2).choice(MIXED) for _ in range(100_000)).encode()
    assert len(fim.RankIndex(mixed).slopes) < 100


def test_examples_are_taken_back():
    forms = set()
    for text in [*texts(), "<P", "<S<S", "a<M", "<P><S>", "x <M> y", "<" * 50, "<P" * 40, "S>" * 40, "<S" * 40]:
        for doc_id in range(40):
            n, form, prefix, middle, output = fim.example(text, doc_id)
            forms.add(form)
            assert n == len(text)
            assert fim.restored(output, form) == text
            if form == "plain":
                assert output == text and prefix is None and middle is None
            else:
                assert not any(m in text for m in fim.MARKS)
                one, two = text[:prefix], text[prefix : prefix + middle]
                rest = text[prefix + middle :]
                assert output == (f"<P>{one}<S>{rest}<M>{two}" if form == "psm" else f"<S>{rest}<P>{one}<M>{two}")
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows_against_sql(spark, tmp_path):
    rows = [*ODD, (20, "has <P> inside"), (21, "é<S"), *[(k, f"text <{'M' * (k % 3)} of number {k} é漢🙂") for k in range(30, 130)]]
    frame = docs(spark, rows, ", output string, N long", ("clash", 7))
    folder = str(tmp_path / "documents.parquet")
    frame.write.parquet(folder)
    found = q_fill_in_middle.op12_fill_in_middle(spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM read_parquet('{folder}/*.parquet')")
    wanted = duck.execute(q_fill_in_middle.ORACLE["op12_fill_in_middle"]).fetchall()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(wanted, key=key)


def test_clashing_columns_and_empty_table(spark):
    frame = docs(spark, [(1, "some text")], ", output string, N long", ("clash", 7))
    out = fim.fill_in_middle(frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *fim.RESULT]
    assert out.first().n == 9
    assert fim.with_restored(fim.fill_in_middle(frame.limit(0))).count() == 0
