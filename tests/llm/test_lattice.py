from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from rows import ODD, SCHEMA, docs

from riskloom.llm import lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return lattice.load_model(PATH)


def plain(unit, model, table):
    """Best path by position, in the order of starts."""
    best = [(0.0, None, None)]
    for stop in range(1, len(unit) + 1):
        here = None
        for start in range(max(0, stop - model.longest), stop):
            piece = unit[start:stop]
            if piece in table:
                ids, score = [table[piece][0]], table[piece][1]
            elif stop - start == 1:
                ids, score = [model.byte_ids[b] for b in piece.encode()], model.unknown_score
            else:
                continue
            total = best[start][0] + score
            if here is None or total > here[0]:
                here = (total, start, ids)
        best.append(here)
    out, at = [], len(unit)
    while at:
        out, at = best[at][2] + out, best[at][1]
    return out


def expected(text, model, table, memo):
    out = []
    for unit in lattice.Units(model).of(text):
        if unit not in memo:
            memo[unit] = plain(unit, model, table)
        out += memo[unit]
    return out


def test_units_keep_the_text_and_pieces_inside(model):
    texts = ["  two  blanks\n\n tab\tend \n" + "x" * 700 + "   ", "Plain words, (one) by one.\nNext", " a▁b", "ü漢🙂 x"]
    for text in texts:
        units = lattice.Units(model).of(text)
        assert "".join(units).replace(lattice.BLANK, " ")[1:] == text.replace("▁", " ")
        # Two characters at a border stand side by side in no piece, but for cuts by length.
        borders = {a[-1] + b[0] for a, b in zip(units, units[1:]) if len(a) < lattice.UNIT}
        assert not borders & model.neighbours


@pytest.mark.parametrize("head", [lattice.HEAD, 40])
def test_given_table(spark, sf_dir, model, head, monkeypatch):
    monkeypatch.setattr(lattice, "HEAD", head)
    table = {p: (i, s) for p, i, s in model.pieces}
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 120")
    memo = {}
    wanted = {r.doc_id: expected(r.text, model, table, memo) for r in source.collect()}
    texts = {r.doc_id: r.text for r in source.collect()}
    rows = lattice.encode(source, model, decoded=True).collect()
    assert {r.doc_id: r.ids for r in rows} == wanted
    assert {r.doc_id: r.decoded for r in rows} == texts


def test_odd_rows(spark, model):
    rows = [*ODD, (9, "a▁b  c\n\n"), (7, "another text with the id"), (10, "퟿\U0001f642 \x00\x01 " + "ab" * 2000)]
    source = docs(spark, rows, ", ids string, unit int, n long, _rows int", ("x", 1, 2, 3))
    table, memo = {p: (i, s) for p, i, s in model.pieces}, {}
    encoded = lattice.encode(source, model, decoded=True).collect()
    found = sorted(((r.doc_id, r.ids, r.decoded) for r in encoded), key=str)
    wanted = sorted(
        ((d, expected(t, model, table, memo), (t or "").replace("▁", " ")) for d, t in rows), key=str
    )
    assert found == wanted


def test_many_rows_without_an_id(spark, model, monkeypatch):
    """No row carries what belongs to another one."""
    monkeypatch.setattr(lattice, "HEAD", 0)
    texts = [f"unit{k} zq{k}x and one{k % 7}" for k in range(2000)]
    source = docs(spark, [(None if k % 2 else 5, t) for k, t in enumerate(texts)])
    rows = lattice.encode(source, model, decoded=True).collect()
    assert sorted(r.decoded for r in rows) == sorted(r.text for r in rows) == sorted(texts)


def test_long_units_have_the_best_path_of_the_text(spark, model):
    rng = np.random.default_rng(1)
    signs = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    texts = ["ab" * 2000, "".join(rng.choice(signs, 3000)), "international" * 90, "-" * 1111 + "=" * 999, " " * 700, "x" * 257]
    table = {p: (i, s) for p, i, s in model.pieces}
    rows = lattice.encode(docs(spark, list(enumerate(texts))), model).collect()
    whole = {k: plain(lattice.BLANK + t.replace(" ", lattice.BLANK), model, table) for k, t in enumerate(texts)}
    assert {r.doc_id: r.ids for r in rows} == whole


def test_query_returns_ids_and_texts(spark, sf_dir, model):
    from riskloom.llm import q_lattice

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = q_lattice.op5_sentencepiece(spark, sf_dir).collect()
    assert {r.doc_id: r.decoded for r in rows} == texts
    assert all(lattice.decode(r.ids, model) == r.decoded and r.n_tokens == len(r.ids) for r in rows)


def test_empty_table(spark, model):
    source = spark.createDataFrame([], SCHEMA)
    assert lattice.encode(source, model).collect() == []


def test_library_has_no_better_path(spark, model):
    """The library itself, told that the model is of the unigram kind, on words whose letters are pieces."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    own = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = "the quick brown fox unbelievable Wörterbuch éducation niño internationalization".split()
    rows = lattice.encode(docs(spark, list(enumerate(words))), model).collect()
    score = {i: s for _, i, s in model.pieces}
    equal = 0
    for row in rows:
        theirs = own.encode(row.text)
        assert sum(score[i] for i in row.ids) >= sum(score[i] for i in theirs)
        equal += row.ids == theirs
    assert len(rows) == len(words) and equal >= len(words) - 1


def test_texts_are_shuffled_compressed(spark):
    """Every column passes by the compressed texts, which take less than the texts."""
    text = "Some words of a text in a language. " * 50
    rows = docs(spark, [(1, text), (None, None), (3, ""), (4, "ü漢🙂 \x00")], ", __size0 int", (7,))
    shuffled = lattice.packed(rows)
    assert shuffled.columns == [*rows.columns, "__size"]
    assert all(len(r.text or b"") < 400 for r in shuffled.collect())
    back = shuffled.mapInArrow(lambda batches: map(lattice.unpacked, batches), rows.schema)
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)


def test_counting_holds_no_string_for_each_unit(spark, model):
    """Python objects of a counting task take little, however many units there are."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([" ".join(f"{chr(97 + k % 26)}{np.base_repr(k * 7919, 36)}" for k in range(a, a + 400)) for a in range(0, 40_000, 400)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    units = lattice.unit_counts(spark.createDataFrame([(t,) for t in texts.to_pylist()], "text string"), model)
    counts = {r.unit: r.n for r in units.collect()}
    tracemalloc.start()
    found = list(lattice.counted(iter([batch]), model))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {u: n for b in found for u, n in zip(*(c.to_pylist() for c in b.columns))} == counts
    assert len(counts) > 10_000 and most < 12_000_000


def test_batches_are_bounded_by_bytes(spark, model):
    rows = docs(spark, [(k, f"word{k} " * 300) for k in range(6000)]).coalesce(1)
    made = lattice.encode(rows, model)
    assert made.count() == 6000

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    assert max(r.size for r in rows.mapInArrow(sizes, "size long").collect()) < 5 << 20


def test_solved_units_leave_no_shuffle_files(spark, model):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    shuffles = lambda: {f.getName() for f in iter_scala(files()) if f.getName().startswith("shuffle_")}
    iter_scala = lambda seq: [seq.apply(k) for k in range(seq.size())]
    before = shuffles()
    lattice.solved_units(docs(spark, [(k, f"word{k} and more") for k in range(50)]), model)
    assert shuffles() <= before


def test_one_shuffle_by_row(spark, model):
    """The aggregate by row and the join by row share a shuffle; ids go in a few bytes."""
    plan = lattice.encode(docs(spark, [(1, "some words"), (None, None)]), model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(__row") == 2
    units = ["\u2581one", "two", "\u2581"]
    rows = spark.createDataFrame([(u, list(range(9, 9 + 31000, 12000))[:k]) for k, u in enumerate(units)], "unit string, ids array<int>")
    from pyspark.sql import functions as F

    packed = rows.select(F.concat(F.encode(F.translate("unit", lattice.BLANK, " "), "UTF-8"), lattice.entry(F.col("ids"), model)).alias("e"))
    own = lattice.read_entries(packed.toArrow().column("e").combine_chunks(), model)
    ids, sizes = own.of(np.arange(3))
    assert own.units.to_pylist() == units and sizes.tolist() == [0, 1, 2] and ids.tolist() == [9, 9, 12009]
