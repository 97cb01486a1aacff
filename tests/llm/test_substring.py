from __future__ import annotations

import hashlib
import random

import pytest
from rows import ODD, SCHEMA, docs

from riskloom.llm import common, substring


def plain(rows, window=substring.WINDOW):
    """(doc_id, n_words, n_removed, kept_sha256) by looking at every window."""
    least: dict[tuple, int] = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if d is not None:
                least[key] = min(d, least.get(key, d))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if d is not None and least[tuple(words[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((d, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    rows = substring.repeated_words(frame).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_cover_has_every_difference():
    differences = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert differences == set(range(substring.PERIOD))


def made(seed):
    """Passages of 45 to 130 words at all shifts, copies, near copies and repeats inside a text."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passages = [[word() for _ in range(n)] for n in (45, 49, 50, 51, 64, 80, 130)]
    rows = []
    for d in rng.sample(range(1000), 40):
        words = []
        for _ in range(rng.randint(0, 3)):
            words += [word() for _ in range(rng.randint(0, 70))]
            passage = rng.choice(passages)
            cut = rng.randint(0, 10)
            words += passage[cut:]
        rows.append((d, " ".join(words)))
    copy = rows[0][1]
    rows += [(2000 + k, copy) for k in range(6)]
    rows += [(3000 + k, copy.replace("w1", f"v{k}", 1)) for k in range(6)]
    rows.append((4000, " ".join([copy] * 3)))
    return rows


@pytest.mark.parametrize("batch", [10_000, 5])
def test_against_all_windows(spark, batch):
    """Small batches cut groups of equal anchors and windows in the reducers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for seed in (1, 2):
            rows = made(seed)
            assert found(docs(spark, rows).repartition(5)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_passage_in_all_documents(spark):
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(i, f"own{i} a{i} {passage} b{i}") for i in range(300)]
    assert found(docs(spark, rows).repartition(7)) == plain(rows)


def test_odd_rows(spark):
    words = " ".join(f"w{k}" for k in range(60))
    rows = [*ODD, (None, words), (40, words), (41, f"x\x0b{words}\x1c"), (41, f"{words} other"), (42, words.upper())]
    frame = docs(spark, rows, ", spans int, n_words string, places int, _id int", (1, "n", 2, 3))
    # Rows that share the id 41 are not smaller than each other; both lose to 40.
    assert found(frame) == plain(rows)
    cut = substring.remove_repeats(frame)
    assert cut.columns == frame.columns
    texts = sorted(((r.doc_id, r.text) for r in cut.collect()), key=str)
    sums = sorted(((r[0], r[3]) for r in plain(rows)), key=str)
    assert sorted(((d, hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest()) for d, t in texts), key=str) == sums
    assert {(d, t) for d, t in ODD if d not in (6,)} <= set(texts)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("slots", [1, 64, 1 << 26])
def test_any_size_of_the_map(spark, monkeypatch, slots):
    monkeypatch.setattr(common, "SLOTS", slots)
    rows = made(77)
    assert found(docs(spark, rows)) == plain(rows)


def test_rows_sent_in_small_parts(monkeypatch):
    """Sorting some rows at a time loses none of them, whole or in parts."""
    import pyarrow as pa

    ids, texts = zip(*made(5))
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    def sent():
        parts = list(substring._anchors([batch]))
        places = {(d, p) for b in parts for d, p in zip(b.column("doc_id").to_pylist(), b.column("place").to_pylist())}
        return len(parts), places

    whole = sent()
    monkeypatch.setattr(substring, "HELD", 20)
    parts = sent()
    assert parts[0] > whole[0] and parts[1] == whole[1]


def test_ids_without_an_order_are_refused(spark):
    with pytest.raises(ValueError):
        substring.repeated_words(spark.createDataFrame([("a", "text")], "doc_id string, text string"))
