from __future__ import annotations

import random

import numpy as np
import pytest
from rows import ODD, SCHEMA, docs

from riskloom.llm import q_toxicity, toxicity

LABELS = "doc_id long, quality int, toxic int"


def plain_segments(scores):
    """By definition: the best segment, then the same on both sides of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = max(
        ((sum(scores[i:j]), i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        key=lambda b: (b[0], b[1]),
    )
    _, _, i, j = best
    right = [(s + j, e + j, v) for s, e, v in plain_segments(scores[j:])]
    return plain_segments(scores[:i]) + [(i, j, best[0])] + right


@pytest.mark.parametrize("seed", range(30))
def test_maximal_segments(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(rng.randint(0, 25))]
    found = toxicity.maximal_segments(np.array(scores, dtype=float))
    assert [(s, e, round(v, 6)) for s, e, v in found] == [(s, e, round(v, 6)) for s, e, v in plain_segments(scores)]


def test_scale_solves_its_equation():
    values, weights = np.array([-0.7, -0.5, 1.0, 3.0]), np.array([900.0, 50, 3, 1])
    scale = toxicity.scale_of(values, weights)
    assert abs((weights * np.exp(scale * values)).sum() / weights.sum() - 1) < 1e-6 and scale > 0


def test_held_out_rows_of_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = q_toxicity.op1_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.97
    toxic, other = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert toxic and min(toxic) > max(other)


def test_labels_of_held_out_rows_are_not_used(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] + [(None, 1, 1), (3, 1, None), (8, 1, 1)], LABELS)
    train = {r.doc_id: r.toxic for r in toxicity.training_rows(labels).collect()}
    import zlib

    assert set(train) == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert all(v == (1 if k == 8 else k % 2) for k, v in train.items())
    assert len(toxicity.training_rows(labels, 40).collect()) < 80


def scored(spark, rows, labels, more=()):
    frame = docs(spark, rows, ", score string, toxic int, token string", ("x", 1, "t")) if more else docs(spark, rows)
    return toxicity.score_documents(frame, spark.createDataFrame(labels, LABELS)).collect()


def test_odd_rows(spark):
    rng = random.Random(2)
    plain = [f"plain{k}" for k in range(60)]
    rows, labels = list(ODD), [(None, 1, 1), (7, 1, 0), (7, 1, 1), (999, 0, None)]
    for i in range(100, 200):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 4 == 0:
            words[10:13] = ["Vile!", "vileness", "vilest"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    found = scored(spark, rows, labels, more=True)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and r.doc_id >= 100:
            assert r.predicted == (r.doc_id % 4 == 0)
            assert [(p.start, p.stop) for p in r.passages] == ([(10, 13)] if r.doc_id % 4 == 0 else [])
        else:
            assert r.predicted == 0 and not r.passages
            assert not r.held_out or r.doc_id is not None


def test_a_later_passage_of_the_same_words_counts():
    words = ["vile", "vileness", "vilest"]
    model = toxicity.Model({toxicity._tag(w): 4.0 for w in words}, {}, 1.0, 0.01)
    text = ["vile", *["plain"] * 40, *words, "vile", *["plain"] * 100, *words, *["plain"] * 9]
    values = toxicity.Scores(model).of(" ".join(text))
    assert [(s, e) for s, e, _ in toxicity.maximal_segments(values)] == [(0, 1), (41, 44), (145, 148)]


def test_no_scored_token_is_dropped(spark):
    scores = {f"token{k}": 1.0 + k for k in range(4000)}
    table = toxicity._table(spark.createDataFrame([(k, v, 0.0) for k, v in scores.items()], "token string, score double, begins double"), "token")
    assert all(table.get(toxicity._tag(t)) == s for t, s in scores.items())
    assert table.get(toxicity._tag("another")) is None


def test_a_known_neutral_word_has_no_score(spark):
    """A word of toxic and other texts alike, under a beginning of toxic words."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words = [f"plain{rng.randrange(60)}" for _ in range(40)] + ["vilewater"]
        if i % 4 == 0:
            words += [f"vile{rng.randrange(300)}x" for _ in range(8)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    frame, train = docs(spark, rows), toxicity.training_rows(spark.createDataFrame(labels, LABELS))
    counts = toxicity.token_counts(frame, train)
    model = toxicity.learn(counts, train.where("toxic = 1").count(), train.where("toxic = 0").count())
    scores = toxicity.Scores(model)
    assert all(abs(scores[w] + toxicity.DRIFT) < 0.1 for w in ("vilewater", "plain7"))
    assert scores["vilenew"] > 0 and scores["nothingknown"] == -toxicity.DRIFT
    # The same scores as those the background is made of.
    tokens, _ = toxicity.token_scores(counts, train.where("toxic = 1").count() + 1, train.where("toxic = 0").count() + 1)
    for r in tokens.collect():
        assert abs(scores[r.token] + toxicity.DRIFT - r.score) < 1e-9


def test_the_probability_is_fitted_on_rows_the_model_does_not_know(spark):
    rows = [(i, f"only{i} words{i} of{i} row{i}") for i in range(400)]
    labels = [(i, 1, i % 2) for i in range(400)]
    found = scored(spark, rows, labels)
    # Every word stands in one row, so it tells nothing of other rows.
    assert all(0.3 < r.score < 0.7 for r in found)
    train = toxicity.training_rows(spark.createDataFrame(labels, LABELS)).collect()
    assert 0.1 < sum(r.kept for r in train) / len(train) < 0.3


def test_no_labels_and_no_rows(spark):
    assert [r.predicted for r in scored(spark, [(1, "a b c")], [])] == [0]
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.score_documents(empty, spark.createDataFrame([(1, 1, 1)], LABELS)).collect() == []
