from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import ODD, SCHEMA, docs

from riskloom.llm import near_duplicates as near


def plain_shingles(text, width=5):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_groups(texts, similarity=0.8):
    """Component of each text by all pairs."""
    sets, group = [plain_shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            shared = len(a & b)
            if (not a and not b) or shared >= similarity * (len(a) + len(b) - shared) > 0:
                group[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]


def edited(rng, words, share):
    """The words with so many replaced."""
    out = list(words)
    for k in rng.sample(range(len(out)), round(share * len(out))):
        out[k] = f"x{rng.randrange(10**9)}"
    return out


def test_groups_equal_all_pairs(spark):
    rng = random.Random(1)
    rows, vocabulary = [], [f"w{k}" for k in range(3000)]
    for base in range(25):
        words = rng.choices(vocabulary, k=rng.choice([8, 60, 300]))
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randrange(8)):
            rows.append((len(rows), " ".join(edited(rng, words, rng.choice([0, 0.003, 0.01, 0.05, 0.2]))).replace("w1", "W1")))
    rng.shuffle(rows)
    kept = near.first_of_each_group(docs(spark, rows)).collect()
    groups = plain_groups([t for _, t in rows])
    wanted = {}
    for (doc_id, _), g in zip(rows, groups):
        wanted[g] = min(doc_id, wanted.get(g, doc_id))
    assert sorted(r.doc_id for r in kept) == sorted(wanted.values())
    assert 25 <= len(kept) < len(rows)


@pytest.mark.parametrize("bound, least", [(0.8, 0.95), (0.9, 0.99)])
def test_recall_at_the_bound(spark, bound, least):
    """Pairs of texts just above a similarity: one of nearly every pair goes."""
    rng, rows, pairs = random.Random(int(bound * 10)), [], 0
    while pairs < 300:
        words = [f"w{rng.randrange(10**6)}" for _ in range(404)]
        copy = list(words)
        while True:
            k = rng.randrange(len(copy))
            old, copy[k] = copy[k], f"x{rng.randrange(10**9)}"
            a, b = plain_shingles(" ".join(words)), plain_shingles(" ".join(copy))
            if len(a & b) < bound * len(a | b):
                copy[k] = old
                break
        rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(copy))]
        pairs += 1
    kept = {r.doc_id for r in near.first_of_each_group(docs(spark, rows)).collect()}
    assert {2 * k for k in range(pairs)} <= kept
    assert 2 * pairs - len(kept) >= least * pairs


def test_no_link_is_left_out(spark, monkeypatch):
    """All groups of texts just above the similarity, also if there are no cheap candidates."""
    rng, rows = random.Random(5), []
    for size in (9, 14, 24, 44, 104, 404):
        for _ in range(60):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            copy = [*words[:-1], "x"] if size < 24 else words[: -(size // 6)]
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(copy))]
    wanted = {}
    for (doc_id, _), g in zip(rows, plain_groups([t for _, t in rows])):
        wanted[g] = min(doc_id, wanted.get(g, doc_id))
    assert len(wanted) < 0.9 * len(rows)
    table = docs(spark, rows)
    assert sorted(r.doc_id for r in near.first_of_each_group(table).collect()) == sorted(wanted.values())
    none = table.sparkSession.createDataFrame([], "a long, b long")
    monkeypatch.setattr(near, "candidate_links", lambda texts, distance: none)
    for most in (near.MOST, 50):
        monkeypatch.setattr(near, "MOST", most)
        assert sorted(r.doc_id for r in near.first_of_each_group(table).collect()) == sorted(wanted.values())


def test_frequent_shingles_come_last():
    hashes, late = np.arange(1, 21, dtype=np.uint64), np.array([1, 2, 3, 99], dtype=np.uint64)
    assert near.prefix_of(hashes, late, 0.8).tolist() == [4, 5, 6, 7, 8]
    assert near.prefix_of(hashes[:3], late, 0.8).tolist() == [1] and near.prefix_of(hashes[:0], late, 0.8).tolist() == []


def test_sketches_lose_no_link():
    rng = np.random.default_rng(6)
    for size in (0, 1, 7, 60, 500, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for share in (0, 0.01, 0.1, 0.3, 1):
            b = np.unique(np.append(a[rng.random(len(a)) >= share], rng.integers(0, 2**63, int(size * share)).astype(np.uint64)))
            bits = near.parities(a) ^ near.parities(b)
            assert len(bits) == near.SKETCH
            assert sum(int(x).bit_count() for x in bits.view(np.uint64)) <= len(np.setxor1d(a, b))
    assert not near.parities(a[:0]).any()


def test_texts_that_share_a_passage_make_no_rows(spark):
    """Many groups meet at the shingles of one passage; the join returns no row for those
    that cannot be similar, so the rows do not grow with their square."""
    rng, rows = random.Random(8), []
    for passage in range(3):
        shared = [f"c{passage}-{k}" for k in range(60)]
        rows += [(len(rows) + k, " ".join([*shared, *(f"w{rng.randrange(10**9)}" for _ in range(60))])) for k in range(40)]
    rows += [(1000 + k, rows[40 * k][1] + " x") for k in range(3)]
    table = docs(spark, rows).withColumn("__row", F.xxhash64("text"))
    # No shingle is known as frequent, and there are no groups so far.
    firsts = near.prefixes(table, np.zeros(0, np.uint64), 5, 0.8).cache()
    found = near.crossing_links(firsts, spark.createDataFrame([], "node long, root long"), 0.8)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan()
    assert max(join_rows(plan)) < 10 * len(rows)


def test_odd_classes_lose_no_link_and_tell_long_texts_apart():
    rng = np.random.default_rng(7)
    for size in (0, 1, 7, 64, 65, 1000, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for share in (0, 0.01, 0.1, 0.3, 1, 3):
            b = np.unique(np.append(a[rng.random(len(a)) >= share], rng.integers(0, 2**63, int(size * share)).astype(np.uint64)))
            both = [near.odd_classes(x) for x in (a, b)]
            apart = len(np.setxor1d(a, b))
            assert near.least_difference(*both) == near.least_difference(*both[::-1]) <= apart
            assert len(both[0]) <= max(8, len(a) / 4)
            if size >= 1000 and share >= 0.3:
                assert near.least_difference(*both) > (len(a) + len(b)) / 9
            if size >= 1000 and share == 0.01:
                assert near.least_difference(*both) > 0.9 * apart


def test_shingles_of_unlike_long_texts_go_nowhere(spark, monkeypatch):
    """Long texts of which each two share a passage are candidates, but no text of theirs is sent."""
    rng, count = random.Random(11), 12
    words = [[[f"w{rng.randrange(10**9)}" for _ in range(30)] for _ in range(60)] for _ in range(count)]
    for i in range(count):
        for j in range(i):
            words[i][j] = words[j][i]
    rows = [(i, " ".join(w for part in parts for w in part)) for i, parts in enumerate(words)]
    rows += [(100 + i, f"{t} x") for i, (_, t) in enumerate(rows[:3])]
    sent, tried, holding, crossing = [], [], near.holding_links, near.crossing_links

    def counted(candidates, *rest):
        sent.append(candidates.count())
        return holding(candidates, *rest)

    def met(*given):
        found = crossing(*given)
        tried.append(found.count())
        return found

    monkeypatch.setattr(near, "holding_links", counted)
    monkeypatch.setattr(near, "crossing_links", met)
    kept = near.first_of_each_group(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(count))
    assert tried[0] > 30 and sum(sent) < 10


def test_texts_are_dealt_out_once_at_the_end(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l"), (2, "g h i j k l"), (2, None)]
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        kept = near.first_of_each_group(docs(spark, rows))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        found = [(r.doc_id, r.text) for r in kept.collect()]
    finally:
        spark.conf.set(name, before)
    assert sorted(found, key=str) == sorted([(2, None), (2, "g h i j k l"), (None, "a b c d e f")], key=str)
    # The texts and the keys that stay.
    assert plan.count("Exchange hashpartitioning") == 2


def test_map_of_shared_shingles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    flat = rng.integers(-(2**63), 2**63, 3000)
    tokens = spark.createDataFrame([(int(t),) for t in flat[::3]], "token long")
    lists = [flat[:0], flat[:700], flat[:0], flat[700:2999], flat[2999:]]
    rooted = spark.createDataFrame(
        [(i, 10 + i, len(x), x.tolist(), *range(near.SKETCH)) for i, x in enumerate(lists)],
        "node long, root long, size long, prefix array<long>, " + ", ".join(f"{b} long" for b in near._BITS),
    )
    for most in (near.MOST_SLOTS, 1 << 15):
        monkeypatch.setattr(near, "MOST_SLOTS", most)
        found = near.placed_tokens(rooted.coalesce(1), near.slots_of(tokens)).collect()
        assert {int(t) for t in flat[::3]} <= {r.token for r in found} and len(found) < 1500
        for r in found:
            own = lists[r.node].tolist()
            assert own[r.place] == r.token and r.before == own[max(0, r.place - near.BEFORE) : r.place]
            assert (r.root, r.size, r.b0, r.b7) == (10 + r.node, len(own), 0, 7)


def join_rows(node) -> list[int]:
    """Rows that each join of a run plan returned."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return join_rows(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return join_rows(node.plan())
    own = [node.longMetric("numOutputRows").value()] if "Join" in kind and "condition" in dir(node) and node.condition().isDefined() else []
    kids = node.children()
    return own + [n for k in range(kids.size()) for n in join_rows(kids.apply(k))]


def test_clean_texts_stay(spark):
    """Texts that share half of their words are no copies, however many."""
    rng = random.Random(7)
    common = [f"c{k}" for k in range(100)]
    rows = [(i, " ".join([*common, *(f"w{rng.randrange(10**7)}" for _ in range(60))])) for i in range(400)]
    assert near.first_of_each_group(docs(spark, rows)).count() == 400


@pytest.mark.parametrize("part", [near.PART, 7])
def test_one_large_group(spark, monkeypatch, part):
    """Near copies of one text beside it, checked in parts of the links."""
    monkeypatch.setattr(near, "PART", part)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(edited(rng, words, 0.005))) for i in range(300)] + [(1000, "another text of its own")]
    assert sorted(r.doc_id for r in near.first_of_each_group(docs(spark, rows)).collect()) == [0, 1000]


def test_bands_tell_texts_apart():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    assert (near.band_values(a) == near.band_values(np.random.default_rng(4).permutation(a))).all()
    assert not (near.band_values(a) == near.band_values(rng.integers(0, 2**63, 500).astype(np.uint64))).any()
    assert not near.band_values(a[:0]).any()


def test_odd_rows(spark):
    table = docs(spark, ODD, ", fp string, node long, root int, a int, bands string, _slot int", ("x", 5, 1, 2, "b", 3))
    kept = near.first_of_each_group(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7]


def test_groups_without_their_own_id(spark):
    """Of every group one row stays, also if ids are null or those of another text."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(6)]
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0]), (9, texts[1]), (5, texts[4]), (5, texts[5]), (5, texts[5])]
    kept = near.first_of_each_group(docs(spark, rows)).collect()
    wanted = [(None, texts[0]), (9, texts[1]), (None, texts[2]), (None, texts[3]), (5, texts[4]), (5, texts[5])]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(wanted, key=str)


def test_empty_table(spark):
    assert near.first_of_each_group(spark.createDataFrame([], SCHEMA)).collect() == []
