from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from rows import ODD, SCHEMA, docs

from riskloom.llm import simhash


def plain_print(text, width=4):
    words = (text or "").encode().lower().split() if (text or "").isascii() else None
    if words is None:
        words = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(ids_prints, distance=4):
    group = list(range(len(ids_prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, p) in enumerate(ids_prints):
        for j in range(i):
            if bin(p ^ ids_prints[j][1]).count("1") <= distance:
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(ids_prints):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(
        ((d, p, least.get(root(i))) for i, (d, p) in enumerate(ids_prints)), key=str
    )


def found(df):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in df.collect()), key=str)


def test_groups_equal_all_pairs(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = plain_components([(r.doc_id, plain_print(r.text)) for r in table.collect()])
    assert found(simhash.near_duplicates(table)) == expected


def test_odd_rows(spark):
    # Column names that the operator uses itself must not disturb it.
    table = docs(spark, ODD, ", fp string, component_id long, root int, a int", ("x", 5, 1, 2))
    expected = plain_components([(d, plain_print(t)) for d, t in ODD])
    assert found(simhash.near_duplicates(table)) == expected


def test_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(table).collect() == []


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_masks_share_a_pattern(agree):
    masks = [m & (1 << 64) - 1 for m in simhash.block_masks(4, agree)]
    rng = random.Random(agree)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 4):
            b ^= 1 << k
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("seed", range(4))
def test_links_of_dense_and_sparse_prints(spark, seed):
    """Random prints, a dense cloud beyond PER_PATTERN and chains of small steps."""
    rng = random.Random(seed)
    prints = {rng.getrandbits(64) for _ in range(150)}
    middle = rng.getrandbits(64)
    for _ in range(150):
        prints.add(middle ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))))
    at = rng.getrandbits(64)
    for _ in range(40):
        at ^= sum(1 << k for k in rng.sample(range(64), rng.randint(2, 5)))
        prints.add(at)
    values = sorted(prints)
    expected = {v: c for v, _, c in plain_components([(v, v) for v in values])}
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    for agree in (1, 2):
        pairs = [
            (a & (1 << 64) - 1, b & (1 << 64) - 1)
            for a, b in simhash.links(frame, 4, agree).collect()
        ]
        assert all(bin(a ^ b).count("1") <= 64 for a, b in pairs)
        group = {v: v for v in values}

        def root(v, group=group):
            while group[v] != v:
                v = group[v]
            return v

        for a, b in pairs:
            low, high = sorted((root(a), root(b)))
            group[high] = low
        assert {v: root(v) for v in values} == expected


def test_tree_search_equals_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = base[rng.integers(0, 40, 1500)].copy()
    for _ in range(5):
        values ^= np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)
    values = np.unique(values)
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    values = values[np.argsort(rank)]
    label = simhash.components_in_order(values, 4)
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 4
    expected = simhash._join_labels(np.arange(len(values)), *np.nonzero(near))
    assert (label == expected).all()
    assert len(np.unique(label)) > 20
