from __future__ import annotations

import random
import time
from itertools import permutations

import pytest
from rows import ODD, SCHEMA, docs

from riskloom.llm import reshard
from riskloom.session import work_dir


def cost_of(flow, cost):
    return sum(n * cost[i][j] for (i, j), n in flow.items())


@pytest.mark.parametrize("seed", range(25))
def test_flow_is_cheapest(seed):
    """Against all ways to place single units."""
    rng = random.Random(seed)
    n, m = rng.randint(1, 3), rng.randint(1, 3)
    supply = [rng.randint(0, 2) for _ in range(n)]
    capacity = [rng.randint(0, 3) for _ in range(m)]
    while sum(capacity) < sum(supply):
        capacity[rng.randrange(m)] += 1
    cost = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
    flow = reshard.min_cost_flow(supply, capacity, cost)
    for i in range(n):
        assert sum(f for (k, _), f in flow.items() if k == i) == supply[i]
    for j in range(m):
        assert sum(f for (_, k), f in flow.items() if k == j) <= capacity[j]
    units = [i for i in range(n) for _ in range(supply[i])]
    rooms = [j for j in range(m) for _ in range(capacity[j])]
    best = min(sum(cost[i][j] for i, j in zip(units, p)) for p in permutations(rooms, len(units)))
    assert cost_of(flow, cost) == best


def test_moved_bytes_are_the_least():
    supply, n_new = [500, 20, 300, 7, 0, 90], 4
    capacity = reshard.even_capacities(sum(supply), n_new)
    flow = reshard.min_cost_flow(supply, capacity, reshard.moving_costs(6, n_new))
    stays = sum(min(s, c) for s, c in zip(supply, capacity))
    assert sum(f for (i, j), f in flow.items() if i != j) == sum(supply) - stays


def test_many_shards():
    """Thousands of shards, among them empty ones, with the fewest moved bytes."""
    rng = random.Random(4)
    supply = [rng.choice([0, rng.randrange(1 << 40)]) for _ in range(2000)]
    for capacity in (
        reshard.even_capacities(sum(supply), 500),
        [*supply[1:], supply[0]],
    ):
        cost = reshard.moving_costs(2000, len(capacity))
        began = time.monotonic()
        flow = reshard.min_cost_flow(supply, capacity, cost)
        assert time.monotonic() - began < 60
        stays = sum(min(s, c) for s, c in zip(supply, capacity))
        assert sum(f for (i, j), f in flow.items() if i != j) == sum(supply) - stays
        sent, got = [0] * 2000, [0] * len(capacity)
        for (i, j), f in flow.items():
            sent[i] += f
            got[j] += f
        assert sent == supply and all(g <= c for g, c in zip(got, capacity))


def resharded(spark, table, n_new, capacity=None):
    path, out = work_dir(spark, "old"), work_dir(spark, "new")
    table.write.parquet(path)
    return path, reshard.reshard(spark, path, out, n_new, capacity)


def plain(text):
    return len((text or "").encode()) + 1


def held(rows, n_new, n_blocks):
    sizes = [0] * n_new
    for shard in range(n_new):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
        sizes[shard] = sum(plain(r.text) for r in rows if r.shard == shard)
    most = max((plain(r.text) for r in rows), default=0)
    assert max(sizes) - min(sizes) <= 2 * n_blocks * most + 1
    return sizes


def test_given_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(reshard, "CHUNK", 16)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for files in (1, 5, 11):
        _, out = resharded(spark, table.repartition(files), 8)
        rows = out.collect()
        assert out.columns[:5] == table.columns
        assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in table.collect())
        held(rows, 8, 2)
        sizes = [plain(r.text) for r in rows]
        each = [sum(plain(r.text) for r in rows if r.shard == s) for s in range(8)]
        assert all(abs(e - sum(sizes) / 8) <= 2 * max(sizes) for e in each)


def test_rows_that_stay_are_not_rewritten(spark):
    table = docs(spark, [(i, "x" * 99) for i in range(40)]).coalesce(1)
    path, out = work_dir(spark, "old"), work_dir(spark, "new")
    table.write.option("maxRecordsPerFile", 10).parquet(path)
    same = reshard.reshard(spark, path, out, 4)
    rows = same.collect()
    assert held(rows, 4, 1) == [1000] * 4 and len(rows) == 40
    # All rows stand in the old files.
    assert {f.rsplit("/", 2)[1] for f in same.inputFiles()} == {path.rstrip("/").rsplit("/", 1)[1]}
    # One more shard of the same size moves an equal part of each.
    more = reshard.reshard(spark, path, work_dir(spark, "new"), 5).collect()
    assert held(more, 5, 4) == [800] * 5


def test_odd_rows(spark):
    table = docs(spark, ODD, ", shard string, slot int, _old int, _file string, _row int", ("x", 1, 2, "f", 3))
    _, out = resharded(spark, table, 3)
    rows = out.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(ODD, key=str)
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(3))


def test_empty_table(spark):
    _, out = resharded(spark, spark.createDataFrame([], SCHEMA), 3)
    assert out.collect() == []
