from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from rows import ODD, docs

from riskloom.llm import periodic, q_periodic


def plain_runs(words) -> list[tuple[int, int, int]]:
    """(start, length, period) by the definition: every period, every stretch."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            start = at
            while at + q < n and words[at] == words[at + q]:
                at += 1
            if at - start + q >= max(24, 3 * q):
                part = words[start : at + q]
                if all(part[r:] != part[:-r] for r in range(1, q)):
                    out.append((start, len(part), q))
            at += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng, most):
    out = []
    while len(out) < rng.randrange(1, most):
        if rng.random() < 0.4:
            kinds = rng.choice([2, 5, 100])
            out += [rng.randrange(kinds) for _ in range(rng.randrange(60))]
        else:
            unit = [rng.randrange(rng.choice([1, 2, 3, 1000])) for _ in range(rng.randrange(1, rng.choice([4, 10, 50, 120])))]
            out += (unit * 8)[: rng.randrange(2 * len(unit), 6 * len(unit) + 30)]
    return out


def found_runs(texts) -> list[tuple]:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    codes = np.concatenate([np.array(t, dtype=np.int64) for t in texts])
    start, stop, period = periodic.runs_of(codes, starts, sizes)
    return sorted(zip(start.tolist(), (stop - start).tolist(), period.tolist()))


def test_transforms_are_taken_back():
    rng = np.random.default_rng(1)
    for bits in range(1, 14):
        values = rng.integers(0, 1000, (3, 1 << bits)).astype(float)
        assert (periodic.inverse(periodic.transform(values.copy())) % periodic.PRIME == values).all()


@pytest.mark.parametrize("block, count", [(8, 15), (32, 32), (128, 128)])
def test_zeros_are_the_places_of_a_block(block, count):
    rng = np.random.default_rng(block)
    codes = np.concatenate([rng.integers(0, 2, 300), np.tile(rng.integers(0, 5000, 9), 80)])
    places = np.arange(0, len(codes) - 2 * block - count, block)
    padded = np.concatenate([codes, np.zeros(block + count, np.int64)])
    found = periodic.zero_distances(padded, places, np.full(len(places), 1), block, count)
    wanted = [
        (p, d) for p in places for d in range(1, 1 + count) if (codes[p : p + block] == padded[p + d : p + d + block]).all()
    ]
    assert sorted(map(tuple, found.T.tolist())) == sorted(wanted)


@pytest.mark.parametrize("seed", range(40))
def test_runs_by_definition(seed):
    rng = random.Random(seed)
    texts = [made(rng, 500) for _ in range(rng.randrange(1, 6))]
    starts = np.cumsum([0, *map(len, texts)]).tolist()
    wanted = [(at + s, n, q) for at, text in zip(starts, texts) for s, n, q in plain_runs(text)]
    assert found_runs(texts) == sorted(wanted)


def test_periods_beyond_the_widest_block():
    rng = random.Random(3)
    unit = [rng.randrange(10_000) for _ in range(periodic.WIDEST * 2 + 77)]
    text = [1, 2, 3, *unit, *unit, *unit, unit[0], unit[1], -1]
    assert found_runs([text]) == [(3, 3 * len(unit) + 2, len(unit))]


def test_one_word_for_ever_and_an_early_hash_match(monkeypatch):
    assert found_runs([[7] * 30_000]) == [(0, 30_000, 1)]
    # A hash that finds everything the same: the words themselves decide.
    monkeypatch.setattr(periodic.Hashes, "same", lambda self, a, b, size: np.ones(len(a), dtype=bool))
    text = made(random.Random(9), 400)
    assert plain_runs(text) and found_runs([text]) == sorted(plain_runs(text))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    words = words if doc_id is None else planted(doc_id, words)
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        digest(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_by_definition(spark, tmp_path):
    rng = random.Random(4)
    rows = [r for r in ODD if r[1] is None or len(r[1]) < 5000]
    rows += [(100 + k, " ".join(f"w{c}" for c in made(rng, 300))) for k in range(120)]
    rows += [(400 + k, "\t ".join(f"é{rng.randrange(4000)}" for _ in range(rng.randrange(1, 200)))) for k in range(120)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = [tuple(r) for r in q_periodic.op11_periodic(spark, str(tmp_path)).collect()]
    wanted = [plain_row(*r) for r in rows]
    key = lambda r: (str(r[0]), r[6], r[7])
    assert sorted(found, key=key) == sorted(wanted, key=key)
    assert sum(r[1] for r in found) > 50


def test_clashing_columns_long_texts_and_empty_table(spark):
    long = "a b c " * 60_000
    frame = docs(spark, [*ODD, (50, long), (51, "one two")], ", Runs long, collapsed string", (3, "x"))
    out = periodic.periodic_runs(frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "runs", "collapsed"]
    rows = {r.doc_id: r for r in out.where("doc_id > 3").collect()}
    assert [tuple(r) for r in rows[50].runs] == [(0, 180_000, 3)] and rows[50].collapsed == "a b c"
    assert rows[6].collapsed == " ".join("Ünïcode wörds Straße 漢字 🙂".split()) and rows[51].runs == []
    assert periodic.periodic_runs(frame.limit(0)).count() == 0
