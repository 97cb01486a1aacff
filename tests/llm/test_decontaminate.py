from __future__ import annotations

import hashlib
import random
import re
import time

from pyspark.sql import functions as F
from rows import ODD, SCHEMA, docs

from riskloom.llm import decontaminate
from riskloom.llm.decontaminate import hits

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, width=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        own = terms(text)
        if item is None or not own:
            continue
        size = min(width, len(own))
        for i in range(len(own) - size + 1):
            windows.setdefault(tuple(own[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, text in rows:
        own, covered, found = terms(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                hit = windows.get(tuple(own[i : i + size]))
                if hit:
                    covered.update(range(i, i + size))
                    found |= hit
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(own), len(covered), len(found), ids, bool(covered)))
    return sorted(out, key=str)


def result(frame, items):
    rows = hits(frame, items).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str
    )


def test_against_all_windows(spark):
    """Few words, so windows overlap, repeat and nearly match; hot passages; short items."""
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "The", "of", "a1", "zwölf", "Ärger", "ärger", "x"])
    text = lambda n: " ".join(word() + rng.choice(["", ",", ".", "-"]) for _ in range(n))
    items = [(i, text(rng.randint(1, 14))) for i in range(25)]
    items += [(100, text(30)), (101, "same words"), (102, "Same, words!"), (103, " .,- "), (104, None), (None, text(12)), (105, "lonely")]
    items += [(106, " ".join(f"r{k}" for k in range(40))), (106, "another text of the same item id")]
    rows = [*ODD, (None, items[0][1])]
    for d in range(200, 260):
        parts = [text(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, 3)
            parts += [" ".join(own[cut:]), text(rng.randint(0, 6))]
        rows.append((d, " ".join(parts)))
    rows += [(300, "same WORDS same words lonely"), (300, "lonely"), (301, " ".join(f"r{k}" for k in range(5, 30)))]
    rows += [(400 + k, f"own{k} {items[-2][1]} end") for k in range(50)]
    frame = docs(spark, rows, ", n_hit string, words int, start int, found string, term string", ("n", 1, 2, "f", "t"))
    assert result(frame, spark.createDataFrame(items, ITEMS)) == plain(rows, items)


def test_rows_without_an_id_are_spread(spark):
    """Ten thousand rows without an id: no row of the index sees the matches of another."""
    phrase = " ".join(f"p{k}" for k in range(12))
    items = [(1, phrase), (2, "short item")]
    rows = [(None, f"row {k} " + (phrase if k % 3 == 0 else "short item" if k % 3 == 1 else "clean")) for k in range(10_000)]
    rows += [(5, phrase), (5, "clean"), (5, phrase), (None, None), (None, ""), *[(None, phrase)] * 300]
    frame, asked = docs(spark, rows, ", key string", ("k",)), spark.createDataFrame(items, ITEMS)
    assert result(frame, asked) == plain(rows, items)
    found = decontaminate.hits(frame, asked).select(F.max(F.size("matches")).alias("most")).first()
    assert found.most == 1
    numbers = decontaminate.numbered(asked)
    index = decontaminate.postings(frame, numbers.select(F.explode("words").alias("term")).distinct())
    groups = decontaminate.intersected(index, decontaminate.probes(frame, numbers)).groupBy("doc_id", "key").count()
    assert groups.agg(F.max("count")).first()[0] <= 3


def test_proximity_matches(spark):
    phrase = " ".join(f"p{k}" for k in range(10))
    items = spark.createDataFrame([(1, phrase)], ITEMS)
    near = phrase.replace("p4", "p4 and so")
    rows = [(1, phrase), (2, near), (3, "p0 " + "x " * 30 + "p9"), (4, "nothing")]
    found = {r.doc_id: (r.n_near_items, r.contaminated) for r in hits(docs(spark, rows), items).collect()}
    assert found == {1: (1, True), 2: (1, False), 3: (0, False), 4: (0, False)}


def test_empty_tables(spark):
    empty, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "one two")], ITEMS)
    assert hits(empty, items).collect() == []
    rows = [(1, "one two")]
    assert result(docs(spark, rows), spark.createDataFrame([], ITEMS)) == plain(rows, [])


def test_words_are_those_of_the_contract(spark):
    """All code points but the surrogates, each between two letters."""
    points = [k for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    rows = [(k, " ".join(f"a{chr(c)}B" for c in points[k : k + 4096])) for k in range(0, len(points), 4096)]
    found = spark.createDataFrame(rows, "k long, text string").select("k", decontaminate.terms_of(F.col("text")).alias("words"))
    own = {r.k: r.words for r in found.collect()}
    assert all(own[k] == terms(text) for k, text in rows)


def test_words_cost_little_more_than_a_split(spark):
    """Stated as what it leaves out, the class took over 40 times as long as a split."""
    line = "Some plain words, and others (of a kind): zwölf Ärger " * 40
    frame = spark.range(0, 10_000, 1, 4).select(F.concat(F.lit(line), F.col("id").cast("string")).alias("text")).cache()
    frame.count()

    def seconds(words):
        took = []
        for _ in range(3):
            began = time.monotonic()
            frame.select(F.sum(F.size(words))).collect()
            took.append(time.monotonic() - began)
        return min(took)

    assert seconds(decontaminate.terms_of(F.col("text"))) < 12 * seconds(F.split("text", " "))
    frame.unpersist()
