from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
from rows import ODD, SCHEMA, docs

from riskloom.llm import q_line_quality
from riskloom.llm.line_quality import LineLimits, remove_frequent_lines

LIMITS = LineLimits(docs=3, share=0.05)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORD.findall(text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def base(frame, limits=LIMITS):
    rows = remove_frequent_lines(frame, limits).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=str
    )


def test_base_figures(spark):
    rng = random.Random(4)
    rows = [*ODD]
    for i in range(100, 160):
        words = [rng.choice("abcdefg #*|") * rng.randint(1, 2) for _ in range(rng.randint(0, 130))]
        rows.append((i, "".join(w + rng.choice(" \n\t\x0b") for w in words)))
    frame = docs(spark, rows, ", kept string, h int, w long, _words string", ("k", 1, 2, "w"))
    assert base(frame) == sorted(((d, *plain_base(t)) for d, t in rows), key=str)


def sentence(seed, n=14):
    rng = random.Random(str(seed))
    return " ".join(f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(n))


def test_lines_above_the_limits(spark):
    footer, banner = "All Rights   RESERVED by us.", sentence("banner", 100)
    rows = []
    for i in range(40):
        own = "\n".join(sentence((i, k)) for k in range(5))
        extra = f"\n{footer.upper() if i % 2 else footer}" if i < 10 else f"\n{banner}" if i < 20 else ""
        rows.append((i, own + extra, "host"))
    # The same footer in few documents of another host, and depleted documents.
    rows += [(50 + i, "\n".join(sentence((50 + i, k)) for k in range(5)) + f"\n{footer}", "other") for i in range(3)]
    rows += [(60 + i, f"{sentence(60 + i, 5)}\n{banner}", "host") for i in range(4)]
    # A group of near copies is no boilerplate.
    page = [sentence(("page", k)) for k in range(8)]
    rows += [(100 + i, "\n".join([*page[:-1], f"{page[-1]} v{i}"]), "host") for i in range(30)]
    found = {r.doc_id: r for r in remove_frequent_lines(docs(spark, rows), LIMITS).collect()}
    texts = {d: t for d, t, _ in rows}
    for i in range(40):
        first = i in (0, 10)
        lines = texts[i].split("\n")
        assert found[i].clean_text == "\n".join(lines if first or i >= 20 else lines[:5])
        assert found[i].kept and len(found[i].removed_lines) == (not first and i < 20)
    assert all(found[50 + i].clean_text == texts[50 + i] for i in range(3))
    assert not any(found[60 + i].kept for i in range(4))
    assert all(found[100 + i].kept and found[100 + i].n_removed_words == 0 for i in range(30))


def against_sql(spark, rows, tmp_path):
    """The default limits on rows, and the same by the statement."""
    frame = docs(spark, rows)
    found = {r.doc_id: (r.n_removed_words, r.kept) for r in remove_frequent_lines(frame).collect()}
    duck = duckdb.connect()
    folder = str(tmp_path / "documents.parquet")
    frame.write.parquet(folder)
    duck.execute(f"CREATE VIEW documents AS FROM read_parquet('{folder}/*.parquet')")
    by_sql = duck.execute(q_line_quality.ORACLE["op2_line_quality"]).df()
    assert found == {r.doc_id: (r.n_removed_words, r.kept) for r in by_sql.itertuples()}
    return found


def test_copies_do_not_shield_a_line(spark, tmp_path):
    """60 documents share a header; a page with the header has 80 copies, and it has near copies."""
    header = sentence("header", 12)
    own = [(i, f"{header}\n{sentence(i, 60)}", "host") for i in range(60)]
    page = [sentence(("page", k)) for k in range(8)]
    copies = [(100 + i, "\n".join([header, *page]), "host") for i in range(80)]
    near = [(200 + i, "\n".join([header, *page[:5], f"{page[5]} v{i}", *page[6:]]), "host") for i in range(80)]
    for rows in (own, own + copies, own + copies + near):
        found = against_sql(spark, rows, tmp_path / str(len(rows)))
        assert all(kept for _, kept in found.values())
        assert {d for d, (n, _) in found.items() if n == 0} == {0}
        assert {n for n, _ in found.values()} == {0, 12}


def test_documents_of_shared_lines_only(spark, tmp_path):
    """They shield no line, and are depleted."""
    common = [sentence(("common", k), 20) for k in range(4)]
    rows = [(i, "\n".join([*common, sentence(i, 60)]), "host") for i in range(40)]
    rows += [(100 + i, "\n".join(common), "host") for i in range(90)]
    found = against_sql(spark, rows, tmp_path)
    assert {d for d, (_, kept) in found.items() if not kept} == {100 + i for i in range(90)}
    assert all(found[i] == (80, True) for i in range(1, 40)) and found[0] == (0, True)


def test_groups_of_copies_are_no_boilerplate(spark, tmp_path):
    """Exact and near copies in numbers far above the limits keep their lines."""
    rng = random.Random(6)
    page = [sentence(("page", k)) for k in range(12)]
    rows = [(i, "\n".join(page), "host") for i in range(150)]
    for i in range(150):
        lines = list(page)
        words = lines[rng.randrange(12)].split()
        words[rng.randrange(14)] = f"edit{i}"
        lines[rng.randrange(12)] = " ".join(words)
        rows.append((1000 + i, "\n".join(lines), "host"))
    rows += [(5000 + i, sentence(i, 60), "host") for i in range(50)]
    found = against_sql(spark, rows, tmp_path)
    assert all(v == (0, True) for v in found.values())


def test_repeated_rows_and_null_hosts(spark):
    line = sentence("shared", 20)
    rows = [(i // 2, f"{sentence(i, 60)}\n{line}", None) for i in range(12)] + [(None, f"{sentence(99, 60)}\n{line}", None)]
    found = remove_frequent_lines(docs(spark, rows), LIMITS).collect()
    assert len(found) == len(rows)
    # The first document keeps its line, in all rows under its id.
    assert sorted(line in r.clean_text for r in found) == [False] * 11 + [True] * 2
    assert {r.doc_id for r in found if line in r.clean_text} == {0}


def test_documents_that_share_many_lines(spark):
    """Documents of few own lines and many shared ones are told apart by the own ones."""
    rows, common = [], {}
    for own, shared in ((1, 2), (1, 5), (3, 6), (5, 10), (10, 10)):
        host = f"{own}+{shared}"
        lines = common[host] = [sentence((host, k)) for k in range(shared)]
        for i in range(60):
            mine = [sentence((host, i, k)) for k in range(own)]
            rows.append((len(rows), "\n".join([*lines[: shared // 2], *mine, *lines[shared // 2 :]]), host))
        # Exact copies of one page do not count.
        rows += [(len(rows) + i, "\n".join(sentence((host, "page", k)) for k in range(6)), host) for i in range(30)]
    found = {r.doc_id: r for r in remove_frequent_lines(docs(spark, rows), LIMITS).collect()}
    for at, (doc_id, text, host) in enumerate(rows):
        own, shared = map(int, host.split("+"))
        if 0 < at % 90 < 60:
            assert found[doc_id].clean_text == "\n".join(x for x in text.split("\n") if x not in common[host])
            assert found[doc_id].n_removed_words == 14 * shared
            assert found[doc_id].kept == (14 * (own + shared) >= 50 and own >= 0.2 * (own + shared))
        else:
            assert found[doc_id].clean_text == text and found[doc_id].n_removed_words == 0


def test_rows_without_their_own_id(spark):
    """Rows with a null or repeated doc_id are depleted by their own lines only."""
    line = sentence("shared", 20)
    rows = [(i if i < 5 else None if i % 2 else 7, f"{sentence(i, 60)}\n{line}", "host") for i in range(30)]
    # In this host no document has an id.
    rows += [(None, f"{sentence(('none', i), 60)}\n{line}", "none") for i in range(10)]
    found = remove_frequent_lines(docs(spark, rows), LIMITS).collect()
    assert len(found) == len(rows) and all(r.kept for r in found)
    assert {(r.n_removed_words, len(r.removed_lines)) for r in found} == {(0, 0), (20, 1)}
    assert sum(r.n_removed_words == 0 for r in found if r.source == "host") == 1
    assert sum(r.n_removed_words == 0 for r in found if r.source == "none") == 1


def test_empty_table(spark):
    assert remove_frequent_lines(spark.createDataFrame([], SCHEMA), LIMITS).collect() == []
