from __future__ import annotations

import gzip
import random
from pathlib import Path

import duckdb
import pytest

from riskloom.llm import q_warc, warc

SCHEMA = "page_id long, url string, html string"


def made(spark, rows, more: str = "", clash=()):
    return spark.createDataFrame([(*r, *clash) for r in rows], SCHEMA + more)


def rows_of(seed: int, n: int):
    rng = random.Random(seed)
    for k in range(n):
        host = rng.choice(["a.example.com", "b.example.org", "deep.a.example.com"])
        path = "hot" if k % 3 == 0 else f"p/{rng.randrange(n)}"
        html = None if k % 50 == 7 else "" if k % 50 == 8 else "same text" if k % 3 == 1 else f"text {rng.randrange(n // 2)} é漢🙂"
        yield (k, f"https://{host}/{path}", html)


ODD = [
    (None, "http://x.org/1", "shared by no id"),
    (None, None, "shared by no id"),
    (500, "http://x.org/1", "with and without id"),
    (None, "http://x.org/1", "with and without id"),
    (501, None, "no url"),
    (502, "", ""),
    (503, "not a url at all \r\n\t", "x"),
    (504, "http://[bad", "x"),
    (505, "HTTP://User@Host.Example.COM:80/Path?q=1#frag", "y\r\n\r\nz"),
    (505, "HTTP://User@Host.Example.COM:80/Path?q=1#frag", "y\r\n\r\nz"),
    (505, "http://host.example.com/Path?q=1", "another"),
    (506, "http://10.0.0.1:8080/é b", "long é " * 40_000),
    (-3, "http://x.org/1", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
]


def wanted_of(rows):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    return duck.execute(q_warc.ORACLE["op13_warc"]).fetchall()


def key(row):
    return tuple(str(v) for v in row)


def plain(data: bytes):
    """Records of a whole file, one after the other."""
    data = gzip.decompress(data)
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        yield fields, rest[:size]
        data = rest[size + 4 :]


def test_query_against_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 7)
    monkeypatch.setattr(warc, "HEAVY", 2)
    rows = [*rows_of(1, 400), *ODD]
    random.Random(2).shuffle(rows)
    made(spark, rows).repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    found = q_warc.op13_warc(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(wanted_of(rows), key=key)


def test_files_are_archives_and_blocks_are_sorted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 10)
    rows = [*rows_of(3, 300), *ODD]
    out = str(tmp_path / "archive")
    index = warc.archive(spark, made(spark, rows, ", URL_KEY string, refers_to long", ("c", 1)), out)
    records = [r for f in Path(out).glob("*.warc.gz") for r in plain(f.read_bytes())]
    assert len(records) == len(rows)
    for fields, block in records:
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")
        http, payload = block.split(b"\r\n\r\n", 1)
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == f"sha1:{warc.payload_digest(payload)}"
        else:
            assert payload == b""
    keys = []
    for file in index["files"]:
        directory = warc.Directory(out, file["name"])
        data = Path(out, f"{file['name']}.blocks").read_bytes()
        blocks = [warc.block_lines(data[at : at + size])[0] for at, size in directory.places]
        assert directory.firsts == [b[0] for b in blocks] and all(len(b) <= 10 for b in blocks)
        keys += [k for b in blocks for k in b]
    assert keys == sorted(keys) == sorted(warc.url_key(r[1]).encode() for r in rows)


def test_lookup_finds_the_captures_of_each_url(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 5)
    rows = [*rows_of(5, 200), *ODD]
    out = str(tmp_path / "archive")
    warc.archive(spark, made(spark, rows), out)
    asked = ["https://a.example.com/hot", "http://x.org/1", "http://nowhere.org/", "zzz", None, "http://host.example.com/Path?q=1"]
    urls = spark.createDataFrame([(u,) for u in asked * 3], "url string")
    found = warc.read_records(warc.lookup(urls, out), out, payload=True).collect()
    keys = {warc.url_key(u) for u in asked}
    wanted = [r for r in rows if warc.url_key(r[1]) in keys]
    assert sorted(str(r.page_id) for r in found) == sorted(str(r[0]) for r in wanted)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], set()).add((r[2] or "").encode())
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert bytes(r.payload) in texts[int(r.page_id) if r.page_id else None]
            assert r.payload_digest == warc.payload_digest(bytes(r.payload))


@pytest.mark.parametrize(
    "url, wanted",
    [
        ("https://www.Example.com/a?b=1#c", "com,example,www)/a?b=1"),
        ("http://example.com:80", "com,example)/"),
        ("http://example.com:8080/x", "com,example:8080)/x"),
        ("http://10.0.0.1/x", "10,0,0,1)/x"),
        ("no host", ")/no%20host"),
        ("http://[bad", ")/http://[bad"),
        (None, "-"),
    ],
)
def test_url_keys(url, wanted):
    assert warc.url_key(url) == wanted


def test_record_ids_are_taken_back():
    for page_id in (None, "", "-", "5", "-5", "a:b", "ä>\r\n"):
        assert warc.page_of(warc.record_id(page_id, "D")) == page_id


def test_small_payloads_are_all_responses_and_damage_is_noticed(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    found = {r.page_id: r.refers_to for r in warc.with_first(made(spark, rows), least=3).collect()}
    assert found == {"1": None, "2": None, "3": None, "4": "3"}
    whole = warc.record("1", "u", b"payload", None, "d").replace(b"payload", b"damaged")
    with pytest.raises(ValueError):
        warc.parsed(gzip.compress(whole))


def test_empty_table(spark, tmp_path):
    pages = made(spark, []).limit(0)
    out = str(tmp_path / "archive")
    assert warc.archive(spark, pages, out)["files"] == []
    assert warc.read_records(warc.lookup(pages, out), out).count() == 0
