"""WARC archives of pages, and a two-level capture index over them.

Every page is one record, a gzip member of its own, in the archive file of the task
that writes it.  Of pages with equal payloads the one with the least page_id is a
``response`` record with the payload; the others are ``revisit`` records that name
it.  Payloads of less than ``least`` bytes are all responses.

The index has two levels.  Its lines, one per record, are sorted by the URL's key
(host reversed, then the path: ``com,example)/a``) and stand in compressed blocks of
LINES lines.  A sparse directory holds the first key and the place of each block.
A search goes from the list of index files, one entry each, by bisection through the
directory of a file to the blocks that can hold a key, reads these by their byte
ranges, bisects their lines, and so knows the byte ranges of the records.

Searching is a chain of Spark steps, so one key with very many captures is spread:
sorted keys find blocks (a row each), blocks are dealt out and give captures (a row
each), and captures are dealt out by stretches of the archive files, which are read in order,
neighbours at once.

Files are named after the attempt of the task that writes them, and only files of
attempts that Spark accepted are in the index, so lost executors and repeated tasks
do no harm; what a lost attempt wrote is never read.  All files go through the file
system that the folder's URI names.

What copies share is found by the payload's SHA-256.  The HEAVY largest groups go to
all tasks; only pages outside of them are joined by the digest, so no key is hot.

A null text is an empty payload.  Null ids never are the least: such a page revisits
the least id of its group, and is a response if the group has none.  Rows that repeat
the least id of their group are all responses.  A null URL has the key ``-``.  Blanks
and control characters of a URL are read back as %XX.  Other columns are not archived.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import slices, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
END = b"\r\n"

HEAVY = 4096
LINES = 3000
LEVEL = 6
# Bytes of an archive file that are read together, and gaps that are read over.
STRETCH = 8 << 20
GAP = 1 << 16
# Rows of the result that are handed on together.
ROWS = 1000
CAPTURE = "key string, file string, at long, size long"
RECORD = (
    "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long"
)


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


# Records ---------------------------------------------------------------------
def escaped(url: str) -> str:
    """A URL on one line: blanks and control characters become %XX."""
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url)


def url_key(url: str | None) -> str:
    """The URL with its host reversed, so that keys of a domain stand together."""
    if url is None:
        return "-"
    line = escaped(url)
    try:
        parts = urlsplit(line)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return f")/{line}"
    labels = host.split(".")
    if not all(label.isdigit() for label in labels):
        labels.reverse()
    default = port in (None, {"http": 80, "https": 443}.get(parts.scheme))
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(labels)}{'' if default else f':{port}'}){parts.path or '/'}{query}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: str | None, digest: str) -> str:
    own = "-" if page_id is None else quote(page_id, safe="").replace("-", "%2D")
    return f"<urn:page:{own}:{digest}>"


def page_of(record: str) -> str | None:
    """The page_id in a record's id."""
    own = record[1:-1].split(":")[2]
    return None if own == "-" else unquote(own)


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record, uncompressed."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        VERSION,
        f"WARC-Type: {RESPONSE if refers_to is None else REVISIT}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.append(f"WARC-Target-URI: {escaped(url)}")
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*fields, "", ""]).encode("utf-8", "replace") + block + END + END


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def parsed(member: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, digest, bytes, payload) of a compressed record.

    The digest and size of a response are those of the payload as read; a revisit
    has its header's, and no payload.
    """
    data = zlib.decompress(member, 31)
    head, rest = data.split(END + END, 1)
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(END + END, 1)
    size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    own = (page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"])
    if fields["WARC-Type"] == REVISIT:
        return (*own, page_of(fields["WARC-Refers-To"]), digest, size, None)
    if payload_digest(payload) != digest or len(payload) != size:
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one that was written")
    return (*own, None, digest, size, payload)


# Writing ---------------------------------------------------------------------
def with_first(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id as a string, url, html, refers_to): the page that a row revisits, or null."""
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("_sha", F.sha2("html", 256))
    copies = rows.where(F.octet_length("html") >= least).groupBy("_sha")
    groups = stored(
        copies.agg(F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("_first")).where("_n > 1"), "copies"
    )
    heavy = groups.orderBy(F.desc("_n"), "_sha").limit(HEAVY).select("_sha", F.col("_first").alias("_heavy"), F.lit(True).alias("_is"))
    light = groups.select(F.col("_sha").alias("_key"), F.col("_first").alias("_light"))
    # At most HEAVY rows.
    known = rows.join(F.broadcast(heavy), "_sha", "left")
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    keyed = known.withColumn("_key", F.when(F.col("_is"), own).otherwise(F.col("_sha")))
    first = F.when(F.col("_is"), F.col("_heavy")).otherwise(F.col("_light"))
    refers = F.when(~first.eqNullSafe(F.col("page_id")), first)
    return keyed.join(light, "_key", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html", refers.cast("string").alias("refers_to")
    )


def write_archives(pages: DataFrame, out: str, least: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes the records below ``out`` and returns their captures: key, file, at, size."""
    def run(batches):
        fs, folder = place(out)
        name = f"pages-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        stream, at = None, 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in slices([batch], "page_id", "url", "html", "refers_to"):
                whole = record(page_id, url, html.encode("utf-8", "replace"), refers_to, date)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                stream = stream or fs.open_output_stream(f"{folder}/{name}", compression=None)
                stream.write(member)
                rows.append((url_key(url), name, at, len(member)))
                at += len(member)
            yield _batch(rows, ("key", "file", "at", "size"), (pa.string(), pa.string(), pa.int64(), pa.int64()))
        if stream:
            stream.close()

    fs, folder = place(out)
    fs.create_dir(folder)
    return stored(with_first(pages, least).mapInArrow(run, CAPTURE), "captures")


def _batch(rows, names, kinds) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


def write_index(captures: DataFrame, out: str) -> dict:
    """Writes the sorted blocks and their directories, and returns the list of index files."""
    def run(batches):
        fs, folder = place(out)
        name = f"index-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        stream, at, lines = None, 0, []
        directory: list[str] = []
        last = None

        def close(at):
            member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            packed = member.compress("".join(lines).encode()) + member.flush()
            stream.write(packed)
            directory.append(f"{lines[0].split(chr(9), 1)[0]}\t{at}\t{len(packed)}\n")
            lines.clear()
            return at + len(packed)

        for batch in batches:
            for row in slices([batch], "key", "file", "at", "size"):
                stream = stream or fs.open_output_stream(f"{folder}/{name}.blocks")
                lines.append("{}\t{}\t{}\t{}\n".format(*row))
                last = row[0]
                if len(lines) == LINES:
                    at = close(at)
        if stream is None:
            return
        if lines:
            close(at)
        stream.close()
        with fs.open_output_stream(f"{folder}/{name}.directory") as file:
            file.write("".join(directory).encode())
        first = directory[0].split("\t", 1)[0]
        yield _batch([(name, first, last)], ("name", "first", "last"), (pa.string(),) * 3)

    ordered = (
        captures.select("key", "file", "at", "size")
        .repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")
    )
    # One row per file.
    written = ordered.mapInArrow(run, "name string, first string, last string").collect()
    files = sorted((r.asDict() for r in written), key=lambda r: (r["first"].encode(), r["last"].encode()))
    index = {"files": files}
    fs, folder = place(out)
    with fs.open_output_stream(f"{folder}/index.json") as file:
        file.write(json.dumps(index).encode())
    return index


# Searching -------------------------------------------------------------------
def read_index(out: str) -> dict:
    fs, folder = place(out)
    with fs.open_input_file(f"{folder}/index.json") as file:
        return json.loads(file.read())


class Directory:
    """First keys and places of the blocks of one index file."""

    def __init__(self, out: str, name: str):
        fs, folder = place(out)
        with fs.open_input_file(f"{folder}/{name}.directory") as file:
            rows = [line.split(b"\t") for line in file.read().splitlines()]
        self.firsts = [r[0] for r in rows]
        self.places = [(int(r[1]), int(r[2])) for r in rows]

    def blocks(self, key: bytes) -> list[tuple[int, int]]:
        """Places of the blocks that can hold a key: the last one that begins before it, and those that begin with it."""
        low = max(0, bisect.bisect_left(self.firsts, key) - 1)
        return self.places[low : bisect.bisect_right(self.firsts, key)]


class Search:
    """Blocks of keys that come in sorted order: one directory at a time is held."""

    def __init__(self, out: str, index: dict):
        self.out, self.files = out, index["files"]
        self.firsts = [f["first"].encode() for f in self.files]
        self.lasts = [f["last"].encode() for f in self.files]
        self.name, self.directory = None, None

    def blocks(self, key: str):
        own = key.encode()
        low, high = bisect.bisect_left(self.lasts, own), bisect.bisect_right(self.firsts, own)
        for file in self.files[low:high]:
            if file["name"] != self.name:
                self.name, self.directory = file["name"], Directory(self.out, file["name"])
            yield from ((file["name"], at, size) for at, size in self.directory.blocks(own))


def block_lines(data: bytes) -> tuple[list[bytes], list[list[bytes]]]:
    """Keys and lines of a compressed block."""
    lines = [line.split(b"\t") for line in zlib.decompress(data, 31).splitlines()]
    return [line[0] for line in lines], lines


def lookup(urls: DataFrame, out: str, column: str = "url") -> DataFrame:
    """Captures (key, file, at, size) of all URLs of a column; each URL counts once."""
    index = read_index(out)

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for (u,) in slices([batch], column)], pa.string())], ["key"])

    def find(batches):
        search = Search(out, index)
        names, kinds = ("key", "name", "at", "size"), (pa.string(), pa.string(), pa.int64(), pa.int64())
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                for block in search.blocks(key):
                    rows.append((key, *block))
                    if len(rows) >= ROWS:
                        yield _batch(rows, names, kinds)
                        rows = []
            yield _batch(rows, names, kinds)

    def read(batches):
        fs, folder = place(out)
        names, kinds = ("key", "file", "at", "size"), (pa.string(), pa.string(), pa.int64(), pa.int64())
        file, opened, now = None, None, None
        known, lines = [], []
        for batch in batches:
            rows = []
            for key, name, at, size in slices([batch], "key", "name", "at", "size"):
                if name != opened:
                    file, opened = fs.open_input_file(f"{folder}/{name}.blocks"), name
                if (name, at) != now:
                    known, lines = block_lines(file.read_at(size, at))
                    now = (name, at)
                own = key.encode()
                for k in range(bisect.bisect_left(known, own), bisect.bisect_right(known, own)):
                    rows.append((key, lines[k][1].decode(), int(lines[k][2]), int(lines[k][3])))
                if len(rows) >= ROWS:
                    yield _batch(rows, names, kinds)
                    rows = []
            yield _batch(rows, names, kinds)

    distinct = urls.select(F.col(f"`{column}`").alias(column)).mapInArrow(keys, "key string").distinct()
    blocks = distinct.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(
        find, "key string, name string, at long, size long"
    )
    return blocks.repartition("name", "at").sortWithinPartitions("name", "at", "key").mapInArrow(read, CAPTURE)


def read_records(captures: DataFrame, out: str, payload: bool = False) -> DataFrame:
    """The records at the captures' places, with the payload of responses if asked."""
    names = [f.split()[0] for f in RECORD.split(", ")] + (["payload"] if payload else [])
    kinds = [pa.string()] * 5 + [pa.int64()] + ([pa.binary()] if payload else [])

    def spans(rows):
        """Neighbouring rows whose members are read at once."""
        held: list[tuple[str, int, int]] = []
        for row in rows:
            if held:
                file, at, size = held[-1]
                apart = row[0] != file or row[1] - at - size > GAP or row[1] + row[2] - held[0][1] > STRETCH
                if apart:
                    yield held
                    held = []
            held.append(row)
        if held:
            yield held

    def run(batches):
        fs, folder = place(out)
        opened, file = None, None
        rows, size = [], 0
        for span in spans(slices(batches, "file", "at", "size")):
            name, start, _ = span[0]
            if name != opened:
                file, opened = fs.open_input_file(f"{folder}/{name}"), name
            data = file.read_at(span[-1][1] + span[-1][2] - start, start)
            for _, at, length in span:
                found = parsed(data[at - start : at - start + length])
                rows.append(found if payload else found[:-1])
                size += len(found[-1] or b"")
                if len(rows) >= ROWS or (payload and size >= STRETCH):
                    yield _batch(rows, names, kinds)
                    rows, size = [], 0
        yield _batch(rows, names, kinds)

    dealt = captures.select("file", "at", "size").withColumn("_stretch", F.expr(f"at div {STRETCH}"))
    # A fixed number: captures are short, but each one stands for a record.
    spread = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(spread, "file", "_stretch").sortWithinPartitions("file", "at")
        .mapInArrow(run, RECORD + (", payload binary" if payload else ""))
    )


def archive(spark: SparkSession, pages: DataFrame, out: str, least: int = 0) -> dict:
    """Writes records and index of the pages below ``out``."""
    return write_index(write_archives(pages, out, least), out)
