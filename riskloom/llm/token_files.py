"""Token ids as flat binary files with 64-bit offsets, to be memory-mapped.

A folder holds, per part of the documents in doc_id order,

    part-00007.bin   the ids of its documents, one after the other, little-endian
                     unsigned integers of 16 or 32 bits as the vocabulary needs
    part-00007.off   n + 1 unsigned 64-bit numbers: where each document begins in
                     the part, in ids, and where the last one ends
    part-00007.doc   n signed 64-bit doc_ids (NO_ID where there is none)

and index.json: the width of an id, and for each part its base (ids of all parts
before it), the number of documents before it, and its own sizes.  A document's
place in the corpus is the base of its part plus its offset.  Bases are prefix
sums over the parts' totals, a few numbers per file.

Each file is written by one task under a name of its attempt and then renamed,
so a lost executor or a repeated task leaves whole files only.  Files are
written and read through the file system that their URI names; on a mounted
file system they are memory-mapped.

Null and empty texts have no ids but the end mark.  Rows stand in the order of
doc_id, null first, and of the text's hash where ids repeat.  Ids are whole numbers of
64 bits at most; the ids of any other kind have no place in the format and are refused.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from operator import concat
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

NO_ID = -(2**63)
REMEMBERED = 1 << 18
JOINED = 512
BLOCK = 20_000


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class WordEncoder:
    """Ids of words as bytes, each distinct word encoded once.

    The tokenizer drops white space and no token or special string spans it, so
    a text's ids are those of its words one after the other.  A run of Latin
    letters with punctuation behind it is two units of the tokenizer's own
    splitting, which lower-cases letters; runs are encoded many at a time and
    told apart by the tokens that end a word.  Any other word is encoded whole.
    """

    # A line's run and its punctuation, or any other line as a whole.
    PLAIN = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|(.+))$", re.M)
    ENDING = "</w>"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.ends = np.zeros(size, dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(self.ENDING)]] = True
        self.known: dict[bytes, bytes] = {}
        self.units: dict[str, bytes] = {"": b""}

    def _each(self, words: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in encoded]

    def _learn_units(self, units: list[str]) -> None:
        width = np.dtype(self.kind).itemsize
        for at in range(0, len(units), JOINED):
            part = units[at : at + JOINED]
            ids = self._each([" ".join(part)])[0]
            stops = (width * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(part):
                data = ids.tobytes()
                each = [data[a:b] for a, b in zip([0, *stops], stops)]
            else:
                each = [e.tobytes() for e in self._each(part)]
            self.units.update(zip(part, each))

    def learn(self, texts: list[list[bytes]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.units) > 2 * REMEMBERED:
            self.units = {"": b""}
        new = list(set().union(*texts).difference(self.known))
        if not new:
            return
        # No word has a line's end in it, so one pass over all lines takes them apart.
        parts = self.PLAIN.findall(b"\n".join(new).decode())
        plain = [w for w, p in zip(new, parts) if p[0]]
        runs = "\n".join([p[0] for p in parts if p[0]]).lower().split("\n") if plain else []
        rests = [p[1] for p in parts if p[0]]
        self._learn_units(list(set(runs).union(rests).difference(self.units)))
        of = self.units.__getitem__
        self.known.update(zip(plain, map(concat, map(of, runs), map(of, rests))))
        others = [w for w, p in zip(new, parts) if not p[0]]
        for at in range(0, len(others), JOINED):
            part = others[at : at + JOINED]
            self.known.update(zip(part, [e.tobytes() for e in self._each([w.decode() for w in part])]))

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder for all tasks that a worker runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, end_id: int) -> dict:
    """Encodes the texts, writes the files below ``out`` and returns the index."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise ValueError("token files need doc_ids that are whole numbers")

    def write(batches):
        encoder = encoder_of(tokenizer_path)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        width = len(end)
        fs, folder = _place(out)
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:05d}"
        attempt = f"{name}-{uuid.uuid4().hex}"
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        stream = None
        for batch in batches:
            if not batch.num_rows:
                continue
            stream = stream or fs.open_output_stream(f"{attempt}.bin")
            for at in range(0, batch.num_rows, 256):
                texts = batch.column("text").slice(at, 256).to_pylist()
                words = [(t or "").encode("utf-8", "replace").split() for t in texts]
                encoder.learn(words)
                encoded = [encoder.encode(w) + end for w in words]
                stream.write(b"".join(encoded))
                lengths.append(np.array([len(e) // width for e in encoded], dtype=np.uint64))
            ids.append(batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy())
        if stream is None:
            return
        stream.close()
        counts = np.concatenate(lengths)
        offsets = np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts, dtype=np.uint64)])
        for ending, data in (("off", offsets.astype("<u8")), ("doc", np.concatenate(ids).astype("<i8"))):
            with fs.open_output_stream(f"{attempt}.{ending}") as file:
                file.write(data.tobytes())
        for ending in ("off", "doc", "bin"):
            fs.move(f"{attempt}.{ending}", f"{name}.{ending}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([len(counts)]), pa.array([int(offsets[-1])]), pa.array([8 * width])],
            ["part", "n_docs", "n_ids", "bits"],
        )

    fs, folder = _place(out)
    fs.create_dir(folder)
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
        .repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h")
    )
    written = ordered.mapInArrow(write, "part long, n_docs long, n_ids long, bits long")
    index = {"bits": None, "parts": []}
    base = first = 0
    for row in sorted(written.collect()):  # one row per file
        index["bits"] = row.bits
        index["parts"].append(
            {"name": f"part-{row.part:05d}", "base": base, "first": first, "n_docs": row.n_docs, "n_ids": row.n_ids}
        )
        base, first = base + row.n_ids, first + row.n_docs
    with fs.open_output_stream(f"{folder}/index.json") as file:
        file.write(json.dumps(index).encode())
    return index


def read_index(out: str) -> dict:
    fs, folder = _place(out)
    with fs.open_input_file(f"{folder}/index.json") as file:
        return json.loads(file.read())


class Part:
    """The arrays of one part; mapped where its file system is mounted."""

    def __init__(self, out: str, name: str, kind: str):
        self.uri, self.name, self.kind = out, name, kind
        self.mounted = urlparse(out).scheme in ("", "file")

    def array(self, ending: str, kind: str, start: int, stop: int) -> np.ndarray:
        fs, folder = _place(self.uri)
        path, width = f"{folder}/{self.name}.{ending}", np.dtype(kind).itemsize
        if self.mounted:
            return np.memmap(path, dtype=kind, mode="r")[start:stop]
        with fs.open_input_file(path) as file:
            return np.frombuffer(file.read_at((stop - start) * width, start * width), dtype=kind)

    def offsets(self, start: int, stop: int) -> np.ndarray:
        return self.array("off", "<u8", start, stop + 1).astype(np.int64)

    def docs(self, start: int, stop: int) -> np.ndarray:
        return self.array("doc", "<i8", start, stop)

    def ids(self, start: int, stop: int) -> np.ndarray:
        return self.array("bin", self.kind, start, stop)


def document_ids(out: str, number: int, index: dict | None = None) -> np.ndarray:
    """Ids of the document that stands at ``number`` in the order of the files."""
    index = index or read_index(out)
    for part in index["parts"]:
        if part["first"] <= number < part["first"] + part["n_docs"]:
            files, at = Part(out, part["name"], f"<u{index['bits'] // 8}"), number - part["first"]
            start, stop = files.offsets(at, at + 1)
            return files.ids(start, stop)
    raise IndexError(number)


def read_token_files(spark: SparkSession, out: str, per_block) -> DataFrame:
    """Reads the files in blocks of documents, spread over tasks.

    ``per_block`` is (schema, function); the function takes doc_ids, global
    starts, counts and the list of id arrays, and returns columns.
    """
    index = read_index(out)
    kind = f"<u{(index['bits'] or 16) // 8}"
    schema, figures = per_block
    blocks = [
        (p["name"], p["base"], at, min(at + BLOCK, p["n_docs"]))
        for p in index["parts"] for at in range(0, p["n_docs"], BLOCK)
    ]

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files = Part(out, row["name"], kind)
                offsets = files.offsets(row["start"], row["stop"])
                ids = files.ids(int(offsets[0]), int(offsets[-1]))
                cuts = offsets - offsets[0]
                each = [ids[s:e] for s, e in zip(cuts[:-1], cuts[1:])]
                doc = files.docs(row["start"], row["stop"])
                columns = figures(doc, row["base"] + offsets[:-1], np.diff(offsets), each)
                doc = pa.array(doc, mask=np.asarray(doc) == NO_ID)
                yield pa.RecordBatch.from_arrays([doc, *columns.values()], ["doc_id", *columns])

    frame = spark.createDataFrame(blocks, "name string, base long, start long, stop long")
    return frame.repartition(max(1, len(blocks)), "name", "start").mapInArrow(read, f"doc_id long, {schema}")


def document_figures():
    """start, n_tokens and a check sum of the ids as 32-bit integers."""
    def figures(doc, starts, counts, ids):
        sums = [zlib.crc32(np.asarray(i).astype("<u4").tobytes()) for i in ids]
        return {
            "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
            "ids_crc32": pa.array(sums, pa.int64()),
        }

    return "start long, n_tokens long, ids_crc32 long", figures
