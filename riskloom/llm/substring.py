"""Removal of passages that repeat across documents, found by difference-cover anchors.

A window is WINDOW consecutive words.  Places whose remainder modulo PERIOD is in
the difference cover are anchors: for any two places some shift below PERIOD
brings both onto the cover, so two equal windows share an aligned anchor of
WINDOW - PERIOD + 1 words inside them.  Six anchors per 31 words are hashed and
shuffled; those found in one document only are dropped.  Windows around the
others are candidates: each is hashed whole (96 bits) and goes, in a second
shuffle, to the smallest document that has it.  So runs of any length are
extended window by window without pairs of documents.

Only documents with shared anchors move with their texts: a bitmap of fixed size, which
goes to all tasks, holds a bit for the hash of each such id and keeps nearly all others
from the join.

Tasks settle what they can before a shuffle, some rows at a time: an anchor that two of their own
documents have is known to be shared, and a window is known to repeat in all of
a task's documents but the smallest.  A passage that a third of all documents
have sends one document's rows per task.  Reducers stream sorted rows and keep
one group's head, so memory is bounded however large a group is.

Null texts and texts under WINDOW words lose nothing.  Documents with a null id
have no order: nothing is removed from them or because of them.  Rows that
repeat a doc_id are documents of their own, none smaller than the other.  Ids are whole
numbers; ids of another kind are refused, as they have no order here.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import likely_in, slices, stored, words_of

WINDOW = 50
PERIOD = 31
# A difference cover, every remainder modulo 31 is a difference of two of them.
COVER = (0, 1, 3, 8, 12, 18)
ANCHOR = WINDOW - PERIOD + 1
ROWS = 1 << 17
# Rows that a task sorts together before it sends them.
HELD = 1 << 21
REMEMBERED = 1 << 17
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPANS = "array<struct<start:int,stop:int>>"


class Words(dict):
    """Hashes of words seen lately."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Polynomial hashes, modulo 2**64, of all windows of a width."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))

    def windows(self, hashes: np.ndarray, width: int) -> np.ndarray:
        n = len(hashes)
        if n < width:
            return np.zeros(0, dtype=np.uint64)
        self._powers(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.up[:n])])
        out = (sums[width:] - sums[:-width]) * self.down[: n - width + 1]
        return (out ^ (out >> np.uint64(32))) * np.uint64(BASES[0])


def _scattered(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A key that spreads rows that are already settled."""
    return ((doc.astype(np.uint64) * np.uint64(BASES[1])) ^ place.astype(np.uint64)) * np.uint64(BASES[0])


def _batches(columns: dict[str, np.ndarray]):
    n = len(next(iter(columns.values())))
    for at in range(0, n, ROWS):
        part = [pa.array(c[at : at + ROWS]) for c in columns.values()]
        yield pa.RecordBatch.from_arrays(part, list(columns))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _anchors(batches):
    words, rolling = Words(), Rolling(BASES[0])
    found: list[tuple] = []
    held = 0
    for doc, text in slices(batches, "doc_id", "text"):
        own = words_of(text)
        if len(own) < WINDOW:
            continue
        hashes = rolling.windows(words.of(own), ANCHOR)
        place = np.flatnonzero(np.isin(np.arange(len(hashes)) % PERIOD, COVER))
        found.append((hashes[place], np.full(len(place), doc, np.int64), place.astype(np.int32)))
        held += len(place)
        if held >= HELD:
            yield from _sorted_anchors(found)
            held = 0
    if found:
        yield from _sorted_anchors(found)


def _sorted_anchors(found: list[tuple]):
    """Rows of some documents' anchors; empties the list."""
    key, doc, place = (np.concatenate(c) for c in zip(*found))
    found.clear()
    order = np.lexsort((doc, key))
    key, doc, place = key[order], doc[order], place[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    first, last = doc[start], doc[start + size - 1]
    shared = np.repeat(first != last, size)
    # Other tasks learn of a shared anchor from its first row, and of the others from their rows.
    head = np.zeros(len(key), dtype=bool)
    head[start] = True
    for known, rows in ((True, shared), (False, ~shared), (False, shared & head)):
        told = _scattered(doc[rows], place[rows]) if known else key[rows]
        yield from _batches({
            "known": np.full(len(told), known), "key": _signed(told), "doc_id": doc[rows],
            "place": place[rows], "local": shared[rows] & ~np.full(len(told), known),
        })


def _shared_places(batches):
    """Rows sorted by known, key, doc_id: the places of anchors that several documents have."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    key_now, doc_now, several = None, None, False
    for batch in batches:
        known, key, doc, place, local = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("known", "key", "doc_id", "place", "local")
        )
        yield from _batches({"doc_id": doc[known], "place": place[known]})
        key, doc, place, local = key[~known], doc[~known], place[~known], local[~known]
        if not len(key):
            continue
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        multiple = (doc[start] != doc[start + size - 1]) | np.logical_or.reduceat(local, start)
        if key[0] == key_now:  # the group of the last batch goes on
            multiple[0] |= several or doc[0] != doc_now
            if multiple[0]:
                for d, p in held:
                    yield from _batches({"doc_id": d, "place": p})
        if key[0] != key_now or multiple[0] or len(start) > 1:
            held = []
        rows = np.repeat(multiple, size)
        yield from _batches({"doc_id": doc[rows], "place": place[rows]})
        key_now, doc_now, several = key[-1], doc[-1], bool(multiple[-1])
        if not several:  # rows of one document, which a later batch may show to be shared
            held.append((doc[start[-1] :], place[start[-1] :]))
    # A group that ends with one document is not shared.


def _candidate_windows(n: int, places: np.ndarray) -> np.ndarray:
    """Starts of the windows of a text of n words around shared anchors."""
    change = np.zeros(n + 2, dtype=np.int64)
    np.add.at(change, np.maximum(places - (WINDOW - ANCHOR), 0), 1)
    np.add.at(change, np.minimum(places, n - WINDOW) + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: n - WINDOW + 1] > 0)


class Windows:
    """96-bit hashes of all windows of a text."""

    def __init__(self):
        self.words, self.rolling = Words(), [Rolling(b) for b in BASES]

    def of(self, own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        hashes = self.words.of(own)
        a, b = (r.windows(hashes, WINDOW) for r in self.rolling)
        return a, (b >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _windows(batches):
    windows = Windows()
    found: list[tuple] = []
    held = 0
    for doc, text, places in slices(batches, "doc_id", "text", "places"):
        own = words_of(text)
        if len(own) < WINDOW:
            continue
        places = np.asarray(places, dtype=np.int64)
        at = _candidate_windows(len(own), places[places <= len(own) - ANCHOR])
        a, b = windows.of(own)
        found.append((a[at], b[at], np.full(len(at), doc, np.int64), at.astype(np.int32)))
        held += len(at)
        if held >= HELD:
            yield from _sorted_windows(found)
            held = 0
    if found:
        yield from _sorted_windows(found)


def _sorted_windows(found: list[tuple]):
    """Rows of some documents' windows; empties the list."""
    a, b, doc, at = (np.concatenate(c) for c in zip(*found))
    found.clear()
    order = np.lexsort((doc, b, a))
    a, b, doc, at = a[order], b[order], doc[order], at[order]
    start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    least = np.repeat(doc[start], np.diff(np.r_[start, len(a)]))
    for known in (True, False):
        rows = (doc > least) == known
        told = _scattered(doc[rows], at[rows]) if known else a[rows]
        yield from _batches({
            "known": np.full(len(told), known), "a": _signed(told), "b": b[rows],
            "doc_id": doc[rows], "place": at[rows],
        })


def _repeats(batches):
    """Rows sorted by known, a, b, doc_id: windows that a smaller document has."""
    last = None
    for batch in batches:
        known, a, b, doc, place = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("known", "a", "b", "doc_id", "place")
        )
        yield from _batches({"doc_id": doc[known], "place": place[known], "told": b[known]})
        a, b, doc, place = a[~known], b[~known], doc[~known], place[~known]
        if not len(a):
            continue
        start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        least = doc[start]
        if last and last[:2] == (a[0], b[0]):
            least[0] = last[2]
        rows = doc > np.repeat(least, np.diff(np.r_[start, len(a)]))
        yield from _batches({"doc_id": doc[rows], "place": place[rows], "told": b[rows]})
        last = (a[-1], b[-1], least[-1])


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(batches):
    for batch in batches:
        counts, sums = [], []
        for (text,) in slices([batch], "text"):
            own = words_of(text)
            counts.append(len(own))
            sums.append(_digest(own))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.string())],
            ["doc_id", "n_words", "words_sha256"],
        )


def _cut(batches):
    windows = Windows()
    for batch in batches:
        rows = []
        repeats = batch.column("repeats")
        for k, (doc, text) in enumerate(slices([batch], "doc_id", "text")):
            own = words_of(text)
            n = len(own)
            values = repeats[k].values
            at = values.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
            told = values.field("told").to_numpy(zero_copy_only=False)
            inside = at <= n - WINDOW
            at, told = at[inside], told[inside]
            # Of rows that share an id, each takes its own windows only.
            at = at[windows.of(own)[1][at] == told] if len(at) else at
            change = np.zeros(n + 1, dtype=np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
            gone = np.cumsum(change)[:n] > 0
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False])).tolist()
            spans = [{"start": s, "stop": e} for s, e in zip(edges[::2], edges[1::2])]
            kept = [w for w, g in zip(own, gone.tolist()) if not g]
            rows.append((doc, _digest(own), int(gone.sum()), spans, _digest(kept)))
        ids, whole, removed, spans, kept = zip(*rows) if rows else ([],) * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((ids, whole, removed, spans, kept), kinds)],
            ["doc_id", "words_sha256", "n_removed", "spans", "kept_sha256"],
        )


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, words_sha256, n_removed, spans, kept_sha256), a row per row.

    ``spans`` are the word ranges [start, stop) to remove.
    """
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise ValueError("documents need doc_ids that are whole numbers")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = texts.where("doc_id IS NOT NULL")
    shared = (
        ordered.mapInArrow(_anchors, "known boolean, key long, doc_id long, place int, local boolean")
        .repartition("key").sortWithinPartitions("known", "key", "doc_id")
        .mapInArrow(_shared_places, "doc_id long, place int")
        .groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    )
    shared = stored(shared, "shared-places")
    open_docs = stored(likely_in(ordered, shared, "doc_id").join(shared, "doc_id"), "open-documents")
    repeats = (
        open_docs.mapInArrow(_windows, "known boolean, a long, b int, doc_id long, place int")
        .repartition("a", "b").sortWithinPartitions("known", "a", "b", "doc_id")
        .mapInArrow(_repeats, "doc_id long, place int, told int")
        .groupBy("doc_id").agg(F.collect_list(F.struct("place", "told")).alias("repeats"))
    )
    cut = (
        open_docs.select("doc_id", "text").join(repeats, "doc_id")
        .mapInArrow(_cut, f"doc_id long, words_sha256 string, n_removed long, spans {SPANS}, kept_sha256 string")
        .distinct()
    )
    whole = texts.mapInArrow(_whole, "doc_id long, n_words long, words_sha256 string")
    return whole.join(cut, ["doc_id", "words_sha256"], "left").select(
        "doc_id", "n_words", "words_sha256",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
        F.coalesce("kept_sha256", "words_sha256").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out of ``text``: the words that stay,
    joined by one blank.  Texts that lose nothing are returned as they are."""
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist()):
                if spans:
                    own = words_of(text)
                    for span in reversed(spans):
                        del own[span["start"] : span["stop"]]
                    text = b" ".join(own).decode()
                out.append(text)
            at = table.schema.get_field_index("text")
            table = table.set_column(at, "text", pa.array(out, pa.string())).drop_columns(["__spans"])
            yield from table.to_batches()

    found = repeated_words(docs).where("n_removed > 0").select(
        F.col("doc_id").alias("__id"), F.col("words_sha256").alias("__sha"), F.col("spans").alias("__spans")
    ).distinct()
    own_sha = F.sha2(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), 256)
    return (
        docs.join(found, (docs["doc_id"] == found["__id"]) & (own_sha == found["__sha"]), "left")
        .select(*docs.columns, "__spans")
        .mapInArrow(run, docs.schema)
    )
