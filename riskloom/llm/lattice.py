"""Piece encoding of texts by a relational lattice.

A text is cut into units between any two characters that stand side by side in
no piece, as a word's last letter and the blank or comma behind it.  No piece
crosses a unit's border, so the best path of a text is the best paths of its
units, one after the other, and only distinct units are solved.  Their substrings of up to the longest piece's length are exploded and
equi-joined to the piece table, the matches are grouped by unit as the edges of
its lattice, and a higher-order aggregate folds them into the best path (highest
sum of scores, on a tie the path whose last piece is longer).  A character that
is no piece becomes its UTF-8 bytes' pieces.

The solved units are stored.  The most frequent ones, at most HEAD by a count
threshold, go to all tasks; texts need no shuffle for them.  The others are
joined by unit, once per row that has them, so a frequent unit is never a
join key.  Units stay Arrow arrays in the tasks, never Python strings one by one.  The texts that meet them are shuffled compressed.  One task step makes ids
and, if asked, the texts that they decode to.

A unit of more than UNIT code points is cut too, at borders of its best path, which
one pass over the unit finds where its text is; so the parts' best paths are still
those of the whole text.  Null and empty texts have no pieces.  The
sign for a blank (U+2581) in a text is read back as a blank.  A row is known by a
hash of its doc_id and text, so rows that repeat an id or have none are encoded each by
their own text, and equal rows share their look-ups.  Columns that have
the name of a result column are replaced.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import shuffles_dropped, slices, small_batches, stored, without

BLANK = "▁"
UNIT = 256
HEAD = 1 << 18
FLUSH = 1 << 18
# Bytes of text that are cut at a time, and that are looked up at a time.
SLICE, PART = 1 << 17, 1 << 21
# Long units whose cuts a task remembers.
REMEMBERED = 1 << 12
# A model with more pieces than this is refused: the piece table goes to all tasks.
MOST_PIECES = 1 << 20
UNKNOWN_PENALTY = 10.0
RESULT = ("ids", "n_tokens")


@dataclass(frozen=True)
class Model:
    """What the lattice needs of a piece model."""

    pieces: list[tuple[str, int, float]]
    texts: list[str]
    byte_ids: list[int]
    unknown: int
    unknown_score: float
    longest: int
    neighbours: frozenset[str]


def load_model(path: str) -> Model:
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    size = own.get_piece_size()
    if size > MOST_PIECES:
        raise ValueError(f"{size} pieces, at most {MOST_PIECES} are sent to all tasks")
    texts = [own.id_to_piece(i) for i in range(size)]
    plain = [i for i in range(size) if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i) or own.is_unused(i))]
    pieces = [(texts[i], i, own.get_score(i)) for i in plain]
    at = {texts[i]: i for i in range(size) if own.is_byte(i)}
    return Model(
        pieces,
        texts,
        [at[f"<0x{b:02X}>"] for b in range(256)] if at else [],
        own.unk_id(),
        min(s for _, _, s in pieces) - UNKNOWN_PENALTY,
        max(len(p) for p, _, _ in pieces),
        frozenset(a + b for p, _, _ in pieces for a, b in zip(p, p[1:])),
    )


class Units:
    """Cuts texts into units, by a table of the characters that pieces have side by side."""

    def __init__(self, model: Model):
        signs = sorted({c for pair in model.neighbours for c in pair})
        # Number 0 stands for all other characters, which stand beside none.
        self.number = np.zeros(0x110000, dtype=np.uint16)
        self.number[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.width = len(signs) + 1
        self.beside = np.zeros(self.width * self.width, dtype=bool)
        for a, b in model.neighbours:
            self.beside[self.number[ord(a)].astype(np.int64) * self.width + self.number[ord(b)]] = True
        self.model = model
        self.scores: dict[str, float] = {}
        self.memo: dict[str, np.ndarray] = {}

    def inner_cuts(self, unit: str) -> np.ndarray:
        """Places in a long unit at which its best path has a border, each the first one
        UNIT or more after the last.  Between them the best path is that of the part."""
        if unit in self.memo:
            return self.memo[unit]
        self.scores = self.scores or {p: s for p, _, s in self.model.pieces}
        find, longest, unknown = self.scores.get, self.model.longest, self.model.unknown_score
        best, last = array("d", [0.0]), array("i", [0])
        for stop in range(1, len(unit) + 1):
            top, first = -np.inf, stop - 1
            for start in range(max(0, stop - longest), stop):
                score = find(unit[start:stop])
                if score is None:
                    if start < stop - 1:
                        continue
                    score = unknown
                if best[start] + score > top:
                    top, first = best[start] + score, start
            best.append(top)
            last.append(first)
        borders, at = [], last[len(unit)]
        while at:
            borders.append(at)
            at = last[at]
        cuts = []
        for at in reversed(borders):
            if at - (cuts[-1] if cuts else 0) >= UNIT:
                cuts.append(at)
        if len(self.memo) > REMEMBERED:
            self.memo.clear()
        found = np.array(cuts, dtype=np.int64)
        if len(unit) <= 16 * UNIT:
            self.memo[unit] = found
        return found

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of texts, one after the other, and the number of each text's units."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), dtype=np.int64)
        kept = np.flatnonzero(sizes)
        if not len(kept):
            return pa.array([], pa.large_string()), counts
        texts = pc.replace_substring(texts.take(pa.array(kept)).cast(pa.large_string()), " ", BLANK)
        blank, nothing = (pa.scalar(sign, pa.large_string()) for sign in (BLANK, ""))
        texts = pc.binary_join_element_wise(blank, texts, nothing)
        _, borders, data = texts.buffers()
        borders = np.frombuffer(borders, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        text = data[borders[0] : borders[-1]].to_pybytes().decode()
        signs = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        number = self.number[signs].astype(np.int32)
        first = np.ones(len(signs), dtype=bool)
        np.logical_not(self.beside[number[:-1] * self.width + number[1:]], out=first[1:])
        # Where each character begins in bytes.
        width = np.ones(len(signs), dtype=np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width += signs >= least
        at = np.zeros(len(signs) + 1, dtype=np.int64)
        np.cumsum(width, out=at[1:])
        heads = np.searchsorted(at, borders[:-1] - borders[0])
        first[heads] = True
        starts = np.flatnonzero(first)
        stops = np.append(starts[1:], len(signs))
        long = np.flatnonzero(stops - starts > UNIT)
        if len(long):
            inner = [starts[k] + self.inner_cuts(text[starts[k] : stops[k]]) for k in long]
            starts = np.sort(np.concatenate([starts, *inner]))
        counts[kept] = np.diff(np.append(np.searchsorted(starts, heads), len(starts)))
        places = at[np.append(starts, len(signs))] + borders[0]
        return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), data]), counts

    def of(self, text: str | None) -> list[str]:
        return self.cut(pa.array([text], pa.string()))[0].to_pylist()


def parts_of(batch: pa.RecordBatch, size: str) -> list[pa.RecordBatch]:
    """A batch in parts of some PART bytes of text, or one row; the texts' sizes are in a column."""
    size = batch.column(size)
    size = pc.fill_null(size if pa.types.is_integer(size.type) else pc.binary_length(size), 0)
    part = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64) // PART
    borders = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(borders, borders[1:]) if b > a]


def spans_of(texts: pa.Array) -> list[pa.Array]:
    """An array of texts in parts of some SLICE bytes, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = ends // SLICE
    borders = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(borders, borders[1:]) if b > a]


def _bytes_of(model: Model) -> list[bytes]:
    """The bytes that each id stands for."""
    out = [text.encode() for text in model.texts]
    for b, i in enumerate(model.byte_ids):
        out[i] = bytes([b])
    return out


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace").replace(BLANK, " ")[1:]


def decode(ids: list[int], model: Model) -> str:
    """The text of a list of ids."""
    return _text(b"".join(map(_bytes_of(model).__getitem__, ids)))


def counted(batches, model: Model):
    """Batches of (unit, n): how often each unit stands in the texts of Arrow batches.
    The units stay Arrow arrays; some FLUSH different ones are held."""
    units, seen, rows = Units(model), [], 0
    for batch in batches:
        for part in parts_of(batch, "text"):
            cuts = [units.cut(texts)[0] for texts in spans_of(part.column("text"))]
            found = pc.value_counts(pa.chunked_array(cuts, pa.large_string()))
            seen.append((found.field("values"), found.field("counts").to_numpy()))
            rows += len(found)
            if rows > FLUSH:
                seen = [_summed(seen)]
                rows = len(seen[0][0])
                if rows > FLUSH // 2:
                    yield from _told(*seen[0])
                    seen, rows = [], 0
    if seen:
        yield from _told(*_summed(seen))


def _summed(counts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    found = pa.concat_arrays([unit for unit, _ in counts]).dictionary_encode()
    n = np.zeros(len(found.dictionary), dtype=np.int64)
    np.add.at(n, found.indices.to_numpy(), np.concatenate([n for _, n in counts]))
    return found.dictionary, n


def _told(units: pa.Array, n: np.ndarray):
    table = pa.table({"unit": units.cast(pa.string()), "n": pa.array(n)})
    yield from table.to_batches(1 << 16)


def unit_counts(docs: DataFrame, model: Model) -> DataFrame:
    """(unit, n): how often each unit stands in the texts; summed in tasks first."""
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A fixed number: units are short, but each one stands for many edges.
    return (
        docs.select("text").mapInArrow(lambda batches: counted(batches, model), "unit string, n long")
        .repartition(spread, "unit").groupBy("unit").agg(F.sum("n").alias("n"))
    )


def edges(units: DataFrame, model: Model) -> DataFrame:
    """One row per unit with its lattice's edges.

    Every character has an edge: its own piece, or one whose id is -1 - start.
    """
    spark = units.sparkSession
    pieces = spark.createDataFrame(model.pieces, "piece string, id int, score double")
    spans = (
        units.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)))
        .withColumn(
            "size",
            F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), F.length("unit") - F.col("start")))),
        )
        .withColumn("piece", F.substr(F.col("unit"), F.col("start") + 1, F.col("size")))
    )
    # The table's size is bounded by MOST_PIECES.
    matched = spans.join(F.broadcast(pieces), "piece", "left").where("id IS NOT NULL OR size = 1")
    edge = F.struct(
        (F.col("start") + F.col("size")).alias("stop"), "start", F.coalesce("id", -1 - F.col("start")).alias("id"),
        F.coalesce("score", F.lit(model.unknown_score)).alias("score"),
    )
    return matched.groupBy("unit", "n").agg(F.collect_list(edge).alias("edges"))


def best_path(lattice: Column, size: Column) -> Column:
    """The ids of the best path's edges, in order, in a unit of so many characters."""
    # For each place the best path's score up to it, and its last edge: where that begins,
    # negative, so that of equal scores the smaller start is the larger step; and its id.
    empty = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("before"), F.lit(0).alias("id")))

    def fold(best: Column, stop: Column) -> Column:
        def to(edge: Column) -> Column:
            score = F.get(best, edge["start"])["score"] + edge["score"]
            return F.struct(score.alias("score"), (-edge["start"]).alias("before"), edge["id"].alias("id"))

        here = F.transform(F.filter(lattice, lambda edge: edge["stop"] == stop), to)
        return F.concat(best, F.array(F.array_max(here)))

    def walk(best: Column) -> Column:
        back = F.struct((F.size(best) - 1).alias("at"), F.array().cast("array<int>").alias("path"))

        def to(state: Column, _: Column) -> Column:
            last = F.get(best, state["at"])
            return F.when(
                state["at"] > 0,
                F.struct((-last["before"]).alias("at"), F.concat(F.array(last["id"]), state["path"]).alias("path")),
            ).otherwise(state)

        return F.aggregate(best, back, to, lambda state: state["path"])

    step = "struct<score:double,before:int,id:int>"
    return F.aggregate(F.sequence(F.lit(1), size), empty.cast(f"array<{step}>"), fold, walk)


def _ids(path: Column, unit: Column, model: Model) -> Column:
    """Ids of a path; characters that are no piece become their bytes."""
    if model.byte_ids:
        table = F.array(*[F.lit(i) for i in model.byte_ids])
        pairs = lambda c: F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit("(..)"), 1)
        bytes_of = lambda c: F.transform(pairs(c), lambda h: F.get(table, F.conv(h, 16, 10).cast("int")))
    else:
        bytes_of = lambda c: F.array(F.lit(model.unknown))
    each = lambda i: F.when(i >= 0, F.array(i)).otherwise(bytes_of(F.substr(unit, -i, F.lit(1))))
    return F.when(F.exists(path, lambda i: i < 0), F.flatten(F.transform(path, each))).otherwise(path)


def solved_units(docs: DataFrame, model: Model) -> DataFrame:
    """The stored dictionary of all distinct units: unit, n, ids."""
    found = edges(unit_counts(docs, model), model).select("unit", "n", best_path(F.col("edges"), F.length("unit")).alias("path"))
    with shuffles_dropped(docs.sparkSession):
        solved = found.select("unit", "n", _ids(F.col("path"), F.col("unit"), model).alias("ids"))
        return stored(solved, "units", compression="zstd")


def _grade(n: Column) -> Column:
    return F.floor(F.log2(n) * 8).cast("int")


def _split(solved: DataFrame) -> tuple[pa.Table, DataFrame]:
    """The most frequent units, HEAD at most, and a frame of the others.

    The counts of some 500 grades of frequency come to the driver, and the
    frequent units, whose number HEAD bounds.
    """
    grades = solved.groupBy(_grade(F.col("n")).alias("grade")).count().collect()
    total, least = 0, 1 << 30
    for row in sorted(grades, key=lambda r: -r.grade):
        total += row["count"]
        if total > HEAD:
            break
        least = row.grade
    grade = _grade(F.col("n"))
    return solved.where(grade >= least).drop("n").toArrow(), solved.where(grade < least).drop("n")


class Ids:
    """The ids of units in one array; a unit's number says where."""

    def __init__(self, units: pa.Array, ids: pa.Array):
        # The type that cut() gives: a search must not cast them each time.
        self.units = units.cast(pa.large_string())
        self.flat = ids.flatten().to_numpy().astype(np.int32)
        self.starts = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(), dtype=np.int64)])

    def numbers(self, units: list[pa.Array]) -> list[np.ndarray]:
        """The number of each unit in each array, -1 for others; what is searched is made once."""
        found = pc.index_in(pa.concat_arrays(units), value_set=self.units)
        return np.split(found.fill_null(-1).to_numpy(), np.cumsum([len(u) for u in units])[:-1])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered units, one after the other, and how many each one has."""
        sizes = (self.starts[1:] - self.starts[:-1])[numbers]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[places], sizes


def _digits(model: Model) -> int:
    """Hexadecimal digits of a stored number: 2 bytes if they hold all ids, else 4."""
    return 4 if len(model.texts) <= 1 << 16 else 8


def entry(ids: Column, model: Model) -> Column:
    """The ids of a unit and their number as bytes, to stand behind the unit's own."""
    number = lambda n: F.lpad(F.hex(n), _digits(model), "0")
    return F.unhex(F.concat(F.array_join(F.transform(ids, number), ""), number(F.size(ids))))


def read_entries(entries: pa.Array, model: Model) -> Ids:
    width = _digits(model) // 2
    units, ids, sizes = [], [], [0]
    for raw in entries.to_pylist():
        n = int.from_bytes(raw[-width:])
        at = len(raw) - width * (n + 1)
        units.append(raw[:at])
        ids.append(raw[at:-width])
        sizes.append(n)
    flat = np.frombuffer(b"".join(ids), dtype=f">u{width}").astype(np.int32)
    offsets = np.cumsum(sizes).astype(np.int32)
    names = pc.replace_substring(pa.array(units, pa.binary()).cast(pa.string()), " ", BLANK)
    return Ids(names, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))


def packed(docs: DataFrame) -> DataFrame:
    """The rows with their texts compressed, and ``__size``, the bytes of each."""
    names = docs.columns
    place = names.index("text")

    def run(batches):
        codec = pa.Codec("zstd", compression_level=5)
        for batch in batches:
            data, sizes = [], []
            for (text,) in slices([batch], "text"):
                raw = None if text is None else text.encode()
                data.append(raw and codec.compress(raw, asbytes=True))
                sizes.append(None if raw is None else len(raw))
            columns = list(batch.columns)
            columns[place] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], [*names, "__size"])

    fields = [T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in docs.schema]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("__size", T.LongType())]))


def unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows with their texts again."""
    codec = pa.Codec("zstd")
    pairs = zip(batch.column("text").to_pylist(), batch.column("__size").to_pylist())
    texts = [codec.decompress(t, n, asbytes=True).decode() if n else (None if n is None else "") for t, n in pairs]
    place = batch.schema.get_field_index("text")
    return batch.set_column(place, "text", pa.array(texts, pa.string())).drop_columns(["__size"])


def encode(docs: DataFrame, model: Model, decoded: bool = False) -> DataFrame:
    """The documents with ``ids``, the piece ids of their whole texts, n_tokens and, if
    asked, ``decoded``, the text that the ids decode to."""
    small_batches(docs.sparkSession)
    docs = without(docs, (*RESULT, "decoded") if decoded else RESULT)
    table, rest = _split(solved_units(docs, model))
    frequent = Ids(table.column("unit").combine_chunks(), table.column("ids").combine_chunks())
    head = docs.sparkSession.sparkContext.broadcast(frequent)

    def rare(batches):
        known, units = head.value, Units(model)
        for batch in batches:
            for part in parts_of(batch, "text"):
                cuts = [units.cut(texts) for texts in spans_of(part.column("text"))]
                each = [found.dictionary_encode() for found, _ in cuts]
                row = 0
                for (_, counts), own, number in zip(cuts, each, known.numbers([e.dictionary for e in each])):
                    codes = own.indices.to_numpy()
                    rows = np.repeat(np.arange(row, row + len(counts)), counts)
                    new = (number < 0)[codes]
                    pairs = np.unique(rows[new] << 32 | codes[new])
                    at = pa.array(pairs >> 32)
                    unit = own.dictionary.take(pa.array(pairs & 0xFFFFFFFF)).cast(pa.string())
                    # No unit has a blank; one takes a byte of the shuffles, its sign three.
                    unit = pc.replace_substring(unit, BLANK, " ")
                    row += len(counts)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("__row").take(at), unit], ["__row", "unit"]
                    )

    # Rows of one number share their look-ups, which a unit tells apart: so it needs not be
    # unique, and is never null, as a join and an aggregate by one key share a shuffle.
    keyed = docs.withColumn("__row", F.hash("doc_id", "text"))
    per_row = (
        keyed.select("__row", "text").mapInArrow(rare, "__row int, unit string")
        # Dealt by unit, as the join is; a row's units are distinct, equal rows repeat them.
        .repartition("unit").distinct()
        .join(rest.select(F.translate("unit", BLANK, " ").alias("unit"), entry(F.col("ids"), model).alias("entry")), "unit")
        .groupBy("__row").agg(F.collect_list(F.concat(F.encode("unit", "UTF-8"), "entry")).alias("__rare"))
    )
    joined = packed(keyed).join(per_row, "__row", "left").drop("__row")

    def assemble(batches):
        known, units = head.value, Units(model)
        bytes_of = pa.array(_bytes_of(model), pa.binary())
        for batch in batches:
            for part in parts_of(batch, "__size"):
                part = unpacked(part)
                own = read_entries(pc.list_flatten(part.column("__rare")), model)
                cuts = [units.cut(texts) for texts in spans_of(part.column("text"))]
                each = [found.dictionary_encode() for found, _ in cuts]
                names = [e.dictionary for e in each]
                values, sizes = [], [0]
                for (_, counts), code, number, other in zip(cuts, each, known.numbers(names), own.numbers(names)):
                    if (np.maximum(number, other) < 0).any():
                        raise ValueError("a unit of a text is not among the solved units")
                    # Ids by the number of each different unit first.
                    ids, n = known.of(number[number >= 0])
                    more, m = own.of(other[number < 0])
                    size = np.empty(len(number), np.int64)
                    size[number >= 0], size[number < 0] = n, m
                    start = np.empty(len(number), np.int64)
                    start[number >= 0], start[number < 0] = np.cumsum(n) - n, len(ids) + np.cumsum(m) - m
                    codes, flat = code.indices.to_numpy(), np.concatenate([ids, more])
                    long = size[codes]
                    ends = np.cumsum(long)
                    found = flat[np.repeat(start[codes] - ends + long, long) + np.arange(ends[-1] if len(ends) else 0)]
                    values.append(found)
                    sizes.append(np.diff(np.concatenate([[0], ends])[np.cumsum([0, *counts])]))
                values = np.concatenate(values)
                sizes = np.cumsum(np.concatenate([[0], *sizes[1:]])).astype(np.int32)
                table = pa.Table.from_batches([part]).drop_columns(["__rare"])
                table = table.append_column("ids", pa.ListArray.from_arrays(pa.array(sizes), pa.array(values)))
                table = table.append_column("n_tokens", pa.array(np.diff(sizes).astype(np.int64)))
                if decoded:
                    read = pc.binary_join(pa.ListArray.from_arrays(pa.array(sizes), bytes_of.take(pa.array(values))), b"")
                    table = table.append_column("decoded", pa.array(map(_text, read.to_pylist()), pa.string()))
                yield from table.to_batches()

    more = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    more += [T.StructField("decoded", T.StringType())] if decoded else []
    return joined.mapInArrow(assemble, T.StructType([*docs.schema.fields, *more]))
