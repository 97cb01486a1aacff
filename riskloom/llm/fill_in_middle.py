"""Fill-in-middle examples, cut by a learned index of the text's boundaries.

A text is cut between code points, but stands in memory as UTF-8 bytes.  Its
boundary offsets, the byte at which code point k begins, are a rising curve that
a few straight lines follow closely.  ``RankIndex`` fits such lines to all of
them: a line is kept as long as some slope leaves every offset within ERROR of
it (a cone that each offset narrows).  What the line misses at each boundary is
stored as a residual of 8 bits.  A cut is predicted by the line of its rank and
corrected by its residual, so it is exact, and the pieces are slices of bytes.

Where to cut, and in which form, follows from a keyed hash of the document's id,
so every run and every attempt of a task gives the same examples:

    plain  the text
    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle

Texts that hold one of the control strings stay plain, as do null and empty
texts.  Marks begin with the only ``<`` they have, so a mark that begins in a
piece cannot end in the next one, and ``restored`` needs the output and the form only.

A null id is hashed as an empty one; rows that repeat an id are cut at places of
the same hash.  A text is indexed in blocks of bytes, so besides the text itself
memory is a residual for each of its code points.  Columns that have the name of
a result column are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.common import slices, without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Farthest that a boundary may be from its line, in bytes; residuals are 8 bits wide.
ERROR = 100
# Bytes that are indexed together; a line ends where a block ends.
BLOCK = 1 << 20
# Boundaries that a cone takes in at once.
STEP = 1 << 12
RESULT = ("n", "form", "prefix_chars", "middle_chars", "output")


class RankIndex:
    """Byte offset of each of the n + 1 boundaries between a text's code points."""

    def __init__(self, data: bytes, error: int = ERROR, block: int = BLOCK):
        raw = np.frombuffer(data, dtype=np.uint8)
        self.error, self.size = error, len(raw)
        firsts: list[int] = []
        origins: list[int] = []
        slopes: list[float] = []
        residuals: list[np.ndarray] = []
        rank = 0
        for at in range(0, len(raw), block):
            # A code point begins at any byte but those of the form 10xxxxxx.
            offsets = at + np.flatnonzero((raw[at : at + block] & 0xC0) != 0x80)
            missed = np.empty(len(offsets), dtype=np.int8)
            start = 0
            while start < len(offsets):
                stop, slope = self._line(offsets, start)
                firsts.append(rank + start)
                origins.append(int(offsets[start]))
                slopes.append(slope)
                line = self._at(offsets[start], slope, np.arange(stop - start))
                missed[start:stop] = offsets[start:stop] - line
                start = stop
            residuals.append(missed)
            rank += len(offsets)
        self.n = rank
        self.firsts, self.origins = np.array(firsts, np.int64), np.array(origins, np.int64)
        self.slopes = np.array(slopes)
        self.residuals = np.concatenate(residuals) if residuals else np.zeros(0, np.int8)

    def _line(self, offsets: np.ndarray, start: int) -> tuple[int, float]:
        """Where the line that begins at a boundary ends, and its slope."""
        low, high, stop = 0.0, 4.0, start + 1
        while stop < len(offsets):
            some = offsets[stop : stop + STEP] - offsets[start]
            steps = np.arange(stop - start, stop - start + len(some))
            lows = np.maximum(np.maximum.accumulate((some - self.error) / steps), low)
            highs = np.minimum(np.minimum.accumulate((some + self.error) / steps), high)
            shut = np.flatnonzero(lows > highs)
            good = int(shut[0]) if len(shut) else len(some)
            if good:
                low, high = lows[good - 1], highs[good - 1]
            stop += good
            if good < len(some):
                break
        return stop, (low + high) / 2

    @staticmethod
    def _at(origin, slope, steps):
        return origin + np.floor(slope * steps).astype(np.int64)

    def offset(self, rank: int) -> int:
        """Byte at which code point ``rank`` begins; the text's size for n."""
        if rank == self.n:
            return self.size
        line = int(np.searchsorted(self.firsts, rank, side="right")) - 1
        guess = self._at(self.origins[line], self.slopes[line], rank - self.firsts[line])
        return int(guess) + int(self.residuals[rank])


def draws(doc_id, key: str = "1") -> list[int]:
    """Four numbers of 32 bits that the key and the id decide."""
    digest = hashlib.sha256(f"{key}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def example(text: str | None, doc_id, plain_from: int = 90, spm_below: int = 20, key: str = "1") -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text.

    Of 100 texts ``plain_from`` are cut, ``spm_below`` of 100 of those as spm.
    """
    data = (text or "").encode("utf-8", "replace")
    text = data.decode()
    one, two, three, four = draws(doc_id, key)
    if not data or any(m in text for m in MARKS) or three % 100 >= plain_from:
        return len(text), PLAIN, None, None, text
    index = RankIndex(data)
    first, second = sorted((one % (index.n + 1), two % (index.n + 1)))
    cut, end = index.offset(first), index.offset(second)
    prefix, middle, suffix = (p.decode() for p in (data[:cut], data[cut:end], data[end:]))
    if four % 100 < spm_below:
        return index.n, SPM, first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return index.n, PSM, first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: str, form: str) -> str:
    """The text that an example was made of."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    cut = output.index(second, len(first))
    end = output.index(MIDDLE, cut + len(second))
    one, two, middle = output[len(first) : cut], output[cut + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + two if form == PSM else two + middle + one


def fill_in_middle(docs: DataFrame, plain_from: int = 90, spm_below: int = 20, key: str = "1") -> DataFrame:
    """The documents with n, form, prefix_chars, middle_chars (null if plain) and output."""
    docs = without(docs, RESULT)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [example(t, i, plain_from, spm_below, key) for t, i in slices([part], "text", "doc_id")]
                new = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *RESULT])

    types = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    more = [T.StructField(c, t) for c, t in zip(RESULT, types)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def with_restored(examples: DataFrame) -> DataFrame:
    """The examples with ``restored``, the text rebuilt from output and form."""
    examples = without(examples, ("restored",))

    def run(batches):
        for batch in batches:
            texts = [restored(o, f) for o, f in slices([batch], "output", "form")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "restored"]
            )

    schema = T.StructType([*examples.schema.fields, T.StructField("restored", T.StringType())])
    return examples.mapInArrow(run, schema)
