"""Runs of periodic words, found by block convolutions at dyadic scales.

A run is a stretch of consecutive words of one text with smallest period q and at
least max(MIN_LENGTH, 3 q) words that no neighbouring word extends keeping period q.

At the scale B the text is cut into blocks of B words.  A run with a period in
[B, 2 B) is so long that it holds a whole block together with that block's copy q
words later.  So every block is held against the window of the words B to 2 B - 1
places on: the sum of squared differences of their word numbers,

    sum (x_i - y_i+d)^2 = sum x_i^2 + sum y_i+d^2 - 2 sum x_i y_i+d ,

is made for all distances d at once, the last term by a number-theoretic
transform modulo PRIME.  Numbers are kept so small that no sum reaches PRIME; the
result is the exact integer, and it is zero at every place where the block occurs.
(Words whose numbers agree modulo the bound may add places, never lose one.)
The smallest scale has blocks of 8 words and the distances 1 to 15, as runs have
24 words at least; blocks of more than WIDEST words are known by their first ones.

Each zero is a seed (place, distance).  It is extended both ways as far as words a
distance apart are the same, by prefix hashes, and the ends are held against the
words themselves.  Of the distances that give the same stretch the least is its
period: a stretch of three periods has no others than multiples of it.

Transforms are products with matrices of roots of unity in two steps (rows, then
columns), in floating point whose sums stay below 2^53 and so are whole numbers.
Texts are taken a few at a time, up to some number of words or one text, and blocks in groups of
bounded size, so memory is in proportion to the longest text.  No rows are shuffled.

Null and empty texts have no runs.  Every row is judged by its own text, whatever
its id.  Columns that have the name of a result column are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.common import slices, without, words_of

MIN_LENGTH = 24
EXPONENT = 3
SMALLEST = 8
WIDEST = 1 << 12
# A prime with roots of unity of all orders up to 2^20, and a generator.
PRIME, GENERATOR = 7 * 2**20 + 1, 3
# Words that are taken together, and elements of a matrix of blocks.
WORDS = 1 << 17
ELEMENTS = 1 << 18
# Seeds that are extended together.
SEEDS = 1 << 18
RESULT = ("runs", "collapsed")
RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
)


# Transforms ------------------------------------------------------------------
def reduced(values: np.ndarray) -> np.ndarray:
    """The values modulo PRIME, between -PRIME / 2 and PRIME / 2, in place."""
    times = values * (1.0 / PRIME)
    np.rint(times, out=times)
    times *= PRIME
    values -= times
    return values


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, dtype=np.int64)
    value = 1
    for k in range(count):
        out[k], value = value, value * base % PRIME
    return out


@lru_cache(maxsize=None)
def _roots(size: int, inverse: bool) -> tuple[np.ndarray, ...]:
    """Matrices of the two steps and the factors between them, for one size."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    powers = _powers(pow(root, -1, PRIME) if inverse else root, size)
    rows = 1 << ((size.bit_length()) // 2)
    columns = size // rows

    def matrix(n):
        at = np.arange(n)
        return reduced(powers[(np.outer(at, at) % n) * (size // n)].astype(float))

    between = powers[np.outer(np.arange(rows), np.arange(columns)) % size].astype(float)
    return matrix(rows), reduced(between), matrix(columns)


def transform(values: np.ndarray) -> np.ndarray:
    """The transforms of the rows; their terms stand in the order (row, column) of the steps."""
    m, size = values.shape
    left, between, right = _roots(size, False)
    cells = values.reshape(m, len(left), len(right))
    cells = reduced(np.matmul(left, cells))
    cells *= between
    return reduced(np.matmul(reduced(cells), right)).reshape(m, size)


def inverse(values: np.ndarray) -> np.ndarray:
    """What ``transform`` made the rows of."""
    m, size = values.shape
    left, between, right = _roots(size, True)
    cells = values.reshape(m, len(left), len(right))
    cells = reduced(np.matmul(cells, right))
    cells *= between
    cells = reduced(np.matmul(left, reduced(cells))).reshape(m, size)
    cells *= float(pow(size, -1, PRIME))
    return reduced(cells)


# Seeds -----------------------------------------------------------------------
def _bound(block: int) -> int:
    """Word numbers below it keep the sum over a block below PRIME."""
    return int(((PRIME - 1) // block) ** 0.5)


def zero_distances(codes: np.ndarray, places: np.ndarray, first: np.ndarray, block: int, count: int):
    """(place, distance) of the zero-mismatch occurrences of blocks of words.

    The block at each place is held against the words ``first`` to ``first + count - 1``
    places on.  ``codes`` has block + count words of any kind behind the last one.
    """
    size = 1 << (block + count - 2).bit_length()
    numbers = (codes % _bound(block)).astype(float)
    squares = np.concatenate([[0.0], np.cumsum(numbers * numbers)])
    found = [np.zeros((2, 0), dtype=np.int64)]
    group = max(1, ELEMENTS // size)
    for at in range(0, len(places), group):
        here, step = places[at : at + group], first[at : at + group]
        # The block stands backwards, so that the product has its sums at block - 1 + d.
        own = np.zeros((len(here), size))
        own[:, :block] = numbers[here[:, None] + np.arange(block - 1, -1, -1)]
        window = np.zeros((len(here), size))
        span = np.arange(block + count - 1)
        window[:, : len(span)] = numbers[(here + step)[:, None] + span]
        cross = inverse(reduced(transform(own) * transform(window)))[:, block - 1 : block - 1 + count]
        starts = (here + step)[:, None] + np.arange(count)
        sums = squares[starts + block] - squares[starts]
        sums += (squares[here + block] - squares[here])[:, None]
        sums -= 2.0 * cross
        hit, distance = np.nonzero(reduced(sums) == 0)
        found.append(np.stack([here[hit], step[hit] + distance]))
    return np.concatenate(found, axis=1)


def _blocks(starts: np.ndarray, sizes: np.ndarray, scale: int):
    """(place, first distance) of the blocks of all texts that can hold a run of the scale,
    the words of a block, and the number of distances."""
    block = min(scale, WIDEST)
    nearest = 1 if scale == SMALLEST else scale
    fit = np.where(sizes >= EXPONENT * nearest, sizes - nearest - block, -1) // scale + 1
    fit = np.maximum(fit, 0)
    number = np.arange(fit.sum()) - np.repeat(np.cumsum(fit) - fit, fit)
    places = np.repeat(starts, fit) + number * scale
    count = min(2 * scale - nearest, WIDEST)
    parts = np.arange(nearest, 2 * scale, count)
    return np.repeat(places, len(parts)), np.tile(parts, len(places)), block, count


# Extensions ------------------------------------------------------------------
class Hashes:
    """Whether two stretches of words are the same, by prefix sums modulo 2^64."""

    BASE, ONE, TWO = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

    def __init__(self, codes: np.ndarray):
        keys = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(self.BASE)
        keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(self.ONE)
        keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(self.TWO)
        keys ^= keys >> np.uint64(31)
        powers = np.full(len(codes) + 1, np.uint64(self.TWO | 1))
        powers[0] = 1
        self.powers = np.cumprod(powers)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keys * self.powers[:-1])])

    def same(self, a: np.ndarray, b: np.ndarray, size) -> np.ndarray:
        """Whether the words from a and from b on are the same; b is not before a."""
        left = (self.sums[a + size] - self.sums[a]) * self.powers[b - a]
        return left == self.sums[b + size] - self.sums[b]


def _reach(same, most: np.ndarray) -> np.ndarray:
    """The largest size, up to ``most``, up to which ``same(size, step)`` holds."""
    size = np.zeros_like(most)
    step = 1 << int(most.max(initial=0)).bit_length()
    while step:
        fits = np.flatnonzero(size + step <= most)
        fits = fits[same(fits, size[fits], step)]
        size[fits] += step
        step //= 2
    return size


def _stretches(hashes: Hashes, seeds: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(start, stop, distance) of the seeds' stretches inside of their texts [low, high)."""
    place, distance = seeds
    forward = _reach(
        lambda k, done, step: hashes.same(place[k] + done, place[k] + done + distance[k], step),
        high - place - distance,
    )
    back = _reach(
        lambda k, done, step: hashes.same(place[k] - done - step, place[k] - done - step + distance[k], step),
        place - low,
    )
    return np.stack([place - back, place + forward + distance, distance])


def _checked(codes: np.ndarray, stretch: np.ndarray) -> list[tuple[int, int, int]]:
    """The maximal stretches of the distance inside of a hashed one, by the words themselves."""
    start, stop, distance = (int(v) for v in stretch)
    differ = np.flatnonzero(codes[start : stop - distance] != codes[start + distance : stop])
    if not len(differ):
        return [(start, stop, distance)]
    cuts = [start - 1, *(start + differ).tolist(), stop - distance]
    return [(a + 1, b + distance, distance) for a, b in zip(cuts, cuts[1:])]


def runs_of(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(start, stop, period) of all runs of several texts, sorted.

    ``codes`` are word numbers of all texts, one after the other, the same for the
    same words of a text; places are places in ``codes``.
    """
    found = [np.zeros((3, 0), dtype=np.int64)]
    longest = int(sizes.max(initial=0))
    if longest < MIN_LENGTH:
        return found[0]
    hashes = Hashes(codes)
    scale = SMALLEST
    while scale == SMALLEST or EXPONENT * scale <= longest:
        places, first, block, count = _blocks(starts, sizes, scale)
        padded = np.concatenate([codes, np.zeros(2 * scale + block + count, codes.dtype)])
        seeds = zero_distances(padded, places, first, block, count)
        for at in range(0, seeds.shape[1], SEEDS):
            part = seeds[:, at : at + SEEDS]
            text = np.searchsorted(starts, part[0], side="right") - 1
            low, high = starts[text], starts[text] + sizes[text]
            inside = part[0] + part[1] + block <= high
            long = _stretches(hashes, part[:, inside], low[inside], high[inside])
            size = long[1] - long[0]
            long = long[:, size >= np.maximum(MIN_LENGTH, EXPONENT * long[2])]
            found.append(np.unique(long, axis=1))
        scale *= 2
    stretches = np.unique(np.concatenate(found, axis=1), axis=1)
    checked = [s for k in stretches.T for s in _checked(codes, k)]
    if not checked:
        return found[0]
    runs = np.unique(np.array(checked, dtype=np.int64).T, axis=1)
    runs = runs[:, runs[1] - runs[0] >= np.maximum(MIN_LENGTH, EXPONENT * runs[2])]
    # Sorted by (start, stop, period): the first of equal stretches has the least period.
    new = np.ones(runs.shape[1], dtype=bool)
    new[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    return runs[:, new]


# Texts -----------------------------------------------------------------------
def _numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, counted by first occurrence."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _results(texts: list[list[bytes]]) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed texts of some texts."""
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    codes = np.concatenate([np.zeros(0, np.int64), *map(_numbered, texts)])
    # A text without words stands where the next one begins and has no places.
    real = sizes > 0
    runs = runs_of(codes, starts[real], sizes[real])
    start, stop, period = runs
    owner = np.flatnonzero(real)[np.searchsorted(starts[real], start, side="right") - 1]
    order = np.lexsort((period, start))
    counts = np.bincount(owner, minlength=len(texts))
    spans = pa.StructArray.from_arrays(
        [pa.array(v[order]) for v in (start - starts[owner], stop - start, period)], fields=list(_SPAN)
    )
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    # A run's words behind its first period are dropped.
    marks = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, stop, -1)
    kept = np.cumsum(marks)[:-1] == 0
    collapsed = []
    for words, at in zip(texts, starts.tolist()):
        own = kept[at : at + len(words)]
        left = words if own.all() else [words[k] for k in np.flatnonzero(own)]
        collapsed.append(b" ".join(left).decode())
    return pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(collapsed, pa.string())


_SPAN = pa.struct([pa.field(n, pa.int64()) for n in ("start", "length", "period")])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The documents with ``runs``, the (start, length, period) of all runs by start and
    period, in words from 0, and ``collapsed``, the words left when each run keeps its
    first period only, joined by a blank."""
    docs = without(docs, RESULT)

    def run(batches):
        for batch in batches:
            at, held, count = 0, [], 0
            for k, (text,) in enumerate(slices([batch], "text")):
                held.append(words_of(text))
                count += len(held[-1])
                if count >= WORDS or k == batch.num_rows - 1:
                    part = batch.slice(at, len(held))
                    new = _results(held)
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *RESULT])
                    at, held, count = k + 1, [], 0

    more = [T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))
