"""SimHash fingerprints and their near-duplicate groups by a Gray-order index.

Distinct fingerprints are indexed, so exact copies cost one entry.  The upper
level of the index are masked bit patterns: the 64 bits are cut into blocks, and
two fingerprints within the distance agree on enough whole blocks to share the
pattern of at least one mask (pigeonhole).  A pattern is the shuffle key, so no
task ever sees all fingerprints.  Under a pattern the fingerprints stand in Gray
order, where neighbours differ in few bits, and runs of them are factored into
nodes that keep the bits all members share.  A search descends pairs of nodes,
adds up the differences of shared bits and prunes the pair as soon as these
exceed the distance, or when both nodes are already in one component.

Each pattern returns links from its components' least members to the others,
not pairs, so a group of n near copies costs n links and not n squared.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER_BYTES, same, stored, words_of
from riskloom.llm.components import components

SEED = 42
BITS = 64
FAN = 8
# A pattern should hold this many fingerprints on average; more blocks must agree beyond.
PER_PATTERN = 64
# Node pairs that are looked at together.
STEP = 1 << 18
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hashes of a whole text's shingles, repeats included; none without words."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words).translate(LOWER_BYTES)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: max(1, len(words) - width + 1)].tolist()
    ends = (ends - 1)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], dtype="<u8")


def fingerprint(text: str | None, width: int = 4) -> int:
    """Unsigned fingerprint of a whole text; 0 without words."""
    return fingerprint_of(shingle_hashes(text, width))


def fingerprint_of(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        raw = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, width: int = 4, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, fp) for every row, with other keys if asked; fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keys), pa.array(prints.view(np.int64))], [*keys, "fp"]
            )

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, "text").mapInArrow(run, f"{kinds}, fp long")


def block_masks(distance: int, agree: int) -> list[int]:
    """Signed masks such that values within ``distance`` agree on one of them."""
    count = distance + agree
    edges = [BITS * k // count for k in range(count + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [
        int(np.uint64(sum(chosen)).view(np.int64)) for chosen in combinations(blocks, agree)
    ]


def agreeing_blocks(n: int, distance: int) -> int:
    """Fewest agreeing blocks that leave about PER_PATTERN values to a pattern."""
    agree = 1
    while agree < 4 and n > PER_PATTERN * 2 ** (BITS * agree // (distance + agree)):
        agree += 1
    return agree


def gray_rank(value):
    """Place of a value (a column) in Gray order, as a signed long that sorts rightly."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value.bitwiseXOR(F.lit(-(2**63)))


def _close(a, b, mask, distance):
    return np.bitwise_count((a ^ b) & mask) <= distance


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: the least member of each component."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        for ends in (label[a], label[b]):  # hook roots, then shorten the paths
            np.minimum.at(label, ends, low)
        while (label[label] != label).any():
            label = label[label]


def _tree(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the leaves up: shared bits' pattern and their mask."""
    ones, zeros = values.copy(), values.copy()
    levels = [(values, np.full(len(values), ALL))]
    while len(ones) > FAN:
        at = np.arange(0, len(ones), FAN)
        ones, zeros = np.bitwise_or.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
        shared = ~(ones ^ zeros)
        levels.append((zeros & shared, shared))
    return levels


def _uniform(label: np.ndarray, levels: int) -> list[np.ndarray]:
    """For each level the component of a node's members, or -1 if there are several."""
    low = high = label
    out = [label]
    for _ in range(levels - 1):
        at = np.arange(0, len(low), FAN)
        low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        out.append(np.where(low == high, low, -1))
    return out


def components_in_order(values: np.ndarray, distance: int) -> np.ndarray:
    """Component of each value (unsigned, in Gray order): the place of its first member."""
    label = np.arange(len(values))
    near = np.flatnonzero(_close(values[:-1], values[1:], ALL, distance))
    label = _join_labels(label, near, near + 1)
    levels = _tree(values)
    top = np.arange(len(levels[-1][0]))
    first, second = np.triu_indices(len(top))
    stack = [(len(levels) - 1, first, second)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > STEP:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        pattern, shared = levels[level]
        inside = _uniform(label, level + 1)[level]
        wanted = _close(pattern[a], pattern[b], shared[a] & shared[b], distance)
        wanted &= (inside[a] != inside[b]) | (inside[a] < 0)
        a, b = a[wanted], b[wanted]
        if not level:
            label = _join_labels(label, a, b)
            continue
        size = len(levels[level - 1][0])
        steps = np.arange(FAN)
        a = (a[:, None, None] * FAN + steps[None, :, None] + 0 * steps).ravel()
        b = (b[:, None, None] * FAN + steps[None, None, :] + 0 * steps[:, None]).ravel()
        real = (a < size) & (b < size) & ((a < b) if level == 1 else (a <= b))
        a, b = a[real], b[real]
        for at in range(0, len(a), STEP):
            stack.append((level - 1, a[at : at + STEP], b[at : at + STEP]))
    return label


def _small_groups(group: np.ndarray, values: np.ndarray, distance: int) -> np.ndarray:
    """Labels for many short groups at once: each value against the k-th next one."""
    firsts, seconds = [], []
    for k in range(1, len(values)):
        same = np.flatnonzero(group[k:] == group[:-k])
        if not len(same):
            break
        hit = same[_close(values[same], values[same + k], ALL, distance)]
        firsts.append(hit)
        seconds.append(hit + k)
    label = np.arange(len(values))
    if not firsts:
        return label
    return _join_labels(label, np.concatenate(firsts), np.concatenate(seconds))


def _links_of(group: np.ndarray, values: np.ndarray, distance: int) -> tuple:
    """Links (first member, member) of the components inside each of whole groups."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    label = np.arange(len(values))
    size_of = np.repeat(sizes, sizes)
    short = np.flatnonzero((size_of > 1) & (size_of <= PER_PATTERN))
    if len(short):
        label[short] = short[_small_groups(group[short], values[short], distance)]
    for at, n in zip(starts[sizes > PER_PATTERN], sizes[sizes > PER_PATTERN]):
        label[at : at + n] = at + components_in_order(values[at : at + n], distance)
    member = np.flatnonzero(label != np.arange(len(label)))
    return values[label[member]], values[member]


def links(prints: DataFrame, distance: int = 4, agree: int | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``distance``.

    ``prints`` has one row per distinct fingerprint in ``fp``.
    """
    if agree is None:
        agree = agreeing_blocks(prints.count(), distance)
    masks = block_masks(distance, agree)
    entries = prints.select(
        "fp", F.posexplode(F.array([F.lit(m) for m in masks])).alias("mask", "bits")
    ).select(
        F.col("mask"), F.col("fp").bitwiseAND(F.col("bits")).alias("key"),
        gray_rank(F.col("fp")).alias("rank"), "fp",
    )

    def run(batches):
        held: list[np.ndarray] = []
        last = None
        for batch in batches:
            mask, key, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp"))
            if not len(fp):
                continue
            table = np.stack([mask.astype(np.int64), key, fp])
            # The last group may go on in the next batch.
            new = np.flatnonzero((table[:2, 1:] != table[:2, :-1]).any(axis=0)) + 1
            cut = int(new[-1]) if len(new) else 0
            if last is not None and not (table[:2, 0] == last).all():
                yield from emit(held)
                held = []
            if cut:
                yield from emit([*held, table[:, :cut]])
                held = []
            held.append(table[:, cut:])
            last = table[:2, -1].copy()
        yield from emit(held)

    def emit(parts):
        if not parts:
            return
        table = np.concatenate(parts, axis=1)
        group = np.cumsum(
            np.r_[0, (table[:2, 1:] != table[:2, :-1]).any(axis=0)].astype(np.int64)
        )
        a, b = _links_of(group, table[2].view(np.uint64), distance)
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

    return (
        entries.repartition("mask", "key")
        .sortWithinPartitions("mask", "key", "rank")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def _rooted(distinct: DataFrame, distance: int) -> DataFrame:
    """Distinct fingerprints with ``root``, the least one of their component."""
    roots = components(links(distinct.select("fp"), distance))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Fingerprints at ``distance`` or fewer bits link; component_id is the smallest
    doc_id that links reach.  Null and empty texts have fingerprint zero and link
    as any other.  Rows that repeat a doc_id each get a row; null ids are in no
    minimum, so a group of null ids only has a null component_id.
    """
    prints = stored(with_fingerprint(docs, width), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct")
    rooted = _rooted(distinct, distance)
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")
