"""One document of each group of near duplicates, by shingle similarity.

Groups are the components of all links between texts whose sets of shingles have a
similarity (shared of all) of at least ``similarity``.  They are found in two steps.

Cheap candidates come first and make nearly all of the groups:

    fingerprints   the Gray-order index's links (``simhash``) between fingerprints within
                   the distance
    minima         BANDS bands of WIDTH minima of the shingles' hashes; texts that agree on a
                   band are linked to the least and the greatest text that have it

The links that these leave out are found exactly, by a prefix filter: in one order of all
shingles, texts that are similar enough share one of the first few of each, so that the texts
of different groups meet at those.  Frequent shingles come last in that order, by a list of
bounded length that decides on cost only.  Texts of one group are not compared again, so a
large group of near copies costs its links and not their square.  Texts that meet make a row
only if their sketches, a bit for the parity of each class of shingles, differ in no more bits
than the texts of a link can differ in shingles, so that no link is lost by it.  They make it
at the first shingles that they share, not again where they share one of the BEFORE before it.

All candidate links then pass a sketch of the same kind with one to two bits for each shingle of
a text, so that it tells long texts apart as well.  Of links that it rules out no shingles are
sent, which take 64 bits each.  Steps are stored, and their shuffle files are dropped then.

Every candidate link that is left is checked.  Exact copies are one text from the start.  A band that very
many texts share gives two links for each of them and not all pairs; a text with very many
links is checked in parts of at most PART links, to each of which its shingles are sent once.
Nothing is gathered per group.

Shingles are compared by hashes of 64 bits.  Texts without words have no shingles and are
alike; those of fewer words than a shingle have one.  A row is known by its doc_id and its
text's hash, so rows of different groups stay apart whatever their ids.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import likely_in, shuffles_dropped, slices, stored
from riskloom.llm.components import components
from riskloom.llm.simhash import fingerprint_of, links, shingle_hashes

BANDS, WIDTH = 16, 6
PART = 1000
# Odd factors and shifts of the hash functions, from a rule.
_FACTORS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) for k in range(BANDS * WIDTH)], dtype=np.uint64)
_SHIFT = np.uint64(29)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
STEP = 1 << 12
# Shingles that LOCAL texts share among COUNTED of a task are taken for frequent, MOST in all.
COUNTED, LOCAL, MOST = 1 << 20, 4, 1 << 17
# Words of 64 bits of a sketch of parities.
SKETCH = 8
# First shingles before a shared one that are looked at for one that is shared too.
BEFORE = 4
# Bits of the map of shared shingles for each of them, and at most (32 MB).
SHARE, MOST_SLOTS = 64, 1 << 28
_BITS = [f"b{k}" for k in range(SKETCH)]
# Texts whose prefix a task remembers to have told.
REMEMBERED = 1 << 16


def band_values(hashes: np.ndarray) -> np.ndarray:
    """A value per band of a text's minima, signed; texts that agree on all minima of a band
    agree on it.  Without shingles all are zero."""
    if not len(hashes):
        return np.zeros(BANDS, dtype=np.int64)
    least = np.full(BANDS * WIDTH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), STEP):
        mixed = hashes[at : at + STEP, None] * _FACTORS
        mixed ^= mixed >> _SHIFT
        mixed *= _MIX
        np.minimum(least, mixed.min(axis=0), out=least)
    bands = least.reshape(BANDS, WIDTH)
    value = np.zeros(BANDS, dtype=np.uint64)
    for k in range(WIDTH):
        value = (value ^ bands[:, k]) * _MIX
        value ^= value >> _SHIFT
    return value.view(np.int64)


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    """Shared of all different values of two sorted sets; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, __row, fp, bands, size, odd) of every row, of which the last are the number of
    shingles and ``odd_classes``; ``frequent`` has the shingles that several texts of a batch
    share, on the last row of the batch."""
    def run(batches):
        for batch in batches:
            prints, bands, sizes, odd, common, sets, held, seen = [], [], [], [], [], [], 0, set()
            for row, text in slices([batch], "__row", "text"):
                hashes = shingle_hashes(text, width)
                prints.append(fingerprint_of(hashes))
                hashes = np.unique(hashes)
                bands.append(band_values(hashes))
                sizes.append(len(hashes))
                odd.append(odd_classes(hashes))
                if row not in seen:
                    seen.add(row)
                    sets.append(hashes)
                    held += len(hashes)
                if held > COUNTED:
                    common.append(shared(sets))
                    sets, held = [], 0
            if sets:
                common.append(shared(sets))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            offsets = np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)
            often = np.concatenate(common) if common else np.zeros(0, np.int64)
            at = np.zeros(batch.num_rows + 1, dtype=np.int32)
            at[-1] = len(often)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("__row"),
                    pa.array(np.array(prints, dtype=np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(often)),
                    pa.array(sizes, pa.int64()), pa.array(odd, pa.binary()),
                ],
                ["doc_id", "__row", "fp", "bands", "frequent", "size", "odd"],
            )

    def shared(sets):
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        return values[counts >= LOCAL].view(np.int64)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "__row", "text").mapInArrow(
        run, f"doc_id {kind}, __row long, fp long, bands array<long>, frequent array<long>, size long, odd binary"
    )


def frequent_shingles(told: DataFrame) -> np.ndarray:
    """The MOST shingles that most batches found frequent, sorted."""
    often = told.select(F.explode("frequent").alias("token")).groupBy("token").count()
    most = often.orderBy(F.desc("count"), "token").limit(MOST).select("token").toArrow()
    return np.sort(most.column("token").to_numpy().view(np.uint64))


def among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values a sorted list has; a search for each, as the list is the longer one."""
    if not len(listed):
        return np.zeros(len(values), dtype=bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def prefix_of(hashes: np.ndarray, late: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a text's shingles, in an order that has the ``late`` ones behind: so many
    that a text which shares none of them is less similar."""
    hashes = np.unique(hashes)
    behind = among(hashes, late)
    size = len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1
    return np.concatenate([hashes[~behind], hashes[behind]])[: size if len(hashes) else 0]


def parities(hashes: np.ndarray) -> np.ndarray:
    """A bit for each class of hashes, set if a text has an odd number of the class.  The sketches
    of two sets differ in no more bits than the sets differ in members."""
    odd = np.bincount((hashes & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def odd_classes(hashes: np.ndarray) -> bytes:
    """The same for a number of classes that is a power of two, 64 at least, and one to two times
    that of the hashes."""
    classes = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Members that two sets differ in at least, from their odd classes."""
    x, y, bits = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * max(len(a), len(b))
    if len(a) < len(b):
        a, b, x, y = b, a, y, x
    while bits > 8 * len(b):
        # A class is two of twice as many.
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return (x ^ y).bit_count()


def likely_links(candidates: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The candidate links but for those that the odd classes of their texts rule out; ``texts``
    has node, size, odd."""
    ends = candidates
    for end in ("a", "b"):
        ends = ends.join(texts.select(*[F.col(c).alias(n) for c, n in (("node", end), ("size", f"size_{end}"), ("odd", f"odd_{end}"))]), end)

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("size_a", "size_b", "odd_a", "odd_b")))
            kept = [least_difference(x, y) * (1 + similarity) <= (m + n) * (1 - similarity) + 1e-6 for m, n, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    alike = F.least("size_a", "size_b") + 1e-6 >= similarity * F.greatest("size_a", "size_b")
    return ends.where(alike).mapInArrow(run, "a long, b long")


def prefixes(docs: DataFrame, late: np.ndarray, width: int, similarity: float) -> DataFrame:
    """(node, size, prefix, b0 ...) of each text: the number of its shingles, the first ones and
    its sketch of parities."""
    late = docs.sparkSession.sparkContext.broadcast(late)

    def run(batches):
        told = set()
        for batch in batches:
            if len(told) > REMEMBERED:
                told.clear()
            nodes, sizes, firsts, bits = [], [], [], []
            for node, text in slices([batch], "__row", "text"):
                if node in told:
                    continue
                told.add(node)
                hashes = np.unique(shingle_hashes(text, width))
                nodes.append(node)
                sizes.append(len(hashes))
                firsts.append(prefix_of(hashes, late.value, similarity).view(np.int64))
                bits.append(parities(hashes))
            at = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            flat = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                    *map(pa.array, np.array(bits, dtype=np.int64).reshape(-1, SKETCH).T),
                ],
                ["node", "size", "prefix", *_BITS],
            )

    own = "".join(f", {b} long" for b in _BITS)
    told = docs.select("__row", "text").mapInArrow(run, "node long, size long, prefix array<long>" + own)
    return told.dropDuplicates(["node"])


def slots_of(tokens: DataFrame) -> np.ndarray:
    """A map with a bit for the low bits of each of the stored tokens, SHARE bits to a token if they
    are not too many; bytes with the low bit first."""
    slots = min(MOST_SLOTS, 1 << max(15, (SHARE * tokens.count()).bit_length()))
    # Buckets of 4,096 bytes, numbered from 1.
    slot = F.pmod("token", F.lit(slots)) + 1
    bits = tokens.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros((slots >> 15, 4096), dtype=np.uint8)
    for batch in bits.toArrow().to_batches():
        for bucket, part in zip(batch.column("bucket").to_pylist(), batch.column("bits")):
            out[bucket - 1] = np.frombuffer(part.as_buffer(), np.uint8)
    return out.ravel()


def placed_tokens(rooted: DataFrame, mapped: np.ndarray) -> DataFrame:
    """(node, root, size, b0 ..., token, place, before) of those of each text's first shingles that
    a map has: the shingle, the number of those before it, and the last BEFORE of these."""
    mapped = rooted.sparkSession.sparkContext.broadcast(mapped)
    kept = ["node", "root", "size", *_BITS]

    def run(batches):
        for batch in batches:
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000)):
                lists = part.column("prefix")
                cuts = lists.offsets.to_numpy().astype(np.int64)
                flat = lists.values.to_numpy()[cuts[0] : cuts[-1]]
                cuts -= cuts[0]
                slot = flat.view(np.uint64) & np.uint64(8 * len(mapped.value) - 1)
                at = np.flatnonzero((mapped.value[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
                row = np.searchsorted(cuts, at, side="right") - 1
                place = at - cuts[row]
                count = np.minimum(place, BEFORE)
                ends = np.concatenate([[0], np.cumsum(count)])
                before = flat[np.repeat(at - count - ends[:-1], count) + np.arange(ends[-1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(pa.array(row)) for c in kept), pa.array(flat[at]), pa.array(place.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(before)),
                    ],
                    [*kept, "token", "place", "before"],
                )

    own = ", ".join(f"{c} long" for c in kept)
    return rooted.select(*kept, "prefix").mapInArrow(run, f"{own}, token long, place int, before array<long>")


def crossing_links(firsts: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b), a < b, that take in all pairs of texts of different groups that are
    similar enough; ``roots`` has the groups so far.

    The texts that have a shingle among their first ones are compared with those of other
    groups only: a shingle of one group makes no row.
    """
    spread = int(firsts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rooted = stored(firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    # Nearly all shingles are one group's; only the others take the texts' figures along.
    met = rooted.select("root", F.explode("prefix").alias("token")).repartition(spread, "token").groupBy("token").agg(
        F.min("root").alias("low"), F.max("root").alias("high")
    )
    met = stored(met.where("low < high").select("token"), "shared")
    entries = stored(placed_tokens(rooted, slots_of(met)), "entries")
    main = entries.select("token", "root").repartition(spread, "token").groupBy("token", "root").count().groupBy("token").agg(
        F.max_by("root", F.struct("count", "root")).alias("main")
    )
    entries = entries.repartition(spread, "token").join(main, "token")
    # A large group is not compared with itself.
    others = entries.where("root <> main")
    apart = (F.col("x.root") != F.col("y.root")) & ((F.col("y.root") == F.col("y.main")) | (F.col("x.root") < F.col("y.root")))
    sizes = (F.least("x.size", "y.size") + 1e-6 >= similarity * F.greatest("x.size", "y.size"))
    unlike = reduce(Column.__add__, [F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in _BITS])
    bits = unlike * (1 + similarity) <= (F.col("x.size") + F.col("y.size")) * (1 - similarity) + 1e-6
    # No shingle before the first shared one is shared, and at most those that follow are.
    again = F.arrays_overlap("x.before", "y.before")
    most = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    enough = most * (1 + similarity) + 1e-6 >= similarity * (F.col("x.size") + F.col("y.size"))
    return (
        others.alias("x")
        .join(entries.alias("y"), (F.col("x.token") == F.col("y.token")) & apart & sizes & enough & ~again & bits)
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def candidate_links(texts: DataFrame, distance: int) -> DataFrame:
    """Links (a, b), a < b, between different texts that may be near duplicates."""
    entries = texts.select(F.col("node"), F.posexplode("bands").alias("band", "value"))
    ends = entries.groupBy("band", "value").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    met = entries.join(ends, ["band", "value"]).select("node", F.explode(F.array("low", "high")).alias("other"))
    prints = stored(texts.groupBy("fp").agg(F.min("node").alias("head")), "prints")
    alike = texts.select("node", "fp").join(prints, "fp").select("node", F.col("head").alias("other"))
    near = (
        links(prints.select("fp"), distance)
        .join(prints.select(F.col("fp").alias("a"), F.col("head").alias("node")), "a")
        .join(prints.select(F.col("fp").alias("b"), F.col("head").alias("other")), "b")
        .select("node", "other")
    )
    every = met.unionByName(alike).unionByName(near).where("node <> other")
    return every.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _shingle_sets(batches):
    """Rows of links with the sorted set of shingles of their member's text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            # Links of one text stand side by side.
            last, own, sets = object(), None, []
            for (width, text) in slices([part], "width", "text"):
                if text != last:
                    last, own = text, np.unique(shingle_hashes(text, width)).view(np.int64)
                sets.append(own)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("center", "part", "member")), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["center", "part", "member", "shingles"],
            )


def holding_links(candidates: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The candidate links whose texts are at least so similar.

    ``docs`` has one row per text: node, text.  A link's member brings its shingles to the
    parts of the link's center, where those of the center come first.
    """
    # The text with more links is the center, as the least of a band is.
    degree = candidates.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    ends = (
        candidates.join(degree.select(F.col("node").alias("a"), F.col("count").alias("na")), "a")
        .join(degree.select(F.col("node").alias("b"), F.col("count").alias("nb")), "b")
    )
    is_a = F.col("na") >= F.col("nb")
    stars = stored(
        ends.select(
            F.when(is_a, F.col("a")).otherwise(F.col("b")).alias("center"),
            F.when(is_a, F.col("b")).otherwise(F.col("a")).alias("member"),
            # The number of parts of the center.
            F.ceil(F.greatest("na", "nb") / PART).alias("parts"),
        ),
        "stars",
    )
    members = stars.select("center", F.pmod(F.xxhash64("member"), F.col("parts")).alias("part"), "member")
    centers = stars.select("center", "parts").distinct().select(
        "center", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("center").alias("member")
    )
    wanted = members.unionByName(centers)
    with_text = wanted.join(docs.select(F.col("node").alias("member"), "text"), "member").withColumn("width", F.lit(width))
    sets = with_text.mapInArrow(_shingle_sets, "center long, part long, member long, shingles array<long>")

    def check(batches):
        now, center = None, None
        for batch in batches:
            a, b = [], []
            shingles = batch.column("shingles")
            flat = shingles.values.to_numpy()
            cuts = shingles.offsets.to_numpy()
            keys = zip(*(batch.column(c).to_pylist() for c in ("center", "part", "member")))
            for k, (own, part, member) in enumerate(keys):
                values = flat[cuts[k] : cuts[k + 1]]
                if member == own:
                    now, center = (own, part), values.copy()
                elif now == (own, part) and similarity_of(center, values) >= similarity:
                    a.append(min(own, member))
                    b.append(max(own, member))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # The sets sort by their centers; a fixed number of parts, as they are wide.
    spread = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = (F.col("member") != F.col("center")).alias("later")
    return (
        sets.withColumn("later", first).repartition(spread, "center", "part")
        .sortWithinPartitions("center", "part", "later").drop("later")
        .mapInArrow(check, "a long, b long")
    )


def first_of_each_group(docs: DataFrame, width: int = 5, similarity: float = 0.8, distance: int = 4) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest doc_id, null ids
    last, and of rows that repeat it that whose text has the least hash."""
    # The hash of a null text is no text's.
    keyed = docs.withColumn("__row", F.xxhash64("text"))
    with shuffles_dropped(docs.sparkSession):
        kept = stored(_first_rows(keyed, width, similarity, distance), "kept")
    # Null ids are equal in a struct, so one shuffle by it serves both steps.
    known = F.struct("doc_id").alias("__id")
    return (
        keyed.select("*", known).dropDuplicates(["__row", "__id"])
        .join(kept.select("__row", known), ["__row", "__id"], "left_semi")
        .select(*[f"`{c}`" for c in docs.columns])
    )


def _first_rows(keyed: DataFrame, width: int, similarity: float, distance: int) -> DataFrame:
    """(doc_id, __row) of the row that stays of each group."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    told = stored(sketches(keyed, width), "sketches")
    texts = stored(
        told.groupBy(F.col("__row").alias("node"))
        .agg(F.min(first).alias("first"), *[F.first(c).alias(c) for c in ("fp", "bands", "size", "odd")]),
        "texts",
    )

    def held(candidates: DataFrame) -> DataFrame:
        candidates = stored(likely_links(candidates, texts, similarity), "likely")
        ends = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        # One row of each text that has a candidate.
        one = texts.select("node", "first").join(ends, "node", "left_semi").select("node", "first.doc_id")
        plain = likely_in(keyed, one.withColumnRenamed("node", "__row"), "__row").select("doc_id", "__row", "text")
        own = plain["doc_id"].eqNullSafe(F.col("k.doc_id")) & (plain["__row"] == F.col("k.node"))
        plain = plain.join(one.alias("k"), own).select("node", "text").dropDuplicates(["node"])
        return holding_links(candidates, plain, width, similarity)

    roots = components(held(stored(candidate_links(texts, distance), "candidates")))
    firsts = prefixes(keyed, frequent_shingles(told), width, similarity)
    more = stored(held(stored(crossing_links(firsts, roots, similarity), "crossing")), "more")
    if not more.isEmpty():
        roots = components(more.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))
    rooted = texts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.__row")
