"""Benchmark decontamination by a distributed positional inverted index.

An item is asked for by its windows (WINDOW consecutive words, or the whole of a
shorter item).  For each window the two terms that are rarest in the corpus are
its probes.  The index stores the postings (term, doc_id, pos) of all probe
terms; terms that nothing asks for have none.  The rarest probe's list is
adjusted by the term's place in the item, giving for each posting the place
where the item would start, and is intersected with the second probe's adjusted
list.  Equal places are phrase candidates, places within ``slop`` of each other
are proximity matches.  Candidates are then checked word by word.

Items go by a number through the joins; their words are fetched once per document
and item, for the check.  Documents go by their id and the hash of their text, so
rows without an id, or with the same one, are spread and judged like others.

All joins are on a document and a place (or on a term with its postings), so a
passage that a third of all documents share is spread like any other; the
candidate is an item's start, one row per occurrence of a passage, not one per
window.  Nothing is broadcast by force: Spark does it where it finds a side
small enough.

Words are those of the text with A-Z lower-cased.  Null texts and texts without
words have none and match nothing.  Items with a null id are not items.  Rows
that repeat a doc_id or have none are judged each by its own words.  Columns that have the
name of a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.llm.common import ascii_lower, let, same, stored, without

# What lower-cased text has besides ``[\x00-\x2F\x3A-\x60\x7B-\x7F]``.  Java takes some ten times as
# long for the class stated as what it leaves out.
TERM = r"[a-z0-9\x{80}-\x{10FFFF}]+"
WINDOW = 10
SLOP = 3
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items")


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)


def numbered(items: DataFrame) -> DataFrame:
    """(item, item_id, words): the distinct items with words, under a number each."""
    found = (
        items.where("item_id IS NOT NULL")
        .select(F.col("item_id"), terms_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0).distinct()
    )
    # Written, so that a number does not change when a task is run again.
    return stored(found.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"), "items")


def text_key() -> Column:
    """What tells rows of one doc_id, or of none, apart; equal texts have equal matches."""
    return F.xxhash64("text")


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", text_key().alias("key"), F.posexplode(terms_of(F.col("text"))).alias("pos", "term")
    )


def probes(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per numbered item the distinct probe pairs of its windows: terms and places in the item.

    A window of one word has no second probe.
    """
    last = F.greatest(F.size("words") - width, F.lit(0))
    asked = items.withColumn("at", F.explode(F.sequence(F.lit(0), last))).select(
        "item", "at", F.posexplode(F.slice("words", F.col("at") + 1, width)).alias("off", "term")
    )
    counts = (
        _tokens(docs).join(asked.select("term").distinct(), "term")
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = W.partitionBy("item", "at").orderBy("n", "term", "off")
    ranked = (
        asked.join(counts, "term", "left").fillna(0, ["n"])
        .withColumn("place", F.col("at") + F.col("off"))
        .withColumn("rank", F.row_number().over(rarest))
        .withColumn("lacking", F.min("n").over(rarest.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        # A window with a term that no document has occurs nowhere.
        .where("rank <= 2 AND lacking > 0")
    )
    pair = [
        F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c}{r}")
        for r in (1, 2) for c in ("term", "place")
    ]
    return (
        ranked.groupBy("item", "at").agg(*pair)
        .select("item", "term1", "place1", "term2", "place2").distinct()
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: (term, doc_id, key, pos) for the terms in ``terms``; repeated rows
    have their postings once."""
    found = _tokens(docs).join(terms, "term").select("term", "doc_id", "key", "pos")
    # Dealt by document and place: by term alone, a frequent term would be one task's.
    return stored(found.repartition("doc_id", "key", "pos").distinct(), "postings")


def intersected(index: DataFrame, pairs: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, key, item, start, apart): where both probes of a pair stand.

    ``start`` is the place of the item's first word by the first probe, and
    ``apart`` how far the second probe is from where the phrase has it.
    """
    first = pairs.join(index, F.col("term1") == F.col("term")).select(
        "doc_id", "key", "item", (F.col("pos") - F.col("place1")).alias("start"), "term2", "place2"
    )
    single = first.where("term2 IS NULL").select(
        "doc_id", "key", "item", "start", F.lit(0).alias("apart")
    )
    # Places are matched by buckets, of which a range of +-slop meets one or two.
    bucket = 4 * slop + 1
    expected = F.col("start") + F.col("place2")
    wanted = first.where("term2 IS NOT NULL").withColumn("expected", expected).withColumn(
        "bucket",
        F.explode(
            F.array_distinct(
                F.array(*[F.floor((F.col("expected") + d) / bucket) for d in (-slop, slop)])
            )
        ),
    )
    second = index.withColumn("bucket", F.floor(F.col("pos") / bucket))
    both = (
        wanted.alias("w").join(
            second.alias("s"),
            same("w", "s", ["doc_id", "key", "bucket"]) & (F.col("term2") == F.col("term"))
            & F.col("pos").between(F.col("expected") - slop, F.col("expected") + slop),
        )
        .select("w.doc_id", "w.key", "item", "start", F.abs(F.col("pos") - F.col("expected")).alias("apart"))
    )
    return both.union(single)


def hits(docs: DataFrame, items: DataFrame, width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """The documents with ``matches`` (item_id, start places of its windows, their size),
    n_words, n_hit, n_items, items_sha256, contaminated and n_near_items."""
    items = numbered(items)
    pairs = stored(probes(docs, items, width), "probes")
    asked = pairs.select(F.explode(F.array("term1", "term2")).alias("term")).where(
        "term IS NOT NULL"
    ).distinct()
    index = postings(docs, asked)
    per_item = (
        intersected(index, pairs, slop)
        .groupBy("doc_id", "key", "item").agg(F.collect_set(F.when(F.col("apart") == 0, F.col("start"))).alias("starts"))
    )
    found = F.when(F.size("starts") > 0, F.struct("item_id", "words", "starts"))
    per_doc = per_item.join(items, "item").groupBy("doc_id", "key").agg(
        F.collect_list(found).alias("__found"), F.count_distinct("item_id").alias("n_near_items")
    )

    def windows(match: Column, own: Column) -> Column:
        words = match["words"]
        size = F.least(F.size(words), F.lit(width))
        places = F.sequence(F.lit(0), F.size(words) - size)
        starts = F.flatten(
            F.transform(
                match["starts"],
                lambda start: F.transform(
                    F.filter(
                        places,
                        lambda k: (start + k >= 0)
                        & (F.slice(own, F.greatest(start + k, F.lit(0)) + 1, size) == F.slice(words, k + 1, size)),
                    ),
                    lambda k: start + k,
                ),
            )
        )
        return F.struct(match["item_id"].alias("item_id"), starts.alias("starts"), size.alias("size"))

    matches = let(
        F.col("__own"),
        lambda own: F.filter(
            F.transform(F.coalesce("__found", F.array()), lambda m: windows(m, own)),
            lambda m: F.size(m["starts"]) > 0,
        ),
    )
    covered = F.array_distinct(
        F.flatten(
            F.flatten(
                F.transform(
                    "matches",
                    lambda m: F.transform(m["starts"], lambda s: F.sequence(s, s + m["size"] - 1)),
                )
            )
        )
    )
    ids = F.array_sort(
        F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string")))
    )
    return (
        without(docs, (*RESULT, "matches")).withColumn("__key", text_key()).alias("d")
        .join(per_doc.withColumnRenamed("key", "__key").alias("p"), same("d", "p", ["doc_id", "__key"]), "left")
        .select("d.*", "__found", "p.n_near_items")
        .withColumn("__own", terms_of(F.col("text")))
        .withColumn("n_words", F.size("__own").cast("long"))
        .withColumn("matches", matches)
        .drop("__own", "__found", "__key")
        .withColumn("n_hit", F.size(covered).cast("long"))
        .withColumn("__ids", ids)
        .withColumn("n_items", F.size("__ids").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("__ids", ","), 256))
        .drop("__ids")
        .withColumn("contaminated", F.col("n_hit") > 0)
        .withColumn("n_near_items", F.coalesce("n_near_items", F.lit(0)).cast("long"))
    )
