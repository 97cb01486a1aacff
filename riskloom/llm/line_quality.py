"""Cross-document line frequency: boilerplate lines and the documents they deplete.

Lines are normalised (lower case, single spaces, trimmed) and hashed.  For every
host the distinct documents of a line are counted; a line above both limits is
removed from all documents of the host but the first, and a document that loses
nearly all of its words is rejected.

Copies of one document count once.  A document's sketch are the first hashes, one for each
quarter of the hash space, among the word windows of its *own* lines, those that no
more rows have than the limits allow; a document of shared lines only has the set of these
instead.  Documents of a host that agree on one of the four are taken for copies, and
count as the least document that they agree with.  Near copies of a similarity of 0.8 in their own lines
agree on none in 0.2 % of cases, while documents that merely share lines, however many,
agree on none.  So a group of copies, however large, is no boilerplate, and takes nothing
from the count of the other documents.

Defined cases: a null text has no words and no lines; a null host is a host of
its own; a row is a document, known by its ``doc_id``, host and text, so rows that
repeat a ``doc_id`` or have none are judged each by its own text; the first
document of a line keeps it in all rows under its id; a null ``doc_id`` is the
first document only of a line that no other has, the text with the least hash.
Columns that have the name of a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, WORD, let, number_of, same, stored, without

RESULT = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "removed_lines", "n_removed_words", "clean_text", "kept",
)


@dataclass(frozen=True)
class LineLimits:
    """A line is removed if more than ``docs`` documents, copies counted once, and more than
    ``share`` of its host's documents have it.  A document with fewer than ``rest`` of its
    words left is depleted."""

    docs: int = 20
    share: float = 0.002
    rest: float = 0.2
    min_words: int = 50
    max_repeat_percent: int = 50


def _lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def _line_hash(line: Column) -> Column:
    return number_of(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words inside windows found twice or more in the text.

    Windows are hashed and sorted with their places, so the work per text is
    n log n; neighbours with equal hashes are the repeated ones.
    """
    return let(words, lambda w: _repeated(w, width))


def _repeated(words: Column, width: int) -> Column:
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.struct(
            F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"), i.alias("i")
        ),
    )
    def repeated(sorted_windows: Column) -> Column:
        def twin(k: Column) -> Column:
            return F.get(sorted_windows, k)["h"]

        return F.filter(
            sorted_windows,
            lambda s, k: (s["h"] == F.coalesce(F.when(k > 0, twin(k - 1)), s["h"] + 1))
            | (s["h"] == F.coalesce(twin(k + 1), s["h"] + 1)),
        )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1), p + width) - p),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    places = let(
        F.sort_array(hashes), lambda s: F.sort_array(F.transform(repeated(s), lambda w: w["i"]))
    )
    return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(let(places, covered))


def base_figures(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Adds the figures of each text by itself."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = _lines(text)
    return (
        without(docs, RESULT)
        .withColumn("__words", F.regexp_extract_all(text, F.lit(WORD), 0))
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(text, SPACE, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .withColumn("n_repeat_words", repeated_window_words(F.col("__words")))
        .drop("__words")
        .withColumn(
            "base_failed",
            (F.col("n_words") < limits.min_words)
            | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")),
        )
    )


# Turned by this bit, the ends of the order of signed hashes are the other two quarters of them.
TURN = 1 << 62
ENDS = (F.min, F.max, F.min, F.max)


def _end_windows(words: Column, width: int = 3) -> Column:
    """The smallest and the largest hash among the windows of a line's words, and the same
    of the turned hashes: the first of each quarter of the hash space."""
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )

    def ends(hashes: Column) -> Column:
        turned = F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(TURN)))
        outer = F.array(F.array_min(hashes), F.array_max(hashes))
        return F.concat(outer, let(turned, lambda t: F.array(F.array_min(t), F.array_max(t))))

    return let(windows, ends)


def line_rows(docs: DataFrame, host: str = "source", told: bool = False) -> DataFrame:
    """One row per distinct line with a word of a row: doc_id, host, ``row`` (the text's
    hash), h and, if ``told``, ``windows``, the end hashes of its windows of words."""
    if told:
        line = lambda x: F.struct(
            _line_hash(x).alias("h"), let(F.regexp_extract_all(F.lower(x), F.lit(WORD), F.lit(0)), lambda w: _end_windows(w)).alias("windows")
        )
    else:
        line = lambda x: F.struct(_line_hash(x).alias("h"))
    found = F.explode(F.array_distinct(F.transform(_lines(F.col("text")), line)))
    return docs.select(
        "doc_id", F.col(host).alias("host"), F.xxhash64("text").alias("row"), found.alias("_line")
    ).select("doc_id", "host", "row", "_line.*")


def shared_lines(docs: DataFrame, limits: LineLimits = LineLimits(), host: str = "source") -> DataFrame:
    """Lines that more rows of a host have than both limits: host, h, n_rows, host_docs."""
    counts = line_rows(docs, host).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_rows"))
    hosts = docs.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("host_docs"))
    return (
        counts.where(F.col("n_rows") > limits.docs).alias("c")
        .join(hosts.alias("o"), same("c", "o", ["host"]))
        .where(F.col("n_rows") > limits.share * F.col("host_docs"))
        .select("c.host", "h", "n_rows", "host_docs")
    )


def rows_with_shared(docs: DataFrame, shared: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, row, ``lines``, the shared lines of the row, and ``sketch``, what
    tells it from other documents."""
    is_shared = F.col("n_rows").isNotNull()
    own = [end(F.when(~is_shared, F.get("windows", F.lit(k)))) for k, end in enumerate(ENDS)]
    only_shared = number_of(F.array_join(F.col("lines").cast("array<string>"), ","))
    return (
        line_rows(docs, host, told=True).alias("l")
        .join(shared.alias("s"), same("l", "s", ["host", "h"]), "left")
        .groupBy("doc_id", "l.host", "row")
        .agg(
            F.array_sort(F.collect_set(F.when(is_shared, F.col("l.h")))).alias("lines"),
            F.array(*own).alias("sketch"),
        )
        .where(F.size("lines") > 0)
        .withColumn("sketch", F.when(F.get("sketch", F.lit(0)).isNull(), F.array(only_shared)).otherwise(F.col("sketch")))
    )


def with_document(rows: DataFrame) -> DataFrame:
    """The rows with ``document``, the least row of their host that they share a part of
    their sketch with: one value for all copies of a document, but for a few.

    Parts of equal sketches are summed up before they are shuffled; each row has four at most.
    """
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    parts = rows.select(
        "doc_id", "host", "row", F.size("sketch").alias("of"), F.posexplode("sketch").alias("part", "value")
    )
    key = ["host", "of", "part", "value"]
    least = parts.groupBy(*key).agg(F.min(own).alias("_least"))
    document = (
        parts.alias("p").join(least.alias("m"), same("p", "m", key))
        .groupBy("p.doc_id", "p.host", "p.row").agg(F.min("_least").alias("document"))
    )
    return rows.alias("r").join(document.alias("d"), same("r", "d", ["doc_id", "host", "row"])).select(
        "r.doc_id", "r.host", "r.row", "lines", "document"
    )


def frequent_lines(rows: DataFrame, shared: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Lines above the limits: host, h, n_docs and the first document, or the first row
    if no document has an id.

    Two steps of partial sums; neither a frequent line nor a large host meets in
    one task.
    """
    without_id = F.when(F.col("doc_id").isNull(), F.col("row"))
    per_text = (
        with_document(rows).select("doc_id", "host", "row", "document", F.explode("lines").alias("h"))
        .groupBy("host", "h", "document")
        .agg(F.min("doc_id").alias("first_doc"), F.min(without_id).alias("first_row"))
    )
    counts = per_text.groupBy("host", "h").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("first_doc").alias("first_doc"),
        F.min("first_row").alias("first_row"),
    )
    return (
        counts.where(F.col("n_docs") > limits.docs).alias("c")
        .join(shared.alias("s"), same("c", "s", ["host", "h"]))
        .where(F.col("n_docs") > limits.share * F.col("host_docs"))
        .select("c.host", "c.h", "n_docs", "first_doc", "first_row")
    )


def remove_frequent_lines(
    docs: DataFrame, limits: LineLimits = LineLimits(), host: str = "source"
) -> DataFrame:
    """The documents with their base figures, the hashes of removed lines, the
    text without them and the verdict ``kept``."""
    shared = stored(shared_lines(docs, limits, host), "shared-lines")
    rows = stored(rows_with_shared(docs, shared, host), "rows-with-shared")
    first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (
        F.col("doc_id").isNotNull() | (F.col("row") == F.col("first_row"))
    )
    removed = (
        rows.select("doc_id", "host", "row", F.explode("lines").alias("h")).alias("l")
        .join(frequent_lines(rows, shared, limits).alias("f"), same("l", "f", ["host", "h"]))
        .where(~first)
        .groupBy("doc_id", "l.host", "row")
        .agg(F.collect_list("l.h").alias("removed_lines"))
    )
    figures = base_figures(docs, limits).withColumn("__row", F.xxhash64("text"))
    gone = F.coalesce("removed_lines", F.array().cast("array<long>"))
    clean = F.array_join(
        F.filter(
            F.split("text", "\n"),
            lambda x: ~(x.rlike(WORD) & F.array_contains(F.col("removed_lines"), _line_hash(x))),
        ),
        "\n",
    )
    none = F.size("removed_lines") == 0
    # No word crosses the end of a line.
    n_removed = F.when(none, F.lit(0)).otherwise(
        F.col("n_words") - F.regexp_count("clean_text", F.lit(WORD))
    )
    enough = (F.col("n_words") - F.col("n_removed_words")) >= limits.rest * F.col("n_words")
    own_row = (
        F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
        & F.col(f"d.`{host}`").eqNullSafe(F.col("r.host"))
        & (F.col("d.__row") == F.col("r.row"))
    )
    return (
        figures.alias("d")
        .join(removed.alias("r"), own_row, "left")
        .select("d.*", gone.alias("removed_lines"))
        .drop("__row")
        .withColumn("clean_text", F.when(none, F.col("text")).otherwise(clean))
        .withColumn("n_removed_words", n_removed.cast("long"))
        .withColumn("kept", ~F.col("base_failed") & enough)
    )
