"""Ordered per-key logic that survives very large keys.

A plain window puts all rows of a key in one task.  Here a key's rows are first
cut into chunks of its own ordering (an hour, a month, ...).  Each chunk is a
window partition of its own, and only one summary row per chunk is ordered
within the key, so neighbours and running counts come out the same while a
single key is spread over as many tasks as it has chunks.

A chunk that holds more than CROWDED rows of one key, as when all of a key's rows
fall into one hour, can be cut further by rank, at approximate order statistics of its own
rows (``by_rank``, ``rank_parts``).  That reads the input more often and makes a larger
plan, so it is asked for where keys are known to crowd (``is_crowded``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a key in one chunk from which the chunk is cut further, and the parts it is cut to.
CROWDED = 1_000_000
PARTS = 64
ACCURACY = 10 * PARTS


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_r{k}"]) for k in keys])


def is_crowded(df: DataFrame, keys: Sequence[str], chunk: Column, crowded: int | None = None) -> bool:
    """Whether some key has more rows in one chunk than a task should take; runs a job."""
    sizes = df.groupBy(*keys, chunk.alias("_chunk")).count()
    return not sizes.where(F.col("count") > (CROWDED if crowded is None else crowded)).isEmpty()


def rank_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, crowded: int | None = None
) -> DataFrame:
    """``df`` with ``_chunk``, a struct that does not decrease along ``order`` within a key
    and of which no value holds many more than ``crowded`` rows of a key.

    It begins with ``chunk``.  For each column of ``order`` in turn, groups that are
    still crowded and constant in the columns before it are cut at PARTS approximate order statistics of
    the column; a value that is an edge is a part of its own, so that the next column
    can cut it.  The edges are one row per crowded group.  Columns that are not numbers or
    times cut nothing.
    """
    limit = CROWDED if crowded is None else crowded
    at = [i / PARTS for i in range(1, PARTS)]
    cut = df.withColumn("_p0", chunk)
    places = ["_p0"]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c in order if kinds[c].simpleString().split("(")[0] in _ORDERED]
    for k, column in enumerate(numbers[: list(order).index(numbers[-1]) + 1] if numbers else []):
        before = list(order[: list(order).index(column)])
        groups = [*keys, *places]
        sizes = cut.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("_size"),
            *[F.min(c).eqNullSafe(F.max(c)).alias(f"_one{i}") for i, c in enumerate(before)],
        ).where(F.col("_size") > limit)
        for i in range(len(before)):
            sizes = sizes.where(F.col(f"_one{i}"))
        # Most often there is none, and what follows is cut from the plan at run time.
        crowd = sizes.select(*[F.col(g).alias(f"_r{g}") for g in groups])
        edges = cut.join(crowd, _same(cut, crowd, groups), "left_semi").groupBy(*groups).agg(
            F.percentile_approx(column, at, ACCURACY).alias("_edges")
        )
        named = edges.select(*[F.col(g).alias(f"_r{g}") for g in groups], "_edges")
        place = f"_p{k + 1}"
        below = F.expr(f"size(filter(_edges, e -> e < `{column}`)) + size(filter(_edges, e -> e <= `{column}`))")
        cut = cut.join(named, _same(cut, named, groups), "left").select(
            *cut.columns, F.when(F.col("_edges").isNotNull(), F.coalesce(below, F.lit(-1))).otherwise(0).alias(place)
        )
        places.append(place)
    return cut.select(*df.columns, F.struct(*places).alias("_chunk"))


_ORDERED = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz")


def split_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running_count: str | None = None,
    source: DataFrame | None = None,
    by_rank: bool = False,
) -> DataFrame:
    """Add lag, lead (``{new: source}``) and a running row count within ``keys``.

    ``order`` must be a total order within a key and ``chunk`` a non-decreasing
    function of it.  ``source`` may name a cheaper table holding the same rows,
    from which the chunk summaries are then built.  ``by_rank`` cuts crowded chunks
    further by ``rank_parts``; it reads the keys and the order once more.

    Every chunk is handed a copy of its neighbours' border rows: the last row
    before it and the first row after it.  A window per (key, chunk) over rows
    and copies then sees the right neighbours, and the rows themselves are
    shuffled once, without a join.
    """
    lag, lead = lag or {}, lead or {}
    keys, order = list(keys), list(order)
    carried = sorted({*lag.values(), *lead.values()})
    border = F.struct(*carried) if carried else F.struct(F.lit(0).alias("_none"))
    sort_key = F.struct(*order)

    def chunked(rows: DataFrame) -> DataFrame:
        return rank_parts(rows, keys, order, chunk) if by_rank else rows.withColumn("_chunk", chunk)

    chunks = (
        chunked(source if source is not None else df)
        .groupBy(*keys, "_chunk")
        .agg(
            F.count(F.lit(1)).alias("_size"),
            F.max_by(border, sort_key).alias("_last"),
            F.min_by(border, sort_key).alias("_first"),
        )
    )
    # One row per chunk from here to the copies.
    across = Window.partitionBy(*keys).orderBy("_chunk")
    earlier = F.sum("_size").over(across.rowsBetween(Window.unboundedPreceding, -1))
    neighbours = chunks.select(
        *keys,
        "_chunk",
        F.coalesce(earlier, F.lit(0)).alias("_before"),
        F.lag("_last").over(across).alias("_head"),
        F.lead("_first").over(across).alias("_tail"),
    )
    ends = [F.struct(F.lit(-1).alias("_place"), F.col("_head").alias("_row"))]
    if lead:
        ends.append(F.struct(F.lit(1).alias("_place"), F.col("_tail").alias("_row")))
    # Key columns keep their own values in the copies.
    copied = [c for c in carried if c not in keys]
    copies = neighbours.select(*keys, "_chunk", "_before", F.inline(F.array(*ends))).select(
        *keys, "_chunk", "_before", "_place", *[F.col("_row")[c].alias(c) for c in copied]
    )
    rows = chunked(df).withColumns({"_place": F.lit(0), "_before": F.lit(None).cast("long")})
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_place", *order)
    out = [F.col(c) for c in df.columns]
    out += [F.lag(source_).over(inside).alias(name) for name, source_ in lag.items()]
    out += [F.lead(source_).over(inside).alias(name) for name, source_ in lead.items()]
    if running_count:
        start = F.first("_before").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        number = F.row_number().over(inside).cast("long") - 1
        out.append((start + number).alias(running_count))
    both = rows.unionByName(copies, allowMissingColumns=True)
    return both.select("_place", *out).where(F.col("_place") == 0).drop("_place")


def top_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of each key.

    Spark cuts every key to ``k`` rows before the shuffle (window group limit),
    so a key of any size sends at most ``k`` rows per map task.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def as_of_merge(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    values: Sequence[str],
    chunk: str = "month",
    until: str | None = None,
    ties: Sequence[str] = (),
    by_rank: bool = False,
) -> DataFrame:
    """Each row of ``left`` with the ``values`` of its key's last ``right`` row at or before its time.

    Rows of both sides are united and ordered by time within (key, chunk), where a chunk is a
    calendar unit, with ``by_rank`` cut further where it is crowded.  Every chunk that has left rows gets one
    more row: the key's last right row before the chunk, found from one summary row per
    chunk.  So each side is shuffled once, nothing is repeated for the time it spans, and a
    busy key is spread over its chunks.

    Of right rows at the same time the last by ``ties`` and values counts.  With ``until`` a
    match ends before that column's time, if it has one.  Left rows without a key, a time
    or a match keep their row, with null values.
    """
    taken = [*values, *([until] if until else [])]
    payload = F.struct(*[F.col(c).alias(c) for c in taken])
    name = {c: f"_l{k}" for k, c in enumerate(left.columns)}
    rows = left.select(
        F.col(left_key).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_kind"),
        F.struct(*[F.col(c).alias(n) for c, n in name.items()]).alias("_row"),
    )
    time_type = left.schema[left_time].dataType
    known = right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(right_key).alias("_key"), F.col(right_time).cast(time_type).alias("_time"), F.lit(0).alias("_kind"),
        F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)], payload.alias("p")).alias("_version"),
    )
    loose = "_key IS NULL OR _time IS NULL"
    both = rows.where(f"NOT ({loose})").unionByName(known, allowMissingColumns=True)
    unit = F.date_trunc(chunk, "_time")
    cut = rank_parts(both, ["_key"], ["_time"], unit) if by_rank else both.withColumn("_chunk", F.struct(unit))
    last = F.max(F.when(F.col("_kind") == 0, F.struct("_time", "_version"))).alias("_last")
    # One row per key and chunk from here to the copies.
    across = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy("_key", "_chunk").agg(last, F.max("_kind").alias("_asks"))
        .select("_key", "_chunk", "_asks", F.last("_last", True).over(across).alias("_found"))
        .where("_asks = 1 AND _found IS NOT NULL")
        .select("_key", "_chunk", F.lit(-1).alias("_kind"), F.col("_found._time").alias("_time"), "_found._version")
    )
    united = cut.unionByName(carried, allowMissingColumns=True)
    order = [F.col("_kind") >= 0, F.col("_time"), F.col("_kind"), F.col("_version")]
    seen = Window.partitionBy("_key", "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = united.withColumn("_match", F.last("_version", True).over(seen)["p"]).where("_kind = 1")
    if until:
        open_still = F.col(f"_match.{until}").isNull() | (F.col("_time") < F.col(f"_match.{until}"))
        found = found.withColumn("_match", F.when(open_still, F.col("_match")))
    out = [F.col(f"_row.{n}").alias(c) for c, n in name.items()]
    kinds = {c: right.schema[c].dataType for c in values}
    matched = found.select(*out, *[F.col(f"_match.{c}").alias(c) for c in values])
    return matched.unionByName(
        rows.where(loose).select(*out, *[F.lit(None).cast(kinds[c]).alias(c) for c in values])
    )
