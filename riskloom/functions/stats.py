"""Aggregates: shares, disparities, mergeable moments, exact quantiles.

Exact quantiles never gather a column in one task.  The first pass counts rows
per order-preserving bucket, the second looks only at the few buckets that
hold a wanted rank.  Equal values are collapsed map-side before each shuffle,
so one very frequent value is as cheap as a rare one, and the different values of
a wanted bucket are dealt out by order statistics (``running_counts``), so a crowded
bucket is many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.rules import _col

# Buckets per unit of log1p(|x|): a score range of 0-100 gives about 19,000.
QUANTILE_RESOLUTION = 4096
# Parts that the different values of a wanted bucket are dealt out to, and how much
# larger than the others a part may be: one task has at most 1/64 + 1/640 of them.
SPLITS = 64
SPLIT_ACCURACY = 10 * SPLITS
# Rows from which a wanted bucket's values are dealt out; a smaller one is one task.
CROWDED = 1_000_000


def n_rows() -> Column:
    return F.count(F.lit(1))


def ratio(top: Column, bottom: Column) -> Column:
    """Double division that yields null for a zero or null divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def pct(condition: Column, digits: int | None = None) -> Column:
    """Share of rows meeting ``condition`` in percent; null for no rows."""
    share = ratio(F.count_if(condition) * F.lit(100.0), n_rows())
    return share if digits is None else F.round(share, digits)


def pct_of(part: Column, whole: Column, digits: int | None = None) -> Column:
    share = ratio(part * F.lit(100.0), whole)
    return share if digits is None else F.round(share, digits)


def pct_change(now: Column, before: Column) -> Column:
    return ratio(now.cast("double") - before, before) * 100


def disparity_pct(highest: Column, lowest: Column) -> Column:
    return ratio(highest - lowest, lowest) * 100


def cv(std: Column, mean: Column) -> Column:
    return ratio(std, mean)


def zscore(value: Column, mean: Column, std: Column) -> Column:
    return ratio(value - mean, std)


BUCKET = f"floor(signum(_x) * log1p(abs(_x)) * {QUANTILE_RESOLUTION})"


def quantiles(
    df: DataFrame,
    column: Column | str,
    probs: Sequence[float],
    names: Sequence[str],
    by: Sequence[str] = (),
    approx: bool = False,
    few_groups: bool = False,
) -> DataFrame:
    """Quantiles with linear interpolation, one row per group of ``by``.

    ``approx=True`` reads the data once with a bounded sketch.  The exact form
    reads the column twice; its second read is filtered by the table of wanted
    buckets, which holds at most two rows per group and probability.  It is
    broadcast where its size is bound by the arguments: without groups, or with
    ``few_groups=True``, which states that the groups are a fixed list, such as
    column names.  Else Spark chooses the join by its size.
    Nulls and NaN are ignored; a group without values has no row, a whole table
    without values one row of nulls.
    """
    by = list(by)
    x = _col(column).cast("double")
    values = df.select(*by, x.alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    if approx:
        sketch = values.groupBy(*by).agg(
            F.percentile_approx("_x", list(probs), 100_000).alias("_q")
        )
        return sketch.select(
            *by, *[F.col("_q")[i].alias(name) for i, name in enumerate(names)]
        )

    values = values.withColumn("_b", F.expr(BUCKET))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    upto = F.sum("_n").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    histogram = (
        values.groupBy(*by, "_b")
        .agg(n_rows().alias("_n"))
        .select(
            *by,
            "_b",
            F.col("_n").alias("_rows"),
            (upto - F.col("_n")).alias("_before"),
            upto.alias("_upto"),
            F.sum("_n").over(group).alias("_total"),
        )
    )
    ranks = rank_list(probs)
    targets = histogram.where(f"exists({ranks}, k -> k >= _before AND k < _upto)")
    targets = targets.select(*by, "_b", "_rows", "_before", "_total")
    if not by or few_groups:
        targets = F.broadcast(targets)
    targets = targets.select(*[F.col(c).alias(f"_t{c}") for c in targets.columns])
    joined = values.join(
        targets,
        [values[key].eqNullSafe(targets[f"_t{key}"]) for key in by]
        + [values["_b"] == targets["_t_b"]],
    ).select(
        *[values[key] for key in by],
        values["_b"],
        values["_x"],
        targets["_t_rows"].alias("_rows"),
        targets["_t_before"].alias("_before"),
        targets["_t_total"].alias("_total"),
    )
    # As an aggregate the bucket's size is no filter of the scan: both branches share it.
    counted = joined.groupBy(*by, "_b", "_x", "_before", "_total").agg(
        n_rows().alias("_n"), F.max("_rows").alias("_rows")
    )
    inside = Window.partitionBy(*by, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    small = counted.where(F.col("_rows") <= CROWDED).withColumn(
        "_earlier", F.coalesce(F.sum("_n").over(inside), F.lit(0))
    )
    # Empty, and cut from the plan at run time, where no bucket is crowded.
    crowded = running_counts(counted.where(F.col("_rows") > CROWDED), [*by, "_b"], few_groups or not by)
    ranked = small.unionByName(crowded).select(
        *by,
        "_x",
        "_total",
        (F.col("_before") + F.col("_earlier")).alias("_start"),
        (F.col("_before") + F.col("_earlier") + F.col("_n")).alias("_end"),
    )
    return at_ranks(ranked, by, probs, names)


def at_ranks(ranked: DataFrame, by: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles from values ``_x`` that hold the ranks ``_start`` to before ``_end`` of the
    group's ``_total``; only rows that hold a wanted rank are needed."""
    hits = F.expr(f"filter({rank_list(probs)}, k -> k >= _start AND k < _end)")
    found = (
        ranked.select(*by, "_x", "_total", F.explode(hits).alias("_k"))
        .groupBy(*by)
        # At most two entries per probability.
        .agg(
            F.max("_total").alias("_total"),
            F.map_from_entries(F.collect_list(F.struct("_k", "_x"))).alias("_at"),
        )
    )
    return found.select(
        *by, *[_interpolated(p).alias(name) for p, name in zip(probs, names, strict=True)]
    )


def _met(left: DataFrame, right: DataFrame, on: Sequence[str], take: str, few: bool) -> DataFrame:
    """Null-safe join that adds one column."""
    named = right.select(*[F.col(c).alias(f"_r{c}") for c in on], take)
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(named[f"_r{c}"]) for c in on])
    return left.join(F.broadcast(named) if few else named, same).select(left["*"], take)


def dealt_parts(counted: DataFrame, keys: Sequence[str], few_keys: bool = False) -> DataFrame:
    """``counted`` with ``_part``, its place among the SPLITS parts of its key's values.

    The borders are approximate order statistics of the key's different values, whose
    error is bounded whatever their distribution.
    """
    at = [i / SPLITS for i in range(1, SPLITS)]
    edges = counted.groupBy(*keys).agg(F.percentile_approx("_x", at, SPLIT_ACCURACY).alias("_edges"))
    return _met(counted, edges, keys, "_edges", few_keys).withColumn(
        "_part", F.expr("size(filter(_edges, e -> e < _x))")
    ).drop("_edges")


def running_counts(counted: DataFrame, keys: Sequence[str], few_keys: bool = False) -> DataFrame:
    """``counted`` (one row per key and different value ``_x``, with its rows ``_n``) and
    ``_earlier``, the rows of the key with smaller values.

    Parts are ordered by the table of their sizes, values within their part, so no task
    sees more than a part.  ``few_keys`` states that the keys are few, such as buckets of
    listed columns; their edges and sizes then go to all tasks.
    """
    keys = list(keys)
    cut = dealt_parts(counted, keys, few_keys)
    order = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most SPLITS rows per key.
    sizes = cut.groupBy(*keys, "_part").agg(F.sum("_n").alias("_size")).select(
        *keys, "_part", F.coalesce(F.sum("_size").over(order), F.lit(0)).alias("_ahead")
    )
    inside = Window.partitionBy(*keys, "_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("_n").over(inside), F.lit(0))
    return _met(cut, sizes, [*keys, "_part"], "_ahead", few_keys).select(
        *counted.columns, (F.col("_ahead") + own).alias("_earlier")
    )


# SQL text: one call to the JVM where the same expression composed from Column
# objects takes dozens.
def rank_list(probs: Sequence[float]) -> str:
    """Zero-based ranks next to each probability's position."""
    literals = ", ".join(f"{float(p)!r}D" for p in probs)
    return (
        f"array_distinct(flatten(transform(array({literals}), "
        "p -> array(floor(p * (_total - 1)), ceil(p * (_total - 1))))))"
    )


def _interpolated(p: float) -> Column:
    position = f"({float(p)!r}D * (_total - 1))"
    lo, hi = f"_at[floor({position})]", f"_at[ceil({position})]"
    t = f"({position} - floor({position}))"
    # The half nearer the upper neighbour is measured from it, so that a
    # position that is a whole rank up to rounding lands on the value.
    return F.expr(
        # Between a value and an infinite one there is no distance to divide.
        f"CASE WHEN {lo} = {hi} OR {t} = 0 THEN {lo} WHEN abs({hi}) = double('infinity') THEN {hi} "
        f"WHEN abs({lo}) = double('infinity') THEN {lo} WHEN {t} >= 0.5D THEN {hi} - ({hi} - {lo}) * (1 - {t}) "
        f"ELSE {lo} + ({hi} - {lo}) * {t} END"
    )


def moments(column: Column | str, prefix: str = "") -> list[Column]:
    """Partial aggregates that can be merged again: count, sum, spread, min, max."""
    x = _col(column)
    return [
        F.count(x).alias(f"{prefix}cnt"),
        F.sum(x).alias(f"{prefix}sum"),
        (F.var_pop(x) * F.count(x)).alias(f"{prefix}m2"),
        F.min(x).alias(f"{prefix}min"),
        F.max(x).alias(f"{prefix}max"),
    ]


def merged_mean(prefix: str = "") -> Column:
    return ratio(F.sum(f"{prefix}sum"), F.sum(f"{prefix}cnt"))


def merged_spread(prefix: str = "") -> Column:
    """Sum of squared deviations of the union of partial groups."""
    n, s = F.sum(f"{prefix}cnt"), F.sum(f"{prefix}sum")
    between = F.sum(ratio(F.col(f"{prefix}sum") * F.col(f"{prefix}sum"), F.col(f"{prefix}cnt")))
    spread = F.sum(f"{prefix}m2") + between - ratio(s * s, n)
    return F.greatest(spread, F.lit(0.0))


def merged_std(prefix: str = "") -> Column:
    """Sample standard deviation; null below two values."""
    return F.sqrt(ratio(merged_spread(prefix), F.nullif(F.sum(f"{prefix}cnt") - 1, F.lit(0))))


def one_value(df: DataFrame, column: str) -> Column:
    """A one-row result as a scalar subquery: no join in the outer plan."""
    return df.select(column).scalar()


def one_row(df: DataFrame) -> Column:
    """A one-row result as a struct: several of its fields cost one evaluation."""
    return df.select(F.struct("*").alias("_row")).scalar()
