"""Distribution drift: stability index and divergence over baseline quantile bins.

Bins are the baseline's deciles, half-open except the last, whose edge is
raised by 0.001.  Tied edges are legal.  The stability index divides by all
rows of a side, the divergence only by those inside the bins, and each has its
own floor for empty bins.  All columns are handled in one pass: the inputs are
unpivoted to (column, value) and counted per bin before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.rules import drift_requires_action, drift_severity
from riskloom.functions.stats import quantiles
from riskloom.sources.tables import current_records

# Fixed values.
BINS = 10
LAST_EDGE_STEP = 0.001
PSI_FLOOR = 0.0001
KL_FLOOR = 1e-10
POPULATION_COLUMNS = ("bmi", "health_risk_score")
SAMPLE_FRACTION = 0.1
SAMPLE_SLOTS = 10_000


def _edge_names(bins: int) -> list[str]:
    return [f"_e{i}" for i in range(bins + 1)]


def unpivot_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """(column_name, x) rows without nulls and NaN."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
        for c in columns
    ]
    long = df.select(*keep, F.inline(F.array(*pairs)))
    return long.where("x IS NOT NULL AND NOT isnan(x)")


def baseline_edges(
    long: DataFrame, keys: Sequence[str], bins: int = BINS, approx: bool = False
) -> DataFrame:
    """Quantile edges per key as columns ``_e0 .. _eN``."""
    names = _edge_names(bins)
    probs = [i / bins for i in range(bins + 1)]
    # Groups of column names alone are as few as the columns asked for.
    few = list(keys) == ["column_name"]
    edges = quantiles(long, "x", probs, names, by=keys, approx=approx, few_groups=few)
    return edges.withColumn(names[-1], F.col(names[-1]) + LAST_EDGE_STEP)


def with_bin(long: DataFrame, edges: DataFrame, keys: Sequence[str], bins: int = BINS) -> DataFrame:
    """Bin number 1..N of each value; other numbers lie outside all bins."""
    few = list(keys) == ["column_name"]
    joined = long.join(F.broadcast(edges) if few else edges, list(keys))
    names = _edge_names(bins)
    below = " + ".join(f"int({e} <= x)" for e in names)
    index = F.expr(f"CASE WHEN x = {names[-1]} THEN {bins} ELSE {below} END")
    return joined.withColumn("_bin", index).drop(*names)


# The scores are SQL text over count columns ``bn, b1 .. bN`` (baseline) and
# ``cn, c1 .. cN`` (current): one call to the JVM instead of hundreds.
def bin_counts(side: str, prefix: str, bins: int = BINS) -> list[Column]:
    """Rows of a side (a SQL condition) in total and per bin."""
    return [F.expr(f"count_if({side}) AS {prefix}n")] + [
        F.expr(f"count_if({side} AND _bin = {i}) AS {prefix}{i}") for i in range(1, bins + 1)
    ]


def _floored(count: str, total: str, floor: float) -> str:
    return f"(CASE WHEN {count} = 0 THEN double({floor!r}) ELSE {count} / double({total}) END)"


def psi_of_counts(bins: int = BINS) -> Column:
    """An empty side gives 0."""
    terms = []
    for i in range(1, bins + 1):
        b, c = _floored(f"b{i}", "bn", PSI_FLOOR), _floored(f"c{i}", "cn", PSI_FLOOR)
        terms.append(f"({c} - {b}) * ln({c} / {b})")
    return F.expr(f"CASE WHEN bn = 0 OR cn = 0 THEN 0D ELSE {' + '.join(terms)} END")


def kl_of_counts(bins: int = BINS) -> Column:
    """Null when no current value lies inside the bins."""
    b_in = "(" + " + ".join(f"b{i}" for i in range(1, bins + 1)) + ")"
    c_in = b_in.replace("b", "c")
    terms = []
    for i in range(1, bins + 1):
        b, c = _floored(f"b{i}", b_in, KL_FLOOR), _floored(f"c{i}", c_in, KL_FLOOR)
        terms.append(f"{c} * ln({c} / {b})")
    return F.expr(
        f"CASE WHEN bn = 0 OR cn = 0 THEN 0D WHEN {c_in} > 0 THEN {' + '.join(terms)} END"
    )


def _is_numeric(df: DataFrame, column: str) -> bool:
    return column in df.columns and isinstance(df.schema[column].dataType, T.NumericType)


def drift_scores(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    bins: int = BINS,
    approx: bool = False,
) -> DataFrame:
    """``psi_score`` and ``kl_divergence`` per column; null for unusable columns."""
    usable = [c for c in columns if _is_numeric(baseline, c) and _is_numeric(current, c)]
    spark = baseline.sparkSession
    names = F.array(*[F.lit(c) for c in columns])
    listed = spark.range(1).select(
        F.explode(names).alias("column_name"),
    ).withColumn("_usable", F.col("column_name").isin(usable))
    if not usable:
        empty = F.lit(None).cast("double")
        return listed.select(
            "column_name", empty.alias("psi_score"), empty.alias("kl_divergence")
        )
    base = unpivot_numeric(baseline, usable)
    long = unpivot_numeric(baseline, usable, [F.lit(True).alias("_base")]).unionByName(
        unpivot_numeric(current, usable, [F.lit(False).alias("_base")])
    )
    edges = baseline_edges(base, ["column_name"], bins, approx)
    binned = with_bin(long, edges, ["column_name"], bins)
    counts = binned.groupBy("column_name").agg(
        *bin_counts("_base", "b", bins), *bin_counts("NOT _base", "c", bins)
    )
    scored = counts.select(
        "column_name", psi_of_counts(bins).alias("_psi"), kl_of_counts(bins).alias("_kl"), F.lit(True).alias("_found")
    )
    # A column without baseline values scores 0, an unusable one stays null.
    zero = F.when(F.col("_found").isNull() & F.col("_usable"), F.lit(0.0))
    return listed.join(scored, "column_name", "left").select(
        "column_name",
        F.coalesce("_psi", zero).alias("psi_score"),
        F.coalesce("_kl", zero).alias("kl_divergence"),
    )


def psi(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS, approx: bool = False
) -> DataFrame:
    return drift_scores(baseline, current, columns, bins, approx).drop("kl_divergence")


def kl_divergence(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS, approx: bool = False
) -> DataFrame:
    return drift_scores(baseline, current, columns, bins, approx).drop("psi_score")


def _graded(scores: DataFrame, as_of: datetime) -> DataFrame:
    return scores.withColumns(
        {
            "drift_severity": drift_severity("psi_score"),
            "requires_action": drift_requires_action("psi_score"),
            "metric_timestamp": F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"),
        }
    )


def drift_multi_column(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    as_of: datetime,
    bins: int = BINS,
    approx: bool = False,
) -> DataFrame:
    """One graded row per column; an unusable column gives an ``error`` row."""
    return _graded(drift_scores(baseline, current, columns, bins, approx), as_of)


def population_drift(
    dim: DataFrame,
    current: DataFrame,
    as_of: datetime,
    columns: Sequence[str] = POPULATION_COLUMNS,
    approx: bool = False,
) -> DataFrame:
    """Scored population against the current patients."""
    baseline = current_records(dim) if "is_current_record" in dim.columns else dim
    shared = [c for c in columns if c in baseline.columns and c in current.columns]
    if shared:
        return drift_multi_column(baseline, current, shared, as_of, approx=approx)
    none = dim.sparkSession.range(1).select(
        F.lit("no_common_columns").alias("column_name"),
        F.lit(0.0).alias("psi_score"),
        F.lit(0.0).alias("kl_divergence"),
    )
    return _graded(none, as_of)


def key_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Repeatable sample by key hash: the same rows whatever the partitioning."""
    slot = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(SAMPLE_SLOTS))
    return df.where(slot < int(fraction * SAMPLE_SLOTS))


def drift_sampled(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    as_of: datetime,
    fraction: float = SAMPLE_FRACTION,
) -> DataFrame:
    """Drift estimated on a sample of both sides."""
    return drift_multi_column(
        key_sample(baseline, keys, fraction), key_sample(current, keys, fraction), columns, as_of
    )


def categorical_drift(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], as_of: datetime
) -> DataFrame:
    """The same two scores over label shares; a label may be missing on one side."""

    def labels(df: DataFrame, base: bool) -> DataFrame:
        pairs = [
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("label"))
            for c in columns
        ]
        return df.select(F.lit(base).alias("_base"), F.inline(F.array(*pairs))).where(
            F.col("label").isNotNull()
        )

    counts = (
        labels(baseline, True)
        .unionByName(labels(current, False))
        .groupBy("column_name", "label")
        .agg(F.count_if("_base").alias("b"), F.count_if(~F.col("_base")).alias("c"))
    )
    totals = counts.groupBy("column_name").agg(F.sum("b").alias("bn"), F.sum("c").alias("cn"))
    joined = counts.join(totals, "column_name")

    def scored(floor: float, weight: str, name: str) -> Column:
        b, c = _floored("b", "bn", floor), _floored("c", "cn", floor)
        term = f"{weight.format(b=b, c=c)} * ln({c} / {b})"
        return F.expr(
            f"CASE WHEN max(bn) = 0 OR max(cn) = 0 THEN 0D ELSE sum({term}) END AS {name}"
        )

    scores = joined.groupBy("column_name").agg(
        scored(PSI_FLOOR, "({c} - {b})", "psi_score"), scored(KL_FLOOR, "{c}", "kl_divergence")
    )
    return _graded(scores, as_of)





def drift_vs_baseline(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    window: Column,
    bins: int = BINS,
    approx: bool = False,
) -> DataFrame:
    """Every window of ``current`` against one baseline table.

    Baseline bins are counted once; windows meet them as one row each.
    """
    base = unpivot_numeric(baseline, columns)
    edges = baseline_edges(base, ["column_name"], bins, approx)
    base_counts = (
        with_bin(base, edges, ["column_name"], bins)
        .groupBy("column_name")
        .agg(*bin_counts("true", "b", bins), F.avg("x").alias("baseline_mean"))
    )
    long = unpivot_numeric(current, columns, [window.alias("window_start")])
    counts = (
        with_bin(long, edges, ["column_name"], bins)
        .groupBy("window_start", "column_name")
        .agg(*bin_counts("true", "c", bins), F.avg("x").alias("window_mean"))
    )
    return (
        counts.join(base_counts, "column_name")
        .select(
            "window_start",
            "column_name",
            F.lit("BASELINE").alias("drift_type"),
            F.col("cn").alias("window_count"),
            (F.col("window_mean") - F.col("baseline_mean")).alias("mean_shift"),
            psi_of_counts(bins).alias("psi_score"),
            kl_of_counts(bins).alias("kl_divergence"),
        )
        .withColumns(
            {
                "drift_severity": drift_severity("psi_score"),
                "requires_action": drift_requires_action("psi_score"),
            }
        )
    )


def drift_consecutive(
    df: DataFrame,
    columns: Sequence[str],
    window: Column,
    bins: int = BINS,
    approx: bool = False,
) -> DataFrame:
    """Every window against the active window before it.

    Each row takes part twice: as current value of its own window and as
    baseline of the next.  The table of windows is bounded by the time span.
    """
    marked = df.withColumn("_w", window)
    windows = marked.select("_w").distinct()
    following = windows.select(
        F.col("_w").alias("_w0"),
        F.lead("_w").over(Window.partitionBy(F.lit(0)).orderBy("_w")).alias("_next"),
    )
    long = unpivot_numeric(marked, columns, [F.col("_w")]).join(
        following, F.col("_w") == F.col("_w0")
    )
    roles = F.array(
        F.struct(F.col("_w").alias("window_start"), F.lit(False).alias("_base")),
        F.struct(F.col("_next").alias("window_start"), F.lit(True).alias("_base")),
    )
    keys = ["window_start", "column_name"]
    rows = long.select("column_name", "x", F.inline(roles)).where(
        F.col("window_start").isNotNull()
    )
    edges = baseline_edges(rows.where("_base"), keys, bins, approx)
    shift = F.expr("avg(CASE WHEN NOT _base THEN x END) - avg(CASE WHEN _base THEN x END)")
    counts = (
        with_bin(rows, edges, keys, bins)
        .groupBy(*keys)
        .agg(*bin_counts("_base", "b", bins), *bin_counts("NOT _base", "c", bins), shift.alias("mean_shift"))
    )
    return counts.select(
        *keys,
        F.lit("CONSECUTIVE").alias("drift_type"),
        F.col("cn").alias("window_count"),
        "mean_shift",
        psi_of_counts(bins).alias("psi_score"),
        kl_of_counts(bins).alias("kl_divergence"),
    ).withColumns(
        {
            "drift_severity": drift_severity("psi_score"),
            "requires_action": drift_requires_action("psi_score"),
        }
    )
