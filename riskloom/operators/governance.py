"""Model quality from scored rows joined to labels, per model version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.rules import RISK_BANDS, RISK_TOP, risk_category
from riskloom.functions.stats import n_rows, one_value, pct_of, quantiles, ratio
from riskloom.operators.drift import PSI_FLOOR

# Fixed values.
MIN_R2 = 0.70
MAX_MAE = 15.0
MIN_HIGH_RISK_ACCURACY = 0.60
MAE_TOLERANCE = 1.05
ACCURACY_TOLERANCE = 0.95
HIGH_RISK_QUANTILE = 0.95
RISK_LABELS = (*[label for _, label in RISK_BANDS], RISK_TOP)


def _error_aggs(label: str, prediction: str) -> dict[str, Column]:
    y = F.when(F.col(prediction).isNotNull(), F.col(label))
    e = F.col(label) - F.col(prediction)
    total = F.var_pop(y) * F.count(y)
    return {
        "r2_score": F.lit(1.0) - ratio(F.sum(e * e), total),
        "mae": F.avg(F.abs(e)),
        "rmse": F.sqrt(F.avg(e * e)),
    }


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Error figures of the whole table, or a row per group, such as a model version."""
    aggs = _error_aggs(label, prediction)
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in aggs.items()])


def target_stats(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.avg(label).alias("target_mean"),
        F.stddev_samp(label).alias("target_std"),
        F.min(label).alias("target_min"),
        F.max(label).alias("target_max"),
    )


def high_risk_accuracy(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    approx: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of rows on the same side of the labels' 95th percentile, whole or per group."""
    by = list(by)
    limits = quantiles(df, label, [HIGH_RISK_QUANTILE], ["_limit"], by=by, approx=approx)
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    if by:
        rows = known.select(*by, label, prediction).join(limits, by)
    else:
        rows = known.withColumn("_limit", one_value(limits, "_limit"))
    same = (F.col(label) >= F.col("_limit")) == (F.col(prediction) >= F.col("_limit"))
    return rows.groupBy(*by).agg(
        F.max("_limit").alias("high_risk_threshold"),
        n_rows().alias("labelled_rows"),
        ratio(F.count_if(same), n_rows()).alias("high_risk_accuracy"),
    )


def version_metrics(
    df: DataFrame,
    version: str = "model_version",
    label: str = "label",
    prediction: str = "prediction",
    approx: bool = False,
) -> DataFrame:
    """Error figures per version; a version without labels has null figures."""
    limits = quantiles(
        df, label, [HIGH_RISK_QUANTILE], ["_limit"], by=[version], approx=approx
    )
    rows = df.select(version, label, prediction).join(limits, version, "left")
    known = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    same = (F.col(label) >= F.col("_limit")) == (F.col(prediction) >= F.col("_limit"))
    return rows.groupBy(version).agg(
        F.count_if(known).alias("labelled_rows"),
        *[c.alias(name) for name, c in _error_aggs(label, prediction).items()],
        ratio(F.count_if(known & same), F.count_if(known)).alias("high_risk_accuracy"),
    )


def passes_gate(r2: Column, mae: Column, accuracy: Column) -> Column:
    """Bounds included; a missing figure fails."""
    ok = (r2 >= MIN_R2) & (mae <= MAX_MAE) & (accuracy >= MIN_HIGH_RISK_ACCURACY)
    return F.coalesce(ok, F.lit(False))


def governance_gate(df: DataFrame, approx: bool = False) -> DataFrame:
    m = version_metrics(df, approx=approx)

    def check(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return m.withColumns(
        {
            "r2_pass": check(F.col("r2_score") >= MIN_R2),
            "mae_pass": check(F.col("mae") <= MAX_MAE),
            "accuracy_pass": check(F.col("high_risk_accuracy") >= MIN_HIGH_RISK_ACCURACY),
            "gate_passed": passes_gate(
                F.col("r2_score"), F.col("mae"), F.col("high_risk_accuracy")
            ),
        }
    )


def champion_version(df: DataFrame, champion: str | None) -> Column:
    """The named version if it has rows, else the highest version number."""
    number = F.max(F.col("model_version").try_cast("int")).cast("string")
    named = F.max(F.when(F.col("model_version") == F.lit(champion), F.col("model_version")))
    pick = F.coalesce(named, number) if champion is not None else number
    return one_value(df.agg(pick.alias("version")), "version")


def latest_version_rows(df: DataFrame, champion: str | None = None) -> DataFrame:
    """The version is a scalar subquery over one column, not a join."""
    return df.where(F.col("model_version") == champion_version(df, champion))


def challenger_vs_champion(
    df: DataFrame, champion: str, challenger: str, approx: bool = False
) -> DataFrame:
    """Strictly better fit, at most 5 % worse otherwise, and the gate passed."""
    both = df.where(F.col("model_version").isin(champion, challenger))
    m = version_metrics(both, approx=approx)

    def of(version: str, column: str) -> Column:
        return F.max(F.when(F.col("model_version") == version, F.col(column)))

    wide = m.agg(
        *[
            of(v, c).alias(f"{who}_{c}")
            for who, v in (("champion", champion), ("challenger", challenger))
            for c in ("r2_score", "mae", "high_risk_accuracy")
        ]
    )

    def c(name: str) -> Column:
        return F.col(name)

    better = (
        (c("challenger_r2_score") > c("champion_r2_score"))
        & (c("challenger_mae") <= c("champion_mae") * MAE_TOLERANCE)
        & (
            c("challenger_high_risk_accuracy")
            >= c("champion_high_risk_accuracy") * ACCURACY_TOLERANCE
        )
    )
    gate = passes_gate(
        c("challenger_r2_score"), c("challenger_mae"), c("challenger_high_risk_accuracy")
    )
    return wide.withColumns(
        {
            "challenger_better": F.coalesce(better, F.lit(False)),
            "challenger_gate": gate,
            "promote": F.coalesce(better & gate, F.lit(False)),
        }
    )


def newest_version() -> list[Column]:
    """Order by version number, highest first; versions without one come last, by name."""
    number = F.col("model_version").try_cast("int")
    return [number.desc_nulls_last(), F.col("model_version").desc()]


def compare_versions(df: DataFrame, n: int = 3, approx: bool = False) -> DataFrame:
    """The newest ``n`` versions, newest first, and which of them fits best."""
    newest = (
        version_metrics(df, approx=approx)
        .orderBy(*newest_version())
        .limit(n)
    )
    order = [F.col("r2_score").desc_nulls_last(), *newest_version()]
    best = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) == 1
    return newest.withColumn("is_best", best)


def serving_metrics(df: DataFrame, champion: str | None, approx: bool = False) -> DataFrame:
    """``version_metrics`` of the serving version: the named one if it has rows, else the
    highest number.  It is picked from the few rows of figures, not by a scan of its own."""
    return version_metrics(df, approx=approx).orderBy(
        # The champion first, then as ``newest_version``.
        F.col("model_version").eqNullSafe(F.lit(champion).cast("string")).desc(), *newest_version()
    ).limit(1)


def model_metrics(df: DataFrame, champion: str | None = None, approx: bool = False) -> DataFrame:
    """Figures of the serving version, to four places."""
    return serving_metrics(df, champion, approx).select(
        F.col("model_version").try_cast("int").alias("champion_version"),
        *[F.round(c, 4).alias(c) for c in ("r2_score", "mae", "rmse", "high_risk_accuracy")],
    )


def governance_status(df: DataFrame, champion: str | None = None, approx: bool = False) -> DataFrame:
    """COMPLIANT / REQUIRES_REVIEW by the gate, UNKNOWN without labelled rows."""
    m = serving_metrics(df, champion, approx)
    passed = F.max(passes_gate(F.col("r2_score"), F.col("mae"), F.col("high_risk_accuracy")))
    known = F.coalesce(F.sum("labelled_rows"), F.lit(0)) > 0
    return m.agg(
        F.max("model_version").alias("model_version"),
        F.max("r2_score").alias("r2_score"),
        F.max("mae").alias("mae"),
        F.max("high_risk_accuracy").alias("high_risk_accuracy"),
        F.when(~known, "UNKNOWN")
        .when(passed, "COMPLIANT")
        .otherwise("REQUIRES_REVIEW")
        .alias("governance_status"),
    )


def shadow_compare(
    df: DataFrame,
    first: str,
    second: str,
    key: str = "event_id",
    by: str = "patient_region",
) -> DataFrame:
    """Same rows scored by two versions.

    Both scores of a row are brought together by one aggregate on its unique
    key, which shuffles the log once where a self join would do it twice.
    """

    def score(version: str) -> Column:
        return F.max(F.when(F.col("model_version") == version, F.col("prediction")))

    pairs = (
        df.where(F.col("model_version").isin(first, second))
        .groupBy(key, by)
        .agg(score(first).alias("a"), score(second).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )
    gap = F.abs(F.col("a") - F.col("b"))
    moved = risk_category(F.col("a")) != risk_category(F.col("b"))
    return pairs.groupBy(by).agg(
        n_rows().alias("compared_rows"),
        F.avg(gap).alias("mean_abs_difference"),
        F.max(gap).alias("max_abs_difference"),
        pct_of(F.count_if(moved), n_rows()).alias("category_changed_pct"),
    )


def version_distribution_shift(df: DataFrame, base: str) -> DataFrame:
    """Category mix per version and its stability index against ``base``."""
    counts = (
        # A missing score is in no band.
        df.where(F.col("prediction").isNotNull())
        .withColumn("risk_category", risk_category("prediction"))
        .groupBy("model_version", "risk_category")
        .agg(n_rows().alias("prediction_count"))
    )
    # From here on there is one row per version and category.
    total = F.sum("prediction_count").over(Window.partitionBy("model_version"))
    shares = counts.withColumn("_share", ratio(F.col("prediction_count"), total))
    labels = F.array(*[F.lit(label) for label in RISK_LABELS])
    grid = counts.select("model_version").distinct().withColumn(
        "risk_category", F.explode(labels)
    )
    base_shares = shares.where(F.col("model_version") == base).select(
        "risk_category", F.col("_share").alias("_base_share")
    )
    full = (
        grid.join(shares, ["model_version", "risk_category"], "left")
        .join(base_shares, "risk_category", "left")
        .withColumns(
            {
                "_c": F.coalesce("_share", F.lit(PSI_FLOOR)),
                "_b": F.coalesce("_base_share", F.lit(PSI_FLOOR)),
            }
        )
    )
    term = (F.col("_c") - F.col("_b")) * F.ln(F.col("_c") / F.col("_b"))
    return full.select(
        "model_version",
        "risk_category",
        F.coalesce("prediction_count", F.lit(0)).alias("prediction_count"),
        (F.coalesce("_share", F.lit(0.0)) * 100).alias("share_pct"),
        F.sum(term).over(Window.partitionBy("model_version")).alias("psi_to_base"),
    )
