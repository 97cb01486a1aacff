"""Model training and scoring as distributed ML pipelines.

Encoding and scaling are DataFrame expressions, fitting and scoring run on
executors; the driver only holds the fitted model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from riskloom.functions.stats import one_value, quantiles
from riskloom.operators.features import (
    CATEGORICAL_FEATURES,
    FEATURE_KEY,
    LABEL,
    LOOKUP_FEATURES,
    NUMERIC_FEATURES,
    feature_lookup,
)
from riskloom.operators.governance import HIGH_RISK_QUANTILE, regression_metrics
from riskloom.operators.scoring import apply_score_rules
from riskloom.session import work_dir

# Fixed values.
TEST_PCT = 20
SEED = 42
FOLDS = 5
# Folds that are fitted at a time; each keeps its rows and their nodes in the executors' storage.
AT_ONCE = 2
FOREST = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "seed": SEED}
BOOSTING = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "seed": SEED}
VECTOR = "_features"


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code) with codes in sorted order of the distinct values."""
    values = df.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    # One row per label of a category column.
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("value"))
    return values.withColumn("code", position - 1)


def label_encode(df: DataFrame, column: str, codes: DataFrame, out: str | None = None) -> DataFrame:
    """Add the code of ``column``; values unknown to ``codes`` become 0."""
    known = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(known, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(out or f"{column}_code", F.coalesce("_code", F.lit(0))).drop(
        "_value", "_code"
    )


def _moments(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, deviation), the deviation of the population."""
    names = list(enumerate(columns))
    sums = source.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in names],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in names],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("deviation"))
        for i, c in names
    ]
    return sums.select(F.inline(F.array(*rows)))


def scale_by(df: DataFrame, fitted: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """z-scores by a table of moments; a constant column is only centred."""
    entry = F.struct("column", F.struct("mean", "deviation"))
    # One entry per listed column.
    table = fitted.where(F.col("column").isin(*columns)).agg(
        F.map_from_entries(F.collect_list(entry)).alias("moments")
    )
    moments = one_value(table, "moments")

    def scaled(c: str) -> Column:
        own = moments[c]
        deviation = F.when(own["deviation"] == 0, 1.0).otherwise(own["deviation"])
        return (F.col(c).cast("double") - own["mean"]) / deviation

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def standard_scale(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_scaled"
) -> DataFrame:
    """z-scores by the population deviation; a constant column is only centred."""
    return scale_by(df, _moments(fit_on if fit_on is not None else df, columns), columns, suffix)


def key_slot(key: Column | str, slots: int) -> Column:
    """A slot by the MD5 of the key's text, for keys of any kind."""
    column = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(column.cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots))


def train_test_split(df: DataFrame, key: Column | str, test_pct: int = TEST_PCT) -> DataFrame:
    """Split by a hash of the key: stable under any partitioning."""
    return df.withColumn("is_test", key_slot(key, 100) < test_pct)


INPUTS = (*NUMERIC_FEATURES, *[f"{c}_code" for c in CATEGORICAL_FEATURES])
PREPARATION = "column string, value string, code int, mean double, deviation double"


def fit_preparation(rows: DataFrame) -> DataFrame:
    """Label codes and moments of the model's inputs as one small table: a row per
    label of a category and per input."""
    none = {t: F.lit(None).cast(t) for t in ("string", "int", "double")}
    encoded, codes = rows, []
    for c in CATEGORICAL_FEATURES:
        own = label_codes(rows, c)
        encoded = label_encode(encoded, c, own)
        codes.append(
            own.select(
                F.lit(c).alias("column"), F.col("value").cast("string").alias("value"), "code",
                none["double"].alias("mean"), none["double"].alias("deviation"),
            )
        )
    moments = _moments(encoded, INPUTS).select(
        "column", none["string"].alias("value"), none["int"].alias("code"), "mean", "deviation"
    )
    return reduce(DataFrame.unionByName, [*codes, moments])


def prepare(df: DataFrame, preparation: DataFrame) -> DataFrame:
    """Encode, scale and assemble the model's input vector by a fitted preparation."""
    out = df
    for c in CATEGORICAL_FEATURES:
        known = preparation.where((F.col("column") == c) & F.col("code").isNotNull())
        out = label_encode(out, c, known)
    scaled = scale_by(out, preparation.where("code IS NULL"), INPUTS)
    assembler = VectorAssembler(
        inputCols=[f"{c}_scaled" for c in INPUTS], outputCol=VECTOR, handleInvalid="keep"
    )
    return assembler.transform(scaled)


@dataclass(frozen=True)
class Fitted:
    """A model together with the preparation that it was fitted with."""

    model: Model
    preparation: DataFrame


def save_model(fitted: Fitted, path: str) -> None:
    PipelineModel(stages=[fitted.model]).write().overwrite().save(f"{path}/model")
    fitted.preparation.write.mode("overwrite").parquet(f"{path}/preparation")


def load_model(spark: SparkSession, path: str) -> Fitted:
    """A model as it was saved; needs no training rows."""
    preparation = spark.read.schema(PREPARATION).parquet(f"{path}/preparation")
    return Fitted(PipelineModel.load(f"{path}/model"), preparation)


def random_forest(label: str = LABEL, **overrides) -> RandomForestRegressor:
    """Every split looks at all features; a minimum split size has no equivalent.

    The node that a row has reached in each tree is kept, so a pass over the rows does
    not walk down all trees again.
    """
    settings = {**FOREST, "featureSubsetStrategy": "all", "cacheNodeIds": True, **overrides}
    return RandomForestRegressor(featuresCol=VECTOR, labelCol=label, **settings)


def gradient_boosting(label: str = LABEL, **overrides) -> GBTRegressor:
    return GBTRegressor(featuresCol=VECTOR, labelCol=label, **{**BOOSTING, **overrides})


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared work folder and read them back.

    Fitting passes over its input hundreds of times; from a table each pass is
    a scan instead of the joins behind it, also after an executor is lost.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def labelled(training: DataFrame, label: str = LABEL) -> DataFrame:
    return training.where(F.col(label).isNotNull())


def fit(training: DataFrame, estimator, label: str = LABEL) -> tuple[Fitted, DataFrame]:
    """Model fitted on the train part, and the scored test part."""
    rows = labelled(training, label)
    preparation = materialize(fit_preparation(rows), "preparation")
    ready = train_test_split(prepare(rows, preparation), FEATURE_KEY)
    ready = materialize(ready.select(FEATURE_KEY, label, VECTOR, "is_test"), "training")
    model = estimator.fit(ready.where(~F.col("is_test")))
    return Fitted(model, preparation), model.transform(ready.where("is_test"))


def evaluate(scored: DataFrame, all_rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Test metrics.  The high-risk limit comes from all labels, not the test part."""
    errors = regression_metrics(scored, label)
    limit = one_value(quantiles(all_rows, label, [HIGH_RISK_QUANTILE], ["limit"]), "limit")
    same = (F.col(label) >= limit) == (F.col("prediction") >= limit)
    accuracy = scored.select(same.alias("_same")).agg(
        F.avg(F.col("_same").cast("double")).alias("high_risk_accuracy")
    )
    return errors.withColumn("high_risk_accuracy", one_value(accuracy, "high_risk_accuracy"))


def score_batch(dim: DataFrame, features: DataFrame, fitted: Fitted) -> DataFrame:
    """Look up features by key, apply the fitted preparation, predict, apply rules.

    The patient's own columns ride along, so no join back is needed.
    """
    base = dim.withColumn(FEATURE_KEY, F.col("patient_natural_key"))
    ready = prepare(feature_lookup(base, features, LOOKUP_FEATURES), fitted.preparation)
    return apply_score_rules(fitted.model.transform(ready).select(*base.columns, "prediction"))


def cross_validation_r2(
    training: DataFrame, estimator, folds: int = FOLDS, label: str = LABEL
) -> DataFrame:
    """R² per fold with mean and population deviation over the folds.

    Folds come from the key hash: cutting the table into contiguous parts would
    need a global sort in one partition.  AT_ONCE folds are fitted at a time, as the
    passes of one fit leave cores idle.
    """
    rows = labelled(training, label)
    preparation = materialize(fit_preparation(rows), "preparation")
    ready = prepare(rows, preparation).withColumn("_fold", key_slot(FEATURE_KEY, folds))
    ready = materialize(ready.select(label, VECTOR, "_fold"), "folds")

    def score(fold: int) -> DataFrame:
        model = estimator.copy().fit(ready.where(F.col("_fold") != fold))
        scored = model.transform(ready.where(F.col("_fold") == fold))
        return regression_metrics(scored, label).select(F.lit(fold).alias("fold"), "r2_score")

    with ThreadPool(AT_ONCE) as pool:
        scores = pool.map(inheritable_thread_target(training.sparkSession)(score), range(folds), chunksize=1)
    table = reduce(DataFrame.unionByName, scores)
    everything = Window.partitionBy(F.lit(0))
    return table.withColumns(
        {
            "cv_r2_mean": F.avg("r2_score").over(everything),
            "cv_r2_std": F.stddev_pop("r2_score").over(everything),
        }
    )
