"""Queries over model training, quality and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import features, governance, training
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r
from riskloom.session import work_dir
from riskloom.sources import testdata as td

SLOT_SQL = "cast('0x' || substr(md5(customer_id), 1, 8) as bigint)"


def training_rows(spark, sf_dir):
    dim = td.dim_patients(spark, sf_dir)
    return features.training_set(dim, features.build_feature_table(dim))


def _encode(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    # Codes are learnt without one region, which is then an unknown label.
    known = rows.where(F.col("region") != "SOUTHEAST")
    for c in features.CATEGORICAL_FEATURES:
        rows = training.label_encode(rows, c, training.label_codes(known, c))
    return rows.select("customer_id", "sex", "region", "sex_code", "region_code")


register(
    "label_encode",
    _encode,
    oracle(
        "WITH known AS (SELECT region, dense_rank() OVER (ORDER BY region) - 1 AS code "
        "FROM (SELECT DISTINCT region FROM features WHERE region <> 'SOUTHEAST')) "
        "SELECT customer_id, sex, f.region, CASE sex WHEN 'F' THEN 0 ELSE 1 END AS sex_code, "
        "cast(coalesce(code, 0) as int) AS region_code FROM features f LEFT JOIN known k "
        "ON f.region = k.region"
    ),
)
SCALED = ("smoking_impact", "family_size_factor", "data_quality_score")
register(
    "standard_scale",
    lambda s, d: training.standard_scale(training_rows(s, d), SCALED).select(
        "customer_id", *[f"{c}_scaled" for c in SCALED]
    ),
    oracle(
        "SELECT customer_id, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) "
            f"AS {c}_scaled"
            for c in SCALED
        )
        + " FROM features"
    ),
)
register(
    "train_test_split",
    lambda s, d: training.train_test_split(training_rows(s, d), "customer_id").select(
        "customer_id", "is_test"
    ),
    oracle(f"SELECT customer_id, {SLOT_SQL} % 100 < 20 AS is_test FROM features"),
)
register(
    "cross_validation_folds",
    lambda s, d: training_rows(s, d).select(
        "customer_id", training.key_slot("customer_id", training.FOLDS).alias("fold")
    ),
    oracle(f"SELECT customer_id, {SLOT_SQL} % {training.FOLDS} AS fold FROM features"),
)


def _prepared(spark, sf_dir):
    """Inputs by a preparation that was stored and read back."""
    rows = training_rows(spark, sf_dir)
    path = work_dir(spark, "preparation")
    training.fit_preparation(rows).write.parquet(path)
    stored = spark.read.schema(training.PREPARATION).parquet(path)
    names = [f"{c}_scaled" for c in (*SCALED, "sex_code", "region_code")]
    return training.prepare(rows, stored).select("customer_id", *names)


def _scaled_sql(column: str) -> str:
    return (
        f"round(({column} - avg({column}) OVER ()) / coalesce(nullif(stddev_pop({column}) OVER (), 0), 1), 6) "
        f"AS {column}_scaled"
    )


register(
    "prepared_inputs",
    _prepared,
    oracle(
        "WITH coded AS (SELECT *, dense_rank() OVER (ORDER BY sex) - 1 AS sex_code, "
        "dense_rank() OVER (ORDER BY region) - 1 AS region_code FROM features) SELECT customer_id, "
        + ", ".join(_scaled_sql(c) for c in (*SCALED, "sex_code", "region_code"))
        + " FROM coded"
    ),
)


def _train(estimator):
    def run(spark, sf_dir):
        rows = training_rows(spark, sf_dir)
        _, scored = training.fit(rows, estimator())
        return training.evaluate(scored, training.labelled(rows))

    return run


register("train_random_forest", _train(training.random_forest))
register("train_gradient_boosting", _train(training.gradient_boosting))


def _score_batch(spark, sf_dir):
    dim = td.dim_patients(spark, sf_dir)
    table = features.build_feature_table(dim)
    rows = training.labelled(features.training_set(dim, table))
    fitted, _ = training.fit(rows, training.random_forest())
    return training.score_batch(dim, table, fitted)


register("score_batch", _score_batch)


def _score_reloaded(spark, sf_dir):
    """A saved model scores as before after the training rows are gone."""
    dim = td.dim_patients(spark, sf_dir)
    table = features.build_feature_table(dim)
    rows = training.labelled(features.training_set(dim, table))
    path = work_dir(spark, "model")
    training.save_model(training.fit(rows, training.random_forest())[0], path)
    return training.score_batch(dim, table, training.load_model(spark, path))


register("score_batch_reloaded", _score_reloaded)
register(
    "cross_validation_r2",
    lambda s, d: training.cross_validation_r2(training_rows(s, d), training.random_forest()),
)

ERRORS = (
    "1 - sum((label - prediction) * (label - prediction)) / nullif(var_pop(label) * count(label), 0)"
)
METRICS_SQL = (
    f"{ERRORS} AS r2_score, avg(abs(label - prediction)) AS mae, "
    "sqrt(avg((label - prediction) * (label - prediction))) AS rmse"
)
ROUNDED = f"{r('r2_score', 'r2_score')}, {r('mae', 'mae')}, {r('rmse', 'rmse')}"
register(
    "regression_metrics",
    lambda s, d: governance.regression_metrics(td.scored_versions(s, d), by=["model_version"]),
    oracle(
        f"WITH m AS (SELECT model_version, {METRICS_SQL} FROM versions GROUP BY 1) SELECT model_version, {ROUNDED} FROM m"
    ),
)
register(
    "high_risk_accuracy",
    lambda s, d: governance.high_risk_accuracy(td.scored_versions(s, d), by=["model_version"]),
    oracle(
        "WITH q AS (SELECT model_version, quantile_cont(label, 0.95) AS t FROM versions GROUP BY 1) "
        "SELECT model_version, round(max(t), 6) AS high_risk_threshold, count(*) AS labelled_rows, "
        "round(avg(cast((label >= t) = (prediction >= t) as int)), 6) AS high_risk_accuracy "
        "FROM versions JOIN q USING (model_version) GROUP BY 1"
    ),
)
register(
    "target_stats",
    lambda s, d: governance.target_stats(
        training.labelled(training_rows(s, d)), "health_risk_score"
    ),
    oracle(
        f"SELECT {r('avg(health_risk_score)', 'target_mean')}, "
        f"{r('stddev_samp(health_risk_score)', 'target_std')}, min(health_risk_score) AS target_min, "
        "max(health_risk_score) AS target_max FROM features"
    ),
)
VERSION_CTE = (
    "lim AS (SELECT model_version, quantile_cont(label, 0.95) AS t FROM versions GROUP BY 1), "
    f"vm AS (SELECT model_version, count(label) AS labelled_rows, {METRICS_SQL}, "
    "avg(cast((label >= t) = (prediction >= t) as int)) AS high_risk_accuracy "
    "FROM versions JOIN lim USING (model_version) GROUP BY 1)"
)
ACCURACY = r("high_risk_accuracy", "high_risk_accuracy")
GATE = "r2_score >= 0.7 AND mae <= 15 AND high_risk_accuracy >= 0.6"
register(
    "governance_gate",
    lambda s, d: governance.governance_gate(td.scored_versions(s, d)),
    oracle(
        f"WITH {VERSION_CTE} SELECT model_version, labelled_rows, {ROUNDED}, {ACCURACY}, "
        "r2_score >= 0.7 AS r2_pass, mae <= 15 AS mae_pass, "
        f"high_risk_accuracy >= 0.6 AS accuracy_pass, {GATE} AS gate_passed FROM vm"
    ),
)
register(
    "challenger_vs_champion",
    lambda s, d: governance.challenger_vs_champion(td.scored_versions(s, d), "1", "2"),
    oracle(
        f"WITH {VERSION_CTE}, x AS (SELECT a.r2_score AS ar, a.mae AS am, a.high_risk_accuracy AS aa, "
        "b.r2_score AS br, b.mae AS bm, b.high_risk_accuracy AS ba FROM vm a, vm b "
        "WHERE a.model_version = '1' AND b.model_version = '2'), y AS (SELECT *, "
        "br > ar AND bm <= am * 1.05 AND ba >= aa * 0.95 AS better, "
        "br >= 0.7 AND bm <= 15 AND ba >= 0.6 AS gate FROM x) "
        "SELECT round(ar, 6) AS champion_r2_score, round(am, 6) AS champion_mae, "
        "round(aa, 6) AS champion_high_risk_accuracy, round(br, 6) AS challenger_r2_score, "
        "round(bm, 6) AS challenger_mae, round(ba, 6) AS challenger_high_risk_accuracy, "
        "better AS challenger_better, gate AS challenger_gate, better AND gate AS promote FROM y"
    ),
)
register(
    "latest_version_rows",
    lambda s, d: governance.latest_version_rows(td.scored_versions(s, d), "7").select(
        "event_id", "model_version", "prediction"
    ),
    oracle(
        "SELECT event_id, model_version, round(prediction, 6) AS prediction FROM versions "
        "WHERE model_version = '3'"
    ),
)
register(
    "compare_versions",
    lambda s, d: governance.compare_versions(td.scored_versions(s, d), 2),
    oracle(
        f"WITH {VERSION_CTE}, top AS (SELECT * FROM vm ORDER BY cast(model_version as int) DESC "
        f"LIMIT 2) SELECT model_version, labelled_rows, {ROUNDED}, {ACCURACY}, "
        "row_number() OVER (ORDER BY top.r2_score DESC) = 1 AS is_best FROM top"
    ),
)
register(
    "shadow_compare",
    lambda s, d: governance.shadow_compare(td.scored_versions(s, d), "1", "3"),
    oracle(
        "WITH p AS (SELECT a.patient_region, a.prediction AS x, b.prediction AS y FROM versions a "
        "JOIN versions b ON a.event_id = b.event_id AND a.model_version = '1' "
        "AND b.model_version = '3') SELECT patient_region, count(*) AS compared_rows, "
        "round(avg(abs(x - y)), 6) AS mean_abs_difference, "
        "round(max(abs(x - y)), 6) AS max_abs_difference, "
        "round(count(*) FILTER (WHERE (CASE WHEN x < 30 THEN 1 WHEN x < 60 THEN 2 WHEN x < 85 "
        "THEN 3 ELSE 4 END) <> (CASE WHEN y < 30 THEN 1 WHEN y < 60 THEN 2 WHEN y < 85 THEN 3 "
        "ELSE 4 END)) * cast(100 as double) / count(*), 6) AS category_changed_pct "
        "FROM p GROUP BY 1"
    ),
)
register(
    "version_distribution_shift",
    lambda s, d: governance.version_distribution_shift(td.scored_versions(s, d), "1"),
    oracle(
        "WITH c AS (SELECT model_version, CASE WHEN prediction < 30 THEN 'low' "
        "WHEN prediction < 60 THEN 'medium' WHEN prediction < 85 THEN 'high' ELSE 'critical' END "
        "AS risk_category, count(*) AS n FROM versions GROUP BY 1, 2), "
        "g AS (SELECT v.model_version, k.risk_category, coalesce(c.n, 0) AS n FROM "
        "(SELECT DISTINCT model_version FROM c) v CROSS JOIN (VALUES ('low'), ('medium'), ('high'), ('critical')) k(risk_category) "
        "LEFT JOIN c ON c.model_version = v.model_version AND c.risk_category = k.risk_category), "
        "h AS (SELECT *, n * cast(1 as double) / sum(n) OVER (PARTITION BY model_version) AS s FROM g), "
        "j AS (SELECT h.*, CASE WHEN h.n = 0 THEN 0.0001 ELSE h.s END AS cs, "
        "CASE WHEN b.n = 0 THEN 0.0001 ELSE b.s END AS bs FROM h JOIN h b "
        "ON b.model_version = '1' AND b.risk_category = h.risk_category) "
        "SELECT model_version, risk_category, n AS prediction_count, round(s * 100, 6) AS share_pct, "
        "round(sum((cs - bs) * ln(cs / bs)) OVER (PARTITION BY model_version), 6) + cast(0 as double) "
        "AS psi_to_base FROM j"
    ),
)
register(
    "model_metrics",
    lambda s, d: governance.model_metrics(td.scored_versions(s, d), td.CHAMPION),
    oracle(
        f"WITH {VERSION_CTE} SELECT 1 AS champion_version, round(vm.r2_score, 4) AS r2_score, "
        "round(vm.mae, 4) AS mae, round(vm.rmse, 4) AS rmse, "
        "round(vm.high_risk_accuracy, 4) AS high_risk_accuracy FROM vm WHERE model_version = '1'"
    ),
)
register(
    "governance_status",
    lambda s, d: governance.governance_status(td.scored_versions(s, d), "3"),
    oracle(
        f"WITH {VERSION_CTE} SELECT model_version, {r('vm.r2_score', 'r2_score')}, "
        f"{r('vm.mae', 'mae')}, {r('vm.high_risk_accuracy', 'high_risk_accuracy')}, "
        f"CASE WHEN {GATE} THEN 'COMPLIANT' ELSE 'REQUIRES_REVIEW' END AS governance_status "
        "FROM vm WHERE model_version = '3'"
    ),
)
