"""The full batch pipeline and its drift routing (D10, §3.1).

reference profile (stage 7) -> drift (stage 2) -> route: on drift or first
run, retrain (transform, features, training) and then predict; otherwise
predict with the stored artifacts. Every stage is timed into the metric
table. Intermediate tables and artifacts live under ``workdir`` (shared
storage on a cluster).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from ..functions.kernels import LONG_CALCULATORS, SHORT_CALCULATORS, expand
from ..ml import score as SC
from ..ml import stages as S
from ..ml import train as T
from ..operators import drift as D
from ..operators import metric_rows as R
from ..operators.evaluate import evaluation_metrics, prediction_table
from ..operators.features import join_feature_sets
from ..operators.label import true_rul
from ..operators.quality import MetricsTable
from ..schema import META_DROP, sensor_columns
from ..sinks.tables import load_reference, save_reference, write_report, write_table


def _at(workdir: str, name: str) -> str:
    return f"{workdir.rstrip('/')}/{name}"


def build_reference(train: DataFrame, workdir: str) -> None:
    """Stage 7: profile and fleet shape of the training table."""
    save_reference(D.reference_profile(train), D.fleet_shape(train), D.value_counts(train, sensor_columns(train.columns)), _at(workdir, "reference"))


def drift_stage(spark: SparkSession, test: DataFrame, workdir: str, bad_rows: int = 0) -> dict:
    """Stage 2: the verdict (first run when no reference is stored; unreadable input counts as drift)."""
    ref = load_reference(spark, _at(workdir, "reference"))
    if ref is None:
        parts = D.detect_drift(None, None, None, test)
    else:
        parts = D.detect_drift(ref[0], ref[1], None, test, ref_counts=ref[2])
        if bad_rows:
            parts = parts | {"summary": D.with_unreadable(parts["summary"], bad_rows)}
    write_report(parts, _at(workdir, "drift_report"))
    return parts


def train_stage(spark: SparkSession, train: DataFrame, workdir: str, configs: list[dict] | None = None,
                metrics: MetricsTable | None = None, rows_before: int | None = None) -> dict:
    """Stages 3-5: fit preprocessing and feature pipelines, tune, save a new version of the artifacts."""
    pre = S.preprocessor().fit(train)
    x, kept = R.observed_write(pre.transform(train), _at(workdir, "preprocessed"))
    if metrics:
        metrics.record_rows("data_transformation", R.transformation(rows_before or kept["rows"], kept["rows"], train.columns, x.columns, META_DROP))
    start = time.time()
    lm = S.long_pipeline().fit(x)
    mid = time.time()
    sm = S.short_pipeline().fit(x)
    taken = {"long_term": mid - start, "short_term": time.time() - mid}
    feats = join_feature_sets(lm.transform(x), sm.transform(x))
    write_table(feats, _at(workdir, "features"))
    feats = spark.read.parquet(_at(workdir, "features"))   # lineage cut at the stage table
    data, inputs = T.training_set(feats)
    res = T.tune(spark, T.with_folds(data), inputs, configs)
    samples = res["matrix"].rows
    write_table(T.trials_table(spark, res["trials"]), _at(workdir, "trials"))
    write_table(T.cv_table(spark, res["best"]), _at(workdir, "cv_results"))
    write_table(T.cv_summary(T.cv_table(spark, res["best"]), samples, len(inputs)), _at(workdir, "training_metrics"))
    better = T.improvement_over_baseline(data, res["best"]["test_rmse"])
    write_table(better, _at(workdir, "improvement"))
    write_table(T.importance_table(spark, res["model"], inputs, top=None), _at(workdir, "importance"))
    if metrics:
        sensors = len(sensor_columns(x.columns))
        metrics.record_rows("feature_engineering", R.features(sensors * len(expand(LONG_CALCULATORS)), sensors * len(expand(SHORT_CALCULATORS)), len(inputs) - 1, taken))
        metrics.record_rows("model_training", R.training(res["best"]["folds"], res["best"]["model_type"], samples, len(res["trials"]), better.first()["improvement_pct"]))
    res["version"] = SC.save_artifacts(spark, _at(workdir, "artifacts"), pre, lm, sm, res["model"], inputs)
    return res


def predict_stage(spark: SparkSession, test: DataFrame, workdir: str, metrics: MetricsTable | None = None) -> dict:
    """Stage 6: score the last window per unit, evaluate against known RUL."""
    start = time.time()
    art = SC.load_artifacts(spark, _at(workdir, "artifacts"))
    raw = test.drop("rul") if "rul" in test.columns else test
    write_table(SC.score(raw, art), _at(workdir, "predictions"))
    scored = spark.read.parquet(_at(workdir, "predictions"))
    write_table(SC.score_summary(raw, scored), _at(workdir, "prediction_summary"))
    out = {"scored": scored, "version": art["version"], "summary": spark.read.parquet(_at(workdir, "prediction_summary"))}
    taken, found = time.time() - start, None
    truth = true_rul(test)
    if truth is not None:
        write_table(truth.withColumnRenamed("unit_id", "engine_id"), _at(workdir, "true_rul"))
        truth = spark.read.parquet(_at(workdir, "true_rul"))
        pred = scored.select("engine_id", "predicted_rul")
        out["table"] = prediction_table(pred, truth)
        out["metrics"] = evaluation_metrics(pred, truth)
        write_table(out["metrics"], _at(workdir, "evaluation"))
        found = out["metrics"].first()
    if metrics:
        metrics.record_rows("model_prediction", R.prediction(scored, taken, found.asDict() if found else None))
    return out


def run_pipeline(spark: SparkSession, train: DataFrame, test: DataFrame, workdir: str,
                 configs: list[dict] | None = None, bad_rows: int = 0) -> dict:
    """Drift decides between retraining and scoring with stored artifacts.

    ``bad_rows`` is the number of input rows that could not be read (``read_quarantined``).
    """
    began = time.time()
    metrics = MetricsTable(spark, _at(workdir, "metrics"))
    with metrics.stage("data_ingestion"):
        train, train_counts = R.observed_write(train, _at(workdir, "train"))
        test, test_counts = R.observed_write(test, _at(workdir, "test"))
        metrics.record_rows("data_ingestion", R.ingestion(train_counts, "train") + R.ingestion(test_counts, "test"))
    with metrics.stage("drift_detection"):
        parts = drift_stage(spark, test, workdir, bad_rows)
        verdict = parts["summary"].first()
        metrics.record_rows("drift_detection", R.drift(verdict.asDict(), parts.get("detail")))
    retrain = bool(verdict["overall_drift"]) or SC.current_version(spark, _at(workdir, "artifacts")) is None
    if retrain:
        with metrics.stage("model_training"):
            train_stage(spark, train, workdir, configs, metrics, train_counts["rows"])
        build_reference(train, workdir)
    with metrics.stage("model_prediction"):
        pred = predict_stage(spark, test, workdir, metrics)
    metrics.record_rows("pipeline", R.run_time(time.time() - began))
    return {"retrained": retrain, "verdict": verdict.asDict(), **pred}
