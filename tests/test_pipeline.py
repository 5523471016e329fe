"""End to end: first run retrains (no reference), second run routes on drift; versions and quarantine."""

import threading

from pyspark.sql import functions as F

from wearcast.ml import score as SC
from wearcast.ml.hist_trees import Model
from wearcast.plans.pipeline import run_pipeline
from wearcast.schema import telemetry_schema
from wearcast.sources.files import read_quarantined
from wearcast.sources.telemetry import events_telemetry, truncate_lives
from wearcast.sinks.tables import load_reference

SMALL = [{"model_type": "random_forest", "n_estimators": 10, "max_depth": 5}]


def test_first_run_then_proceed(spark, tmpdir_path):
    tel = events_telemetry(spark, "/root/testdata/sf0.001").persist()
    test = truncate_lives(tel)
    assert load_reference(spark, tmpdir_path + "/reference") is None
    out = run_pipeline(spark, tel, test, tmpdir_path, configs=SMALL)
    assert out["retrained"] and out["verdict"]["recommendation"] == "retrain"
    summary = out["summary"].first()
    assert summary["units"] == summary["scored"] + summary["skipped"] and summary["scored"] == out["scored"].count() > 0
    # same data against the stored reference: no drift, scoring only
    out2 = run_pipeline(spark, tel, tel, tmpdir_path, configs=SMALL)
    assert out2["verdict"]["data_drift"] is False
    assert out2["scored"].where(F.col("predicted_rul").isNull()).count() == 0
    assert out2["version"] == out["version"] and not out2["retrained"]
    # every kind of metric the stages record is there, once a run where it is a gauge of the run
    rows = spark.read.parquet(tmpdir_path + "/metrics")
    names = {r["metric"] for r in rows.select("metric").distinct().collect()}
    assert names >= {"dataset_size_records", "dataset_features_count", "data_quality_score", "missing_values_percentage", "drift_detected", "psi_score",
                     "drift_features_count", "drift_severity_score", "transformation_data_reduction_ratio", "features_dropped_count",
                     "engineered_features_count", "feature_selection_ratio", "feature_extraction_duration_seconds", "model_rmse_score", "model_mae_score",
                     "training_samples_count", "hyperparameter_trials_total", "best_model_improvement_percentage", "predictions_total",
                     "rul_prediction_values", "prediction_latency_seconds", "prediction_accuracy_score", "total_pipeline_duration_seconds",
                     "pipeline_sla_compliance", "stage_duration_seconds"}
    assert spark.read.parquet(tmpdir_path + "/true_rul").columns == ["engine_id", "true_rul"]
    # unreadable rows lead to retraining although the readable ones do not drift; the old version stays readable
    out3 = run_pipeline(spark, tel, tel, tmpdir_path, configs=SMALL, bad_rows=3)
    assert out3["retrained"] and out3["verdict"]["unreadable_rows"] == 3 and out3["version"] != out["version"]
    assert SC.load_artifacts(spark, tmpdir_path + "/artifacts", out["version"])["version"] == out["version"]


class Stage:
    """Stands for a fitted stage pipeline: writes one marker."""

    def __init__(self, spark, mark):
        self.spark, self.mark = spark, mark

    def write(self):
        return self

    def save(self, path):
        self.spark.createDataFrame([(self.mark,)], "mark int").coalesce(1).write.parquet(path)


def test_readers_see_whole_versions_while_writers_save(spark, tmpdir_path):
    path = tmpdir_path + "/artifacts"
    assert SC.current_version(spark, path) is None

    def save(k):
        stage = Stage(spark, k)
        return SC.save_artifacts(spark, path, stage, stage, stage, Model("poisson", float(k), [f"f{k}"], [], []), [f"f{k}"])

    save(0)
    done, failed = threading.Event(), []

    def writer():
        try:
            for k in range(1, 4):
                save(k)
        except Exception as e:  # reported by the main thread
            failed.append(e)
        done.set()

    thread = threading.Thread(target=writer)
    thread.start()
    seen = set()
    while not done.is_set():
        version = SC.current_version(spark, path)
        at = f"{path}/versions/{version}"
        marks = {spark.read.parquet(f"{at}/{n}").first()[0] for n in SC.ARTIFACTS[:3]}
        model = Model.load(spark, f"{at}/model")
        assert marks == {int(model.base)} and model.inputs == [f"f{int(model.base)}"] and spark.read.parquet(f"{at}/features").count() == 1
        seen |= marks
    thread.join()
    assert not failed and seen


def test_broken_lines_are_quarantined(spark, tmpdir_path):
    lines = ["unit_id,time_cycles,sensor_1", "1,1,0.5", "1,2", "1,3,x", "1,4,0.5,9", "", "2,1,", "not a line"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmpdir_path + "/up")
    good, bad = read_quarantined(spark, tmpdir_path + "/up", tmpdir_path + "/bad", telemetry_schema(["unit_id", "time_cycles", "sensor_1"]))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 1, 0.5), (2, 1, None)]
    assert bad == 4 and {r["line"] for r in spark.read.parquet(tmpdir_path + "/bad/quarantine").collect()} == {"1,2", "1,3,x", "1,4,0.5,9", "not a line"}


def test_pointer_is_read_between_file_and_checksum(spark, tmpdir_path):
    """The pointer of one version with the checksum of another, as a reader may find it during a rename."""
    from wearcast.ml.score import current_version, point_to
    a, b = tmpdir_path + "/a", tmpdir_path + "/b"
    point_to(spark, a, "first")
    point_to(spark, b, "other")
    with open(b + "/.current.crc", "rb") as src, open(a + "/.current.crc", "wb") as dst:
        dst.write(src.read())
    assert current_version(spark, a) == "first" and current_version(spark, tmpdir_path + "/none") is None
