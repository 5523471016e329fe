"""Registered quality and pipeline-metric queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..ml import stages as S
from ..operators import drift as D
from ..operators import evaluate as E
from ..operators import metric_rows as R
from ..operators.evaluate import RUL_BOUNDS
from ..operators.quality import (MetricsTable, ingestion_quality, stage_summary,
                                 transformation_metrics)
from ..operators.rebase import rebase
from ..schema import META_DROP
from ..session import shared_path
from ..sources.telemetry import lineitem_telemetry, truncate_lives
from .oracle_sql import TEL_LINEITEM
from .queries_drift import FEATS
from .queries_drift import _split as split_events
from .queries_eval import baseline_predictions
from .registry import query, sql_of

_COLS = ["unit_id", "time_cycles", "sensor_1", "sensor_2", "sensor_3", "sensor_4"]


@query("ingestion_quality", sql=f"""WITH {TEL_LINEITEM},
life AS (SELECT unit_id, max(time_cycles) AS life FROM tel GROUP BY unit_id),
test AS (SELECT t.*, CAST(l.life - t.time_cycles AS DOUBLE) AS rul FROM tel t JOIN life l USING (unit_id)
         WHERE t.time_cycles * 10 <= l.life * 6)
SELECT 'train' AS dataset_type, count(*) AS rows, CAST(6 AS BIGINT) AS columns,
       round(1 - (count(*) * 6 - ({" + ".join(f"count({c})" for c in _COLS)})) / (count(*) * 6.0), 6) AS quality_score,
       round((count(*) * 4 - (count(sensor_1) + count(sensor_2) + count(sensor_3) + count(sensor_4))) / (count(*) * 4.0) * 100, 6)
         AS sensor_missing_pct FROM tel
UNION ALL
SELECT 'test', count(*), CAST(7 AS BIGINT),
       round(1 - (count(*) * 7 - ({" + ".join(f"count({c})" for c in _COLS)} + count(rul))) / (count(*) * 7.0), 6),
       round((count(*) * 4 - (count(sensor_1) + count(sensor_2) + count(sensor_3) + count(sensor_4))) / (count(*) * 4.0) * 100, 6)
FROM test""")
def q_ingest(spark, sf):
    tel = lineitem_telemetry(spark, sf)
    out = ingestion_quality(tel, "train").unionByName(ingestion_quality(truncate_lives(tel), "test"))
    return out.select("dataset_type", "rows", "columns", F.round("quality_score", 6).alias("quality_score"),
                      F.round("sensor_missing_pct", 6).alias("sensor_missing_pct"))


@query("transformation_metrics", sql=f"""WITH {TEL_LINEITEM}
SELECT count(*) AS rows_before, count(*) FILTER (WHERE time_cycles > 10) AS rows_after,
       round(count(*) FILTER (WHERE time_cycles > 10) / count(*), 6) AS reduction_ratio,
       CAST(1 AS BIGINT) AS dropped_manual, CAST(0 AS BIGINT) AS dropped_low_variance FROM tel""")
def q_transform(spark, sf):
    # raw table as ingested: telemetry plus the metadata column dropped by P1
    before = lineitem_telemetry(spark, sf).withColumn("rul", F.lit(None).cast("double"))
    after = S.preprocessor().fit(before).transform(before)
    out = transformation_metrics(before, after, META_DROP)
    return out.select("rows_before", "rows_after", F.round("reduction_ratio", 6).alias("reduction_ratio"),
                      "dropped_manual", "dropped_low_variance")


@query("stage_metrics_summary", sql="""SELECT * FROM (VALUES ('data_ingestion', 'success', CAST(1 AS BIGINT)),
('data_transformation', 'success', 1), ('drift_detection', 'failure', 1)) t(stage, status, executions)""")
def q_stages(spark, sf):
    """Executions by stage and status, of stages over the lineitem telemetry of which one fails; times are in the rows."""
    m = MetricsTable(spark, shared_path(spark, f"metrics-{uuid.uuid4().hex[:8]}"))
    with m.stage("data_ingestion"):
        tel, counts = R.observed_write(lineitem_telemetry(spark, sf), shared_path(spark, f"stage-{uuid.uuid4().hex[:8]}"))
        m.record_rows("data_ingestion", R.ingestion(counts, "train"))
    with m.stage("data_transformation"):
        rebase(tel).write.format("noop").mode("overwrite").save()
    try:
        with m.stage("drift_detection"):
            raise LookupError("no reference")
    except LookupError:
        pass
    return stage_summary(m.read()).select("stage", "status", "executions")


def _metrics_sql() -> str:
    """Metric rows as a union over the SQL of the tables they come from."""
    sql = {k: sql_of(k) for k in ("ingestion_quality", "transformation_metrics", "drift_summary", "eval_rul_distribution", "eval_metrics")}
    cum = " UNION ALL ".join(f"SELECT 'rul_prediction_values', 'le={b:g}', CAST(count AS DOUBLE) FROM dist WHERE le = CAST('{b}' AS DOUBLE)" for b in RUL_BOUNDS)
    return f"""WITH ing AS ({sql['ingestion_quality']}), tra AS ({sql['transformation_metrics']}), dri AS ({sql['drift_summary']}),
dist AS ({sql['eval_rul_distribution']}), ev AS ({sql['eval_metrics']}),
rows_(metric, labels, value) AS (
SELECT 'dataset_size_records', 'dataset_type=' || dataset_type || ',stage=ingestion', CAST(rows AS DOUBLE) FROM ing
UNION ALL SELECT 'dataset_features_count', 'dataset_type=' || dataset_type || ',stage=ingestion', columns FROM ing
UNION ALL SELECT 'data_quality_score', 'dataset_type=' || dataset_type || ',stage=ingestion', quality_score FROM ing
UNION ALL SELECT 'missing_values_percentage', 'column_type=sensor,dataset_type=' || dataset_type, sensor_missing_pct FROM ing
UNION ALL SELECT 'transformation_data_reduction_ratio', '', reduction_ratio FROM tra
UNION ALL SELECT 'features_dropped_count', 'drop_reason=manual', dropped_manual FROM tra
UNION ALL SELECT 'features_dropped_count', 'drop_reason=low_variance', dropped_low_variance FROM tra
UNION ALL SELECT 'drift_detected', 'drift_type=overall', CAST(overall_drift AS INTEGER) FROM dri
UNION ALL SELECT 'drift_detected', 'drift_type=data', CAST(data_drift AS INTEGER) FROM dri
UNION ALL SELECT 'drift_detected', 'drift_type=quality', CAST(quality_drift AS INTEGER) FROM dri
UNION ALL SELECT 'drift_detected', 'drift_type=temporal', CAST(temporal_drift AS INTEGER) FROM dri
UNION ALL SELECT 'drift_features_count', '', features_with_drift FROM dri
UNION ALL SELECT 'drift_severity_score', '', drift_severity FROM dri
UNION ALL SELECT 'predictions_total', '', n_engines FROM ev
UNION ALL {cum}
UNION ALL SELECT 'prediction_accuracy_score', 'metric_type=rmse', rmse FROM ev
UNION ALL SELECT 'prediction_accuracy_score', 'metric_type=mae', mae FROM ev
UNION ALL SELECT 'prediction_accuracy_score', 'metric_type=mape', mape FROM ev
UNION ALL SELECT 'prediction_accuracy_score', 'metric_type=r2', r2 FROM ev)
SELECT metric, labels, round(value, 6) AS value FROM rows_"""


def q_metric_rows(spark, sf):
    """K8: the deterministic metric rows of ingestion, transformation, drift and prediction (PSI values: ``drift_psi``)."""
    m = MetricsTable(spark, shared_path(spark, f"metrics-{uuid.uuid4().hex}"))
    # cycles are numbered once a table; the stages behind read the stored rows
    train, counts = R.observed_write(lineitem_telemetry(spark, sf).withColumn("rul", F.lit(None).cast("double")), shared_path(spark, f"train-{uuid.uuid4().hex}"))
    tel = train.drop("rul")
    test, test_counts = R.observed_write(truncate_lives(tel), shared_path(spark, f"test-{uuid.uuid4().hex}"))
    m.record_rows("data_ingestion", R.ingestion({k: v for k, v in counts.items() if k != "rul"}, "train") + R.ingestion(test_counts, "test"))
    after, kept = R.observed_write(S.preprocessor().fit(train).transform(train), shared_path(spark, f"after-{uuid.uuid4().hex}"))
    m.record_rows("data_transformation", R.transformation(counts["rows"], kept["rows"], train.columns, after.columns, META_DROP))
    ref, cur = split_events(spark, sf, nulls=True, stored=True)
    parts = D.detect_drift(D.reference_profile(ref, FEATS), D.fleet_shape(ref), None, cur, ref_counts=D.value_counts(ref, FEATS))
    found = R.drift(parts["summary"].first().asDict(), parts["detail"])
    m.record_rows("drift_detection", [r for r in found if r[0] != "psi_score"])
    pred, truth = baseline_predictions(tel, test)
    m.record_rows("model_prediction", R.prediction(pred, None, E.evaluation_metrics(pred, truth).first().asDict()))
    labels = F.array_join(F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return m.read().select("metric", labels.alias("labels"), F.round("value", 6).alias("value"))


query("pipeline_metric_rows", sql=_metrics_sql())(q_metric_rows)
