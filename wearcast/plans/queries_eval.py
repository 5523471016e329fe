"""Registered evaluation queries. Engines are the lineitem telemetry cut at
60 % of life; the truth is the RUL left; predictions come from the constant
fleet-life baseline (mean life over units minus the current cycle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators.label import true_rul
from ..sources.telemetry import lineitem_telemetry, truncate_lives
from .oracle_sql import TEL_LINEITEM
from .registry import query

BASE = f"""WITH {TEL_LINEITEM},
life AS (SELECT unit_id, max(time_cycles) AS life FROM tel GROUP BY unit_id),
test AS (SELECT t.unit_id, t.time_cycles, CAST(l.life - t.time_cycles AS DOUBLE) AS rul
         FROM tel t JOIN life l ON t.unit_id = l.unit_id WHERE t.time_cycles * 10 <= l.life * 6),
truth AS (SELECT unit_id AS engine_id, CAST(arg_max(rul, time_cycles) AS DOUBLE) AS true_rul
          FROM test WHERE rul IS NOT NULL GROUP BY unit_id),
pred AS (SELECT unit_id AS engine_id,
                greatest((SELECT avg(life) FROM life) - max(time_cycles), 0.0) AS predicted_rul
         FROM test GROUP BY unit_id),
j AS (SELECT p.engine_id, p.predicted_rul AS p, t.true_rul AS t, p.predicted_rul - t.true_rul AS e
      FROM pred p JOIN truth t ON p.engine_id = t.engine_id)"""


def _inputs(spark, sf):
    tel = lineitem_telemetry(spark, sf)
    return baseline_predictions(tel, truncate_lives(tel))


def baseline_predictions(tel, test):
    """Predictions of the constant baseline and the truth, of the whole lives ``tel`` and their cut view ``test``."""
    life = tel.groupBy("unit_id").agg(F.max("time_cycles").alias("life"))
    truth = true_rul(test).withColumnRenamed("unit_id", "engine_id")
    avg_life = life.agg(F.avg("life").alias("al"))
    pred = (test.groupBy("unit_id").agg(F.max("time_cycles").alias("c"))
                .withColumn("_k", F.lit(1)).join(F.broadcast(avg_life.withColumn("_k", F.lit(1))), "_k")
                .select(F.col("unit_id").alias("engine_id"),
                        F.greatest(F.col("al") - F.col("c"), F.lit(0.0)).alias("predicted_rul")))
    return pred, truth


def _r(df):
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


@query("eval_true_rul", sql=f"{BASE} SELECT engine_id, true_rul FROM truth")
def q_truth(spark, sf):
    return _inputs(spark, sf)[1]


@query("eval_prediction_table", sql=f"""{BASE}
SELECT p.engine_id, round(p.predicted_rul, 6) AS predicted_rul, t.true_rul,
       round(p.predicted_rul - t.true_rul, 6) AS error, round(abs(p.predicted_rul - t.true_rul), 6) AS abs_error,
       round(CASE WHEN t.true_rul = 0 THEN 'inf'::DOUBLE ELSE abs(p.predicted_rul - t.true_rul) / t.true_rul * 100 END, 6)
         AS percentage_error
FROM pred p LEFT JOIN truth t ON p.engine_id = t.engine_id""")
def q_pred_table(spark, sf):
    pred, truth = _inputs(spark, sf)
    return _r(E.prediction_table(pred, truth))


@query("eval_metrics", sql=f"""{BASE}
SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
       round(coalesce(avg(CASE WHEN t <> 0 THEN abs(e) / abs(t) END), 'inf'::DOUBLE), 6) AS mape,
       round(CASE WHEN avg(CASE WHEN t <> 0 THEN abs(e) / abs(t) END) IS NULL THEN 0.0
                  ELSE (1 - avg(CASE WHEN t <> 0 THEN abs(e) / abs(t) END)) * 100 END, 6) AS accuracy,
       round(sum(CASE WHEN e >= 0 THEN exp(e / 10.0) - 1 ELSE exp(-e / 13.0) - 1 END), 6) AS custom_score,
       count(*) AS n_engines, round(min(p), 6) AS pred_min, round(max(p), 6) AS pred_max,
       round(min(t), 6) AS true_min, round(max(t), 6) AS true_max,
       round(1 - sum(e * e) / (var_pop(t) * count(*)), 6) AS r2
FROM j""")
def q_metrics(spark, sf):
    pred, truth = _inputs(spark, sf)
    return _r(E.evaluation_metrics(pred, truth))


@query("eval_error_by_range", sql=f"""{BASE},
rg AS (SELECT min(t) AS lo, max(t) AS hi FROM j),
grid AS (SELECT b AS bin, lo + b * ((hi - lo) / 9) AS b_lo, lo + (b + 1) * ((hi - lo) / 9) AS b_hi
         FROM rg, range(0, 9) r(b))
SELECT bin, round((b_lo + b_hi) / 2, 6) AS bin_center, round(coalesce(avg(abs(j.e)), 0.0), 6) AS mae
FROM grid LEFT JOIN j ON j.t >= grid.b_lo AND j.t < grid.b_hi GROUP BY bin, b_lo, b_hi""")
def q_err_range(spark, sf):
    pred, truth = _inputs(spark, sf)
    return _r(E.error_by_truth_range(pred, truth).withColumn("bin", F.col("bin").cast("long")))


@query("eval_residual_histogram", sql=f"""{BASE},
rg AS (SELECT CASE WHEN min(e) = max(e) THEN min(e) - 0.5 ELSE min(e) END AS lo,
              CASE WHEN min(e) = max(e) THEN max(e) + 0.5 ELSE max(e) END AS hi, avg(e) AS mr FROM j),
b AS (SELECT e AS value, lo, hi, least(CAST(floor((e - lo) * (30.0 / (hi - lo))) AS INTEGER), 29) AS raw FROM j, rg),
bb AS (SELECT CASE WHEN value >= lo AND value <= hi THEN
         CASE WHEN value < lo + raw * ((hi - lo) / 30) THEN raw - 1
              WHEN value >= (CASE WHEN raw = 29 THEN hi ELSE lo + (raw + 1) * ((hi - lo) / 30) END) AND raw <> 29 THEN raw + 1
              ELSE raw END END AS bin FROM b),
c AS (SELECT bin, count(*) AS n FROM bb GROUP BY bin)
SELECT CAST(g.b AS BIGINT) AS bin, CAST(coalesce(c.n, 0) AS BIGINT) AS count, round((SELECT mr FROM rg), 6) AS mean_residual
FROM range(0, 30) g(b) LEFT JOIN c ON c.bin = g.b""")
def q_resid(spark, sf):
    pred, truth = _inputs(spark, sf)
    return _r(E.residual_histogram(pred, truth).withColumn("bin", F.col("bin").cast("long")))


@query("eval_rul_distribution", sql=f"""{BASE}
SELECT b AS le, (SELECT count(*) FROM pred WHERE predicted_rul <= b) AS count
FROM (VALUES (0.0), (10.0), (25.0), (50.0), (75.0), (100.0), (135.0), (200.0), (300.0), ('inf'::DOUBLE)) v(b)""")
def q_dist(spark, sf):
    pred, _ = _inputs(spark, sf)
    return E.rul_distribution(pred)


@query("eval_fleet_summary", sql=f"""{BASE}
SELECT count(*) AS engines, CAST(round_even(CAST(avg(predicted_rul) AS DECIMAL(18, 6)), 1) AS DOUBLE) AS avg_rul,
       round(min(predicted_rul), 6) AS min_rul, round(max(predicted_rul), 6) AS max_rul FROM pred""")
def q_fleet(spark, sf):
    pred, _ = _inputs(spark, sf)
    return _r(E.fleet_summary(pred))


@query("eval_scoring_result", sql=f"""{BASE}
SELECT engine_id, CAST(round_even(CAST(predicted_rul AS DECIMAL(18, 6)), 1) AS DOUBLE) AS predicted_rul,
       (SELECT count(*) FROM pred) AS total_engines,
       CASE WHEN round_even(CAST(predicted_rul AS DECIMAL(18, 6)), 1) < 50 THEN 'Critical'
            WHEN round_even(CAST(predicted_rul AS DECIMAL(18, 6)), 1) < 100 THEN 'Warning' ELSE 'Good' END AS status
FROM pred""")
def q_scoring(spark, sf):
    pred, _ = _inputs(spark, sf)
    return E.scoring_result(pred)
