"""Registered queries of the decisions and small tables of training and reporting, each against SQL:
relevance (M3), dropped columns (P8, P9), training rows (F2, M12), held-out parts of folds (F3, U4),
improvement over the constant model (A15), finite values (X8), the drift report's JSON (K4, X15), the
reference sample (O2) and elapsed times (X14)."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from ..functions.scalar import elapsed_seconds, finite_or_zero
from ..ml import train as T
from ..operators import drift as D
from ..operators.features import short_features
from ..operators.rebase import rebase
from ..operators.relevance import benjamini_yekutieli, kendall_table
from ..operators.select import duplicate_columns, null_bearing_columns
from ..schema import CV_FOLDS, CYCLE, KEYS, LONG_FDR, RUL, RUL_CAP, UNIT, VALID_RUL_LOW
from ..sources.telemetry import events_telemetry, lineitem_telemetry, read_table
from .oracle_sql import TEL_EVENTS, TEL_LINEITEM, rebased
from .queries_drift import FEATS, _split
from .queries_relevance import FEATS as RELEVANT
from .queries_relevance import _labelled
from .registry import query, sql_of


def _relevance_sql() -> str:
    """Step-up on |z|: the k-th largest must reach the two-sided normal quantile of its level, and all before it too."""
    m = len(RELEVANT)
    levels = [LONG_FDR * k / (m * sum(1.0 / j for j in range(1, m + 1))) for k in range(1, m + 1)]
    need = ", ".join(f"({k}, {NormalDist().inv_cdf(1 - p / 2)!r})" for k, p in enumerate(levels, 1))
    return f"""WITH t AS ({sql_of('kendall_tau_label')}), o AS (SELECT feature, abs(z) AS z, row_number() OVER (ORDER BY abs(z) DESC, feature) AS k FROM t),
d AS (SELECT o.feature, o.k, o.z >= n.need AS ok FROM o JOIN (VALUES {need}) n(k, need) ON n.k = o.k)
SELECT feature, (SELECT bool_and(e.ok) FROM d e WHERE e.k <= d.k) AS relevant FROM d"""


@query("relevance_decisions", sql=_relevance_sql())
def q_relevant(spark, sf):
    return benjamini_yekutieli(kendall_table(_labelled(spark, sf), RELEVANT, "rul"), LONG_FDR).select("feature", "relevant")


@query("dropped_columns", sql=f"""WITH {TEL_EVENTS},
w AS (SELECT *, sensor_1 AS copy_1, CASE WHEN time_cycles % 4 = 0 THEN NULL ELSE sensor_2 END AS gaps_2, sensor_2 + 0 AS copy_2 FROM tel),
c AS (SELECT unnest(['sensor_1', 'sensor_2', 'copy_1', 'gaps_2', 'copy_2']) AS column_name)
SELECT column_name, CASE column_name
         WHEN 'sensor_1' THEN (SELECT count(*) FILTER (sensor_1 IS NULL) > 0 FROM w) WHEN 'sensor_2' THEN (SELECT count(*) FILTER (sensor_2 IS NULL) > 0 FROM w)
         WHEN 'copy_1' THEN (SELECT count(*) FILTER (copy_1 IS NULL) > 0 FROM w) WHEN 'gaps_2' THEN (SELECT count(*) FILTER (gaps_2 IS NULL) > 0 FROM w)
         ELSE (SELECT count(*) FILTER (copy_2 IS NULL) > 0 FROM w) END AS has_nulls,
       CASE column_name WHEN 'copy_1' THEN (SELECT bool_and(copy_1 IS NOT DISTINCT FROM sensor_1) FROM w)
         WHEN 'copy_2' THEN (SELECT bool_and(copy_2 IS NOT DISTINCT FROM sensor_2) FROM w)
         WHEN 'sensor_2' THEN (SELECT bool_and(sensor_2 IS NOT DISTINCT FROM sensor_1) FROM w)
         WHEN 'gaps_2' THEN (SELECT bool_and(gaps_2 IS NOT DISTINCT FROM sensor_2) FROM w) ELSE false END AS duplicate
FROM c""")
def q_dropped(spark, sf):
    """Which feature columns copy an earlier one or bear nulls."""
    tel = events_telemetry(spark, sf)
    wide = tel.select(*KEYS, "sensor_1", "sensor_2", F.col("sensor_1").alias("copy_1"),
                      F.when(F.col(CYCLE) % 4 == 0, None).otherwise(F.col("sensor_2")).alias("gaps_2"), (F.col("sensor_2") + 0).alias("copy_2"))
    cols = wide.columns[2:]
    nulls, copies = null_bearing_columns(wide, cols), duplicate_columns(wide, cols, KEYS)
    return spark.createDataFrame([(c, c in nulls, c in copies) for c in cols], "column_name string, has_nulls boolean, duplicate boolean")


_SENS = ["sensor_1", "sensor_2"]
_FEATS_SQL = f"""{TEL_EVENTS}, {rebased(_SENS)},
f AS (SELECT unit_id, time_cycles, {", ".join(f'avg({s}) OVER w AS "{s}__mean"' for s in _SENS)}, count(*) OVER w AS n
      FROM reb WINDOW w AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
feats AS (SELECT * EXCLUDE (n) FROM f WHERE n = 5),
lab AS (SELECT *, CAST(least(max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles, {RUL_CAP}) AS DOUBLE) AS rul FROM feats),
train AS (SELECT * FROM lab WHERE rul > 0)"""


def _training(spark, sf):
    return T.training_set(short_features(rebase(events_telemetry(spark, sf), _SENS), _SENS, dense=True))[0]


@query("training_rows", sql=f"""WITH {_FEATS_SQL}
SELECT unit_id, time_cycles, {", ".join(f'round("{s}__mean", 6) AS "{s}__mean"' for s in _SENS)}, rul FROM train""")
def q_training(spark, sf):
    """Labelled feature rows with the cycle as an input, rows at the end of life left out."""
    df = _training(spark, sf)
    return df.select(UNIT, CYCLE, *[F.round(f"{s}__mean", 6).alias(f"{s}__mean") for s in _SENS], RUL)


@query("fold_parts", sql=f"""WITH {_FEATS_SQL},
c AS (SELECT unit_id, count(*) AS n FROM train GROUP BY unit_id),
r AS (SELECT unit_id, row_number() OVER (ORDER BY n DESC, unit_id) - 1 AS k FROM c),
folds AS (SELECT unit_id, CASE WHEN k % 8 < 4 THEN k % 8 ELSE 7 - k % 8 END AS fold FROM r),
x AS (SELECT train.*, folds.fold FROM train JOIN folds USING (unit_id))
SELECT CAST(g.k AS INTEGER) AS fold, count(*) FILTER (x.fold <> g.k) AS train_rows,
       count(*) FILTER (x.fold = g.k AND rul > {VALID_RUL_LOW} AND rul < {RUL_CAP}) AS test_rows,
       count(DISTINCT unit_id) FILTER (x.fold = g.k) AS test_units
FROM x, range(0, 4) g(k) GROUP BY g.k""")
def q_parts(spark, sf):
    """Rows of each fold's train part and of its filtered held-out part, and its units."""
    df = T.with_folds(_training(spark, sf))
    valid = (F.col(RUL) > VALID_RUL_LOW) & (F.col(RUL) < RUL_CAP)
    per = [F.struct(F.lit(k).cast("int").alias("fold"), F.count_if(F.col("fold") != k).alias("train_rows"), F.count_if((F.col("fold") == k) & valid).alias("test_rows"),
                    F.count_distinct(F.when(F.col("fold") == k, F.col(UNIT))).alias("test_units")) for k in range(CV_FOLDS)]
    return df.agg(F.array(*per).alias("p")).select(F.inline("p"))


@query("improvement_over_constant", sql=f"""WITH {_FEATS_SQL},
l AS (SELECT regr_intercept(rul, time_cycles) AS a, regr_slope(rul, time_cycles) AS b FROM train),
e AS (SELECT sqrt(avg(power(rul - a - b * time_cycles, 2))) AS rmse, stddev_pop(rul) AS sd FROM train, l)
SELECT round(sd, 6) AS baseline_rmse, round(greatest(0, (sd - rmse) / sd * 100), 6) AS improvement_pct FROM e""")
def q_improvement(spark, sf):
    """A15 for the least-squares line on the cycle."""
    df = _training(spark, sf)
    a, b = df.agg(F.regr_intercept(RUL, CYCLE), F.regr_slope(RUL, CYCLE)).first()
    rmse = df.agg(F.sqrt(F.avg(F.pow(F.col(RUL) - (F.lit(a) + F.lit(b) * F.col(CYCLE)), 2)))).first()[0]
    out = T.improvement_over_baseline(df, rmse)
    return out.select(F.round("baseline_rmse", 6).alias("baseline_rmse"), F.round("improvement_pct", 6).alias("improvement_pct"))


@query("finite_features", sql=f"""WITH {TEL_LINEITEM},
x AS (SELECT unit_id, time_cycles, CASE WHEN sensor_3 = 0 THEN CASE WHEN sensor_4 = 0 THEN NULL ELSE 0.0 END ELSE sensor_4 / sensor_3 END AS q FROM tel)
SELECT unit_id, time_cycles, round(coalesce(q, 0.0), 6) AS ratio FROM x""")
def q_finite(spark, sf):
    """Tax over discount, infinite where the discount is 0, as finite values."""
    tel = lineitem_telemetry(spark, sf)
    q = F.when(F.col("sensor_3") == 0, F.when(F.col("sensor_4") == 0, None).otherwise(F.lit(float("inf")))).otherwise(F.try_divide("sensor_4", "sensor_3"))
    return tel.select(UNIT, CYCLE, F.round(finite_or_zero(q), 6).alias("ratio"))


@query("drift_report_json", sql=f"""WITH s AS ({sql_of('drift_summary')})
SELECT data_drift, quality_drift, temporal_drift, overall_drift, features_analyzed, recommendation, CAST(0.7 AS DOUBLE) AS psi_threshold FROM s""")
def q_report(spark, sf):
    """The verdict as read back from the report's JSON text."""
    ref, cur = _split(spark, sf, nulls=True)
    parts = D.detect_drift(D.reference_profile(ref, FEATS), D.fleet_shape(ref), None, cur, ref_counts=D.value_counts(ref, FEATS))
    shape = ("summary struct<data_drift boolean, quality_drift boolean, temporal_drift boolean, overall_drift boolean, features_analyzed long, "
             "recommendation string>, thresholds map<string, double>")
    doc = D.report_json(parts).select(F.from_json("report", shape).alias("r"))
    return doc.select("r.summary.*", F.col("r.thresholds")["psi"].alias("psi_threshold"))


@query("reference_sample", sql="""SELECT least(5000, count(*)) AS rows, least(5000, count(*)) AS distinct_rows, true AS repeatable FROM events""")
def q_sample(spark, sf):
    """O2: the reproducible sample of at most 5000 reference rows (a sampling option; drift uses all rows by default)."""
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "value")
    a, b = D.hashed_sample(ev, key=["event_id"]), D.hashed_sample(ev.repartition(7), key=["event_id"])
    return a.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("distinct_rows"), F.bit_xor(F.xxhash64("event_id")).alias("x")).crossJoin(  # one row each
        b.agg(F.bit_xor(F.xxhash64("event_id")).alias("y"))).select("rows", "distinct_rows", (F.col("x") == F.col("y")).alias("repeatable"))


@query("elapsed_per_unit", sql="""SELECT CAST(user_id AS BIGINT) AS unit_id, round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 3) AS seconds
FROM events GROUP BY user_id""")
def q_elapsed(spark, sf):
    """Seconds between a machine's first and last reading."""
    ev = read_table(spark, sf, "events").groupBy(F.col("user_id").cast("long").alias(UNIT)).agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b"))
    return ev.select(UNIT, F.round(elapsed_seconds("a", "b"), 3).alias("seconds"))
