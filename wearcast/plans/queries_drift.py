"""Registered drift queries on the events telemetry split by time (reference
before 2024-01-16, current after), with DuckDB oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as D
from ..sources.telemetry import events_telemetry
from .oracle_sql import TEL_EVENTS
from ..session import shared_path
from ..sources.files import read_quarantined
from .registry import query

SPLIT = "2024-01-16 00:00:00"
FEATS = ["sensor_1", "sensor_2", "sensor_3"]


def _split(spark: SparkSession, sf: str, shifted: bool = False, nulls: bool = False, stored: bool = False):
    """Telemetry before and after ``SPLIT``; ``stored`` numbers the cycles once and keeps the rows in the shared folder."""
    tel = events_telemetry(spark, sf, keep=("ts", "event_id"))
    if stored:
        tel = D.materialise(tel, "drift-telemetry")
    ref = tel.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))
    cur = tel.where(F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz"))
    if shifted:
        sd = ref.agg(F.stddev_samp("sensor_1")).first()[0]
        cur = cur.withColumn("sensor_1", F.col("sensor_1") + F.lit(4.0 * sd))
    if nulls:
        cur = cur.withColumn("sensor_1", F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("double"))
                             .otherwise(F.col("sensor_1")))
    return ref.drop("ts", "event_id"), cur.drop("ts", "event_id")


def _r(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


# ---- SQL pieces -----------------------------------------------------------------

def _tel_ts() -> str:
    return TEL_EVENTS.replace("SELECT CAST(user_id AS BIGINT) AS unit_id,",
                              "SELECT ts, event_id, CAST(user_id AS BIGINT) AS unit_id,")


def _sides(shifted=False, nulls=False) -> str:
    cur_s1 = "sensor_1"
    if shifted:
        cur_s1 = "sensor_1 + 4.0 * (SELECT stddev_samp(sensor_1) FROM ref)"
    if nulls:
        cur_s1 = f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE {cur_s1} END"
    return f"""{_tel_ts()},
ref AS (SELECT * FROM tel WHERE ts < TIMESTAMP '{SPLIT}'),
cur AS (SELECT unit_id, time_cycles, CAST({cur_s1} AS DOUBLE) AS sensor_1, sensor_2, sensor_3
        FROM tel WHERE ts >= TIMESTAMP '{SPLIT}')"""


def _long(src: str) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {src}" for f in FEATS)


PROFILE = """prof AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
         max(value) AS max, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate,
         count(value) AS n FROM lref GROUP BY feature)"""

BIN = """CASE WHEN value >= lo AND value <= hi THEN
  CASE WHEN value < lo + raw * ((hi - lo) / 10) THEN raw - 1
       WHEN value >= (CASE WHEN raw = 9 THEN hi ELSE lo + (raw + 1) * ((hi - lo) / 10) END) AND raw <> 9 THEN raw + 1
       ELSE raw END END"""


def _psi_sql() -> str:
    return f"""edges AS (SELECT feature, CASE WHEN min = max THEN min - 0.5 ELSE min END AS lo,
                         CASE WHEN min = max THEN max + 0.5 ELSE max END AS hi FROM prof),
bref AS (SELECT feature, value, lo, hi,
         least(CAST(floor((value - lo) * (10.0 / (hi - lo))) AS INTEGER), 9) AS raw
         FROM lref JOIN edges USING (feature) WHERE value IS NOT NULL),
bcur AS (SELECT feature, value, lo, hi,
         least(CAST(floor((value - lo) * (10.0 / (hi - lo))) AS INTEGER), 9) AS raw
         FROM lcur JOIN edges USING (feature) WHERE value IS NOT NULL),
cref AS (SELECT feature, {BIN} AS bin FROM bref),
ccur AS (SELECT feature, {BIN} AS bin FROM bcur),
nref AS (SELECT feature, count(*) AS n FROM cref GROUP BY feature),
ncur AS (SELECT feature, count(*) AS n FROM ccur GROUP BY feature),
kref AS (SELECT feature, bin, count(*) AS c FROM cref WHERE bin IS NOT NULL GROUP BY ALL),
kcur AS (SELECT feature, bin, count(*) AS c FROM ccur WHERE bin IS NOT NULL GROUP BY ALL),
grid AS (SELECT feature, b AS bin FROM edges, range(0, 10) t(b)),
sh AS (SELECT g.feature, coalesce(kr.c, 0) / nr.n AS r, coalesce(kc.c, 0) / nc.n AS c
       FROM grid g LEFT JOIN kref kr ON g.feature = kr.feature AND g.bin = kr.bin
       LEFT JOIN kcur kc ON g.feature = kc.feature AND g.bin = kc.bin
       JOIN nref nr ON g.feature = nr.feature JOIN ncur nc ON g.feature = nc.feature),
psi AS (SELECT feature, abs(sum((CASE WHEN c = 0 THEN 0.0001 ELSE c END - CASE WHEN r = 0 THEN 0.0001 ELSE r END)
              * ln(CASE WHEN c = 0 THEN 0.0001 ELSE c END / CASE WHEN r = 0 THEN 0.0001 ELSE r END))) AS psi_score
        FROM sh GROUP BY feature)"""


def _ks_sql() -> str:
    return """pv AS (SELECT feature, value, sum(cr) AS cr, sum(cc) AS cc FROM (
         SELECT feature, value, 1 AS cr, 0 AS cc FROM lref WHERE value IS NOT NULL
         UNION ALL SELECT feature, value, 0, 1 FROM lcur WHERE value IS NOT NULL) GROUP BY ALL),
cum AS (SELECT feature, sum(cr) OVER w AS crc, sum(cc) OVER w AS ccc,
               sum(cr) OVER (PARTITION BY feature) AS n_ref, sum(cc) OVER (PARTITION BY feature) AS n_cur
        FROM pv WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT feature, n_ref, n_cur, max(abs(crc / n_ref - ccc / n_cur)) AS ks_statistic
       FROM cum WHERE n_ref > 0 AND n_cur > 0 GROUP BY ALL),
ksp AS (SELECT feature, ks_statistic, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2 * (
          SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)), 0.0), 1.0) END
          AS ks_p_value
        FROM (SELECT *, (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur)))
                        * ks_statistic AS lam FROM ks))"""


def _detail_sql(shifted=False, nulls=False) -> str:
    return f"""WITH {_sides(shifted, nulls)},
lref AS ({_long("ref")}), lcur AS ({_long("cur")}),
{PROFILE}, {_psi_sql()}, {_ks_sql()},
cs AS (SELECT feature, avg(value) AS current_mean, count(value) AS n FROM lcur GROUP BY feature)
SELECT cs.feature, round(ksp.ks_statistic, 6) AS ks_statistic, round(ksp.ks_p_value, 6) AS ks_p_value,
       round(psi.psi_score, 6) AS psi_score,
       round(abs(cs.current_mean - prof.mean) / (coalesce(prof.std, 'nan'::DOUBLE) + 1e-8), 6) AS mean_drift,
       round(prof.mean, 6) AS reference_mean, round(cs.current_mean, 6) AS current_mean,
       (psi.psi_score > 0.7 OR (prof.std IS NOT NULL AND abs(cs.current_mean - prof.mean) / (prof.std + 1e-8) > 3.0))
         AS drift_detected
FROM cs JOIN prof ON cs.feature = prof.feature JOIN psi ON cs.feature = psi.feature
JOIN ksp ON cs.feature = ksp.feature WHERE cs.n > 0 AND prof.n > 0"""


def _issues_sql(nulls=False) -> str:
    return f"""WITH {_sides(nulls=nulls)},
lref AS ({_long("ref")}), lcur AS ({_long("cur")}), {PROFILE},
st AS (SELECT feature, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS cm, min(value) AS mn,
              max(value) AS mx FROM lcur GROUP BY feature)
SELECT st.feature || '_missing_rate' AS issue, [round(p.missing_rate, 6)] AS reference,
       [round(st.cm, 6)] AS current, TRUE AS drift_detected
FROM st JOIN prof p USING (feature) WHERE abs(st.cm - p.missing_rate) > 0.2
UNION ALL
SELECT st.feature || '_range', [round(p.min, 6), round(p.max, 6)], [round(st.mn, 6), round(st.mx, 6)], TRUE
FROM st JOIN prof p USING (feature) WHERE st.mn < p.min * 0.8 OR st.mx > p.max * 1.2"""


# ---- Queries ----------------------------------------------------------------------

@query("drift_reference_profile", sql=f"""WITH {_sides()}, lref AS ({_long("ref")}), {PROFILE}
SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max,
       round(missing_rate, 6) AS missing_rate, n FROM prof""")
def q_profile(spark, sf):
    ref, _ = _split(spark, sf)
    return _r(D.reference_profile(ref, FEATS))


@query("drift_fleet_shape", sql=f"""WITH {_sides()},
lives AS (SELECT unit_id, max(time_cycles) AS l FROM ref GROUP BY unit_id)
SELECT round(avg(l), 6) AS avg_cycles_per_unit, count(*) AS total_units, max(l) AS total_cycles FROM lives""")
def q_fleet(spark, sf):
    ref, _ = _split(spark, sf)
    return _r(D.fleet_shape(ref))


@query("drift_psi", sql=f"""WITH {_sides()}, lref AS ({_long("ref")}), lcur AS ({_long("cur")}),
{PROFILE}, {_psi_sql()} SELECT feature, round(psi_score, 6) AS psi_score FROM psi""")
def q_psi(spark, sf):
    ref, cur = _split(spark, sf)
    return _r(D.psi(ref, cur, FEATS))


@query("drift_feature_report", sql=_detail_sql())
def q_detail(spark, sf):
    ref, cur = _split(spark, sf)
    return _r(D.feature_drift(ref, cur, FEATS))


@query("drift_feature_report_shifted", sql=_detail_sql(shifted=True))
def q_detail_shift(spark, sf):
    ref, cur = _split(spark, sf, shifted=True)
    return _r(D.feature_drift(ref, cur, FEATS))


@query("drift_quality_issues", sql=_issues_sql(nulls=True))
def q_issues(spark, sf):
    ref, cur = _split(spark, sf, nulls=True)
    out = D.quality_issues(cur, D.reference_profile(ref, FEATS))
    return out.select("issue", F.transform("reference", lambda x: F.round(x, 6)).alias("reference"),
                      F.transform("current", lambda x: F.round(x, 6)).alias("current"), "drift_detected")


@query("drift_temporal", sql=f"""WITH {_sides()},
lr AS (SELECT unit_id, max(time_cycles) AS l FROM ref GROUP BY unit_id),
lc AS (SELECT unit_id, max(time_cycles) AS l FROM cur GROUP BY unit_id),
a AS (SELECT (SELECT avg(l) FROM lr) AS r, (SELECT avg(l) FROM lc) AS c)
SELECT round(r, 6) AS reference_avg_cycles, round(c, 6) AS current_avg_cycles,
       round(abs(c - r) / r, 6) AS cycle_drift_ratio, abs(c - r) / r > 0.5 AS temporal_drift FROM a""")
def q_temporal(spark, sf):
    ref, cur = _split(spark, sf)
    return _r(D.temporal_drift(cur, D.fleet_shape(ref)))


@query("drift_summary", sql=f"""WITH {_sides(nulls=True)},
lref AS ({_long("ref")}), lcur AS ({_long("cur")}),
{PROFILE}, {_psi_sql()},
cs AS (SELECT feature, avg(value) AS current_mean, count(value) AS n FROM lcur GROUP BY feature),
det AS (SELECT cs.feature, psi.psi_score,
          (psi.psi_score > 0.7 OR (prof.std IS NOT NULL AND abs(cs.current_mean - prof.mean) / (prof.std + 1e-8) > 3.0)) AS dd
        FROM cs JOIN prof ON cs.feature = prof.feature JOIN psi ON cs.feature = psi.feature WHERE cs.n > 0 AND prof.n > 0),
st AS (SELECT feature, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS cm, min(value) AS mn, max(value) AS mx
       FROM lcur GROUP BY feature),
iss AS (SELECT count(*) AS k FROM st JOIN prof p USING (feature)
        WHERE abs(st.cm - p.missing_rate) > 0.2 OR st.mn < p.min * 0.8 OR st.mx > p.max * 1.2),
lr AS (SELECT unit_id, max(time_cycles) AS l FROM ref GROUP BY unit_id),
lc AS (SELECT unit_id, max(time_cycles) AS l FROM cur GROUP BY unit_id),
tmp AS (SELECT abs((SELECT avg(l) FROM lc) - (SELECT avg(l) FROM lr)) / (SELECT avg(l) FROM lr) > 0.5 AS t),
agg AS (SELECT coalesce(bool_or(dd), FALSE) AS data_drift, count(*) AS features_analyzed,
               count_if(dd) AS features_with_drift, avg(psi_score) AS mean_psi FROM det)
SELECT data_drift, (SELECT k FROM iss) > 0 AS quality_drift, (SELECT t FROM tmp) AS temporal_drift,
       data_drift OR (SELECT k FROM iss) > 0 OR (SELECT t FROM tmp) AS overall_drift,
       features_analyzed, features_with_drift,
       round(CASE WHEN features_analyzed > 0 THEN features_with_drift / features_analyzed * 100.0 ELSE 0.0 END, 6)
         AS drift_percentage,
       round(least(1.0, coalesce(mean_psi, 0.0)), 6) AS drift_severity,
       CASE WHEN data_drift OR (SELECT k FROM iss) > 0 OR (SELECT t FROM tmp) THEN 'retrain'
            ELSE 'proceed_with_prediction' END AS recommendation
FROM agg""")
def q_summary(spark, sf):
    ref, cur = _split(spark, sf, nulls=True)
    prof = D.reference_profile(ref, FEATS)
    # from the stored form alone: profile, fleet shape and value counts
    parts = D.detect_drift(prof, D.fleet_shape(ref), None, cur, ref_counts=D.value_counts(ref, FEATS))
    return _r(parts["summary"])


@query("drift_unreadable_input", sql=f"""WITH {_sides()}
SELECT count(*) FILTER (time_cycles % 50 <> 0) AS readable_rows, count(*) FILTER (time_cycles % 50 = 0) AS unreadable_rows,
       true AS quality_drift, true AS overall_drift, 'retrain' AS recommendation FROM cur""")
def q_unreadable(spark, sf):
    """A CSV with broken lines goes through the quarantine reader, and the verdict is drift and retraining."""
    ref, cur = _split(spark, sf)
    tag = uuid.uuid4().hex
    names = cur.columns
    whole = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    lines = cur.select(F.when(F.col("time_cycles") % 50 == 0, F.concat(F.lit("?,"), whole)).otherwise(whole).alias("value"))
    path = shared_path(spark, f"upload-{tag}")
    lines.write.text(path)
    good, bad = read_quarantined(spark, path, shared_path(spark, f"quarantine-{tag}"), cur.schema, header=False)
    prof = D.reference_profile(ref, FEATS)
    parts = D.detect_drift(prof, D.fleet_shape(ref), None, good, ref_counts=D.value_counts(ref, FEATS))
    out = D.with_unreadable(parts["summary"], bad) if bad else parts["summary"].withColumn("unreadable_rows", F.lit(0).cast("long"))
    return out.select(F.lit(good.count()).alias("readable_rows"), "unreadable_rows", "quality_drift", "overall_drift", "recommendation")
