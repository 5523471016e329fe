"""Registered streaming queries over Parquet replays in the shared folder: ST1 per-unit
features and predictions of the events telemetry, ST2 drift of every day of the events
stream against the reference profile of the first half. Both are checked against SQL
over the same tables as a batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.drift import reference_profile
from ..operators.features import extract_features
from ..operators.label import add_rul
from ..operators.rebase import rebase
from ..schema import CYCLE, LONG_WINDOW, RUL, RUL_CAP, UNIT
from ..session import shared_path
from ..sources.telemetry import events_telemetry, read_table
from ..streaming.drift_stream import (DAYS, events_sensor_stream, late_rows, reference_bin_shares, replay, replay_events,
                                      run_updates, staged, window_verdicts, windowed_counts)
from ..streaming.unit_state import arrival_range, output_columns, score_stream, stream_unit_features
from .oracle_sql import TEL_EVENTS, rebased
from .queries_drift import BIN, SPLIT
from .registry import query

SENS = ["sensor_1", "sensor_2", "sensor_3"]


def cycle_model(tel):
    """Least squares of the capped label on the cycle, fitted on all rows: (intercept, slope)."""
    r = add_rul(tel, cap=RUL_CAP).agg(F.regr_intercept(RUL, CYCLE), F.regr_slope(RUL, CYCLE)).first()
    return float(r[0] or 0.0), float(r[1] or 0.0)


@query("stream_unit_features", sql=f"""WITH {TEL_EVENTS}, {rebased(SENS)},
lab AS (SELECT *, CAST(least(max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles, {RUL_CAP}) AS DOUBLE) AS y FROM tel),
fit AS (SELECT regr_intercept(y, time_cycles) AS a, regr_slope(y, time_cycles) AS b FROM lab),
w AS (SELECT unit_id, time_cycles, {", ".join(f"avg({s}) OVER s5 AS {s}__mean, avg({s}) OVER s20 AS {s}__long_mean" for s in SENS)}, count(*) OVER s20 AS n
      FROM reb WINDOW s5 AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
                      s20 AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT unit_id, time_cycles, {", ".join(f"round({s}__mean, 6) AS {s}__mean, round({s}__long_mean, 6) AS {s}__long_mean" for s in SENS)},
       round(a + b * time_cycles, 6) AS predicted_rul, CAST(0 AS BIGINT) AS late_rows
FROM w, fit WHERE n = 20""")
def q_st1(spark, sf):
    tel = events_telemetry(spark, sf)
    a, b = cycle_model(tel)
    scored = _replayed(spark, tel.withColumn("_range", arrival_range(F.col(CYCLE))),
                       lambda f: f.withColumn("predicted_rul", F.lit(a) + F.lit(b) * F.col(CYCLE)))
    out = scored.select(*[c for c in output_columns(SENS) if c != "late_rows"], "predicted_rul", "late_rows")
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


def _replayed(spark, rows, predict):
    """Rows with a ``_range`` played range by range, a trigger each, into the table of scored windows."""
    tag = uuid.uuid4().hex[:8]
    rows = staged(rows, "_range", shared_path(spark, f"st1-staged-{tag}"))
    src, table, ckpt = (shared_path(spark, f"st1-{d}-{tag}") for d in ("src", "out", "ckpt"))

    def trigger():
        stream = spark.readStream.schema(rows.drop("_range").schema).parquet(src)
        return score_stream(stream_unit_features(stream, SENS), predict, table, ckpt)

    return replay(rows, "_range", src, trigger)


def window_model(tel):
    """Least squares of the capped label on the long mean of sensor_1, over all full windows: (intercept, slope)."""
    long = extract_features(rebase(tel, ["sensor_1"]), ["sensor_1"], LONG_WINDOW, {"mean": None}, dense=True)
    fit = long.join(add_rul(tel.select(UNIT, CYCLE), cap=RUL_CAP), [UNIT, CYCLE]).agg(
        F.regr_intercept(RUL, "sensor_1__mean"), F.regr_slope(RUL, "sensor_1__mean")).first()
    return float(fit[0] or 0.0), float(fit[1] or 0.0)


@query("stream_unit_scores", sql=f"""WITH {TEL_EVENTS}, {rebased(SENS)},
lab AS (SELECT unit_id, time_cycles, CAST(least(max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles, {RUL_CAP}) AS DOUBLE) AS y,
               greatest(length(bin(time_cycles)) - 5, 0) AS part FROM tel),
w AS (SELECT unit_id, time_cycles, {", ".join(f"avg({s}) OVER s5 AS {s}__mean, avg({s}) OVER s20 AS {s}__long_mean" for s in SENS)}, count(*) OVER s20 AS n
      FROM reb WINDOW s5 AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
                      s20 AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
fit AS (SELECT regr_intercept(y, sensor_1__long_mean) AS a, regr_slope(y, sensor_1__long_mean) AS b FROM w JOIN lab USING (unit_id, time_cycles) WHERE n = 20),
sent AS (SELECT unit_id, part + 1 AS part, count(*) AS late FROM lab WHERE time_cycles % 10 = 0 GROUP BY ALL),
seen AS (SELECT l.unit_id, l.time_cycles, CAST(coalesce(sum(s.late), 0) AS BIGINT) AS late_rows
         FROM lab l LEFT JOIN sent s ON s.unit_id = l.unit_id AND s.part <= l.part GROUP BY ALL)
SELECT unit_id, time_cycles, {", ".join(f"round({s}__mean, 6) AS {s}__mean, round({s}__long_mean, 6) AS {s}__long_mean" for s in SENS)},
       round(a + b * sensor_1__long_mean, 6) AS predicted_rul, late_rows
FROM w JOIN seen USING (unit_id, time_cycles), fit WHERE n = 20""")
def q_st1_scores(spark, sf):
    """Predictions from the window features; every tenth row of a range is sent again with the next one, and is late there."""
    tel = events_telemetry(spark, sf)
    a, b = window_model(tel)
    part = arrival_range(F.col(CYCLE))
    rows = tel.withColumn("_range", part).unionByName(tel.where(F.col(CYCLE) % 10 == 0).withColumn("_range", part + 1))
    scored = _replayed(spark, rows, lambda f: f.withColumn("predicted_rul", F.lit(a) + F.lit(b) * F.col("sensor_1__long_mean")))
    out = scored.select(*[c for c in output_columns(SENS) if c != "late_rows"], "predicted_rul", "late_rows")
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


_ST2_SQL = f"""WITH ev AS (SELECT ts, CAST(value AS DOUBLE) AS sensor_1, CAST(hour(ts) AS DOUBLE) AS sensor_2 FROM events),
al AS (SELECT ts, 'sensor_1' AS feature, sensor_1 AS value FROM ev UNION ALL SELECT ts, 'sensor_2', sensor_2 FROM ev),
prof AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
                avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM al WHERE ts < TIMESTAMP '{SPLIT}' GROUP BY feature),
edges AS (SELECT *, CASE WHEN min = max THEN min - 0.5 ELSE min END AS lo, CASE WHEN min = max THEN max + 0.5 ELSE max END AS hi FROM prof),
raws AS (SELECT ts, feature, value, lo, hi, least(CAST(floor((value - lo) * (10.0 / (hi - lo))) AS INTEGER), 9) AS raw FROM al JOIN edges USING (feature)),
bins AS (SELECT ts, feature, value, {BIN} AS bin FROM raws),
ref AS (SELECT e.feature, b AS bin, (SELECT count(*) FROM bins WHERE bins.feature = e.feature AND bins.bin = b AND ts < TIMESTAMP '{SPLIT}')
               / (SELECT count(value) FROM bins WHERE bins.feature = e.feature AND ts < TIMESTAMP '{SPLIT}') AS r
        FROM edges e, range(0, 10) t(b)),
day AS (SELECT date_trunc('day', ts) AS w, feature, count(*) AS rows, count(value) AS n, min(value) AS mn, max(value) AS mx, avg(value) AS av FROM al GROUP BY ALL),
cur AS (SELECT date_trunc('day', ts) AS w, feature, bin, count(*) AS c FROM bins WHERE bin IS NOT NULL GROUP BY ALL),
psi AS (SELECT d.w, d.feature, abs(sum((greatest(coalesce(c.c, 0) / d.n, CASE WHEN c.c IS NULL THEN 0.0001 ELSE 0 END) - CASE WHEN r.r = 0 THEN 0.0001 ELSE r.r END)
              * ln(greatest(coalesce(c.c, 0) / d.n, CASE WHEN c.c IS NULL THEN 0.0001 ELSE 0 END) / CASE WHEN r.r = 0 THEN 0.0001 ELSE r.r END))) AS psi_score
        FROM day d JOIN ref r ON r.feature = d.feature LEFT JOIN cur c ON c.w = d.w AND c.feature = d.feature AND c.bin = r.bin GROUP BY ALL)
SELECT CAST(d.w AS TIMESTAMP) AS window_start, d.feature, d.rows, d.n, round(psi_score, 6) AS psi_score,
       round(abs(d.av - p.mean) / (p.std + 1e-8), 6) AS mean_drift, round(1 - d.n / d.rows, 6) AS missing_rate,
       (d.mn < p.min * 0.8 OR d.mx > p.max * 1.2) AS range_drift, round(p.missing_rate, 6) AS ref_missing,
       (psi_score > 0.7 OR abs(d.av - p.mean) / (p.std + 1e-8) > 3 OR abs(1 - d.n / d.rows - p.missing_rate) > 0.2
        OR d.mn < p.min * 0.8 OR d.mx > p.max * 1.2) AS drift_detected
FROM day d JOIN psi USING (w, feature) JOIN prof p USING (feature)"""


@query("stream_window_drift", sql=_ST2_SQL)
def q_st2(spark, sf):
    ev = read_table(spark, sf, "events")
    ref = ev.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")).select(
        F.col("value").cast("double").alias("sensor_1"), F.hour("ts").cast("double").alias("sensor_2"))
    feats = ["sensor_1", "sensor_2"]
    prof = reference_profile(ref, feats)
    shares = reference_bin_shares(ref, prof, feats)
    tag = uuid.uuid4().hex[:8]
    parts = replay_events(spark, sf, shared_path(spark, f"st2-staged-{tag}"))
    src, table, ckpt = (shared_path(spark, f"st2-{d}-{tag}") for d in ("src", "out", "ckpt"))

    def trigger():
        return run_updates(windowed_counts(events_sensor_stream(spark, src), prof, feats), ["w", "feature"], table, ckpt)

    last = replay(parts, "_days", src, trigger)
    out = window_verdicts(last, prof, shares).drop("window_end")
    out = out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


@query("stream_late_days", sql=f"""WITH days AS (SELECT date_trunc('day', ts) AS w, count(*) AS n, count(*) FILTER (event_id % 2 = 0) AS again FROM events GROUP BY ALL),
late AS (SELECT w, CASE WHEN w = (SELECT min(w) FROM days) THEN again ELSE 0 END AS again, n FROM days)
SELECT CAST(w AS TIMESTAMP) AS window_start, n + again AS sent, n AS counted, again AS late FROM late""")
def q_late_days(spark, sf):
    """The replay of ``stream_window_drift`` whose last trigger brings half of the first day again: the watermark drops
    those rows, and they are reported."""
    ev = read_table(spark, sf, "events")
    prof = reference_profile(ev.select(F.col("value").cast("double").alias("sensor_1"), F.hour("ts").cast("double").alias("sensor_2")), ["sensor_1", "sensor_2"])
    tag = uuid.uuid4().hex[:8]
    days = ev.withColumn("_days", F.floor(F.unix_date(F.to_date("ts")) / DAYS))
    ends = days.agg(F.min(F.to_date("ts")).alias("first"), F.max("_days").alias("last"))
    again = ev.join(F.broadcast(ends)).where((F.to_date("ts") == F.col("first")) & (F.col("event_id") % 2 == 0))  # one row of ends
    parts = staged(days.unionByName(again.select(*ev.columns, F.col("last").alias("_days"))), "_days", shared_path(spark, f"st2-late-{tag}"))
    src, table, ckpt = (shared_path(spark, f"st2-{d}-{tag}") for d in ("src", "out", "ckpt"))

    def trigger():
        return run_updates(windowed_counts(events_sensor_stream(spark, src), prof, ["sensor_1", "sensor_2"]), ["w", "feature"], table, ckpt)

    out = late_rows(spark, src, replay(parts, "_days", src, trigger))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
