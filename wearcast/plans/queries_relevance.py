"""Registered relevance queries (M3): exact Kendall tau per feature against
the capped RUL label, and the Benjamini-Yekutieli selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.label import add_rul
from ..operators.relevance import benjamini_yekutieli, kendall_table
from ..schema import LONG_FDR, RUL_CAP
from ..sources.telemetry import events_telemetry
from .oracle_sql import TEL_EVENTS
from .registry import query

FEATS = ["sensor_1", "sensor_2", "op_setting_1"]


def _labelled(spark, sf):
    return add_rul(events_telemetry(spark, sf), cap=RUL_CAP)


# Brute-force oracle: every pair of rows per feature (DuckDB only).
_TAU_SQL = f"""WITH {TEL_EVENTS},
lab AS (SELECT *, CAST(least(max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles, {RUL_CAP}) AS DOUBLE) AS y FROM tel),
lf AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, y FROM lab" for f in FEATS)}),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY x, y) AS rid FROM lf),
pr AS (SELECT a.feature, sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s
       FROM r a JOIN r b ON a.feature = b.feature AND a.rid < b.rid GROUP BY a.feature),
n AS (SELECT feature, count(*) AS n FROM lf GROUP BY feature),
xt AS (SELECT feature, sum(t * (t - 1) / 2) AS xtie, sum(t * (t - 1) * (t - 2)) AS x0,
              sum(t * (t - 1) * (2 * t + 5)) AS x1
       FROM (SELECT feature, x, CAST(count(*) AS DOUBLE) AS t FROM lf GROUP BY ALL) GROUP BY feature),
yt AS (SELECT feature, sum(u * (u - 1) / 2) AS ytie, sum(u * (u - 1) * (u - 2)) AS y0,
              sum(u * (u - 1) * (2 * u + 5)) AS y1
       FROM (SELECT feature, y, CAST(count(*) AS DOUBLE) AS u FROM lf GROUP BY ALL) GROUP BY feature),
a AS (SELECT n.feature, n.n, pr.s, xtie, ytie, x0, x1, y0, y1, n.n * (n.n - 1) / 2.0 AS tot,
             n.n * (n.n - 1.0) AS m
      FROM n JOIN pr USING (feature) JOIN xt USING (feature) JOIN yt USING (feature))
SELECT feature, n, CAST(s AS DOUBLE) AS s,
       round(greatest(-1.0, least(1.0, s / sqrt(tot - xtie) / sqrt(tot - ytie))), 6) AS tau,
       round(s / sqrt((m * (2 * n + 5) - x1 - y1) / 18 + 2 * xtie * ytie / m + x0 * y0 / (9 * m * (n - 2))), 6) AS z
FROM a"""


@query("kendall_tau_label", sql=_TAU_SQL)
def q_tau(spark, sf):
    t = kendall_table(_labelled(spark, sf), FEATS, "rul")
    return t.select("feature", "n", "s", F.round("tau", 6).alias("tau"), F.round("z", 6).alias("z"))


@query("relevance_selection")
def q_select(spark, sf):
    t = benjamini_yekutieli(kendall_table(_labelled(spark, sf), FEATS, "rul"), LONG_FDR)
    return t.select("feature", "p_value", "relevant")
