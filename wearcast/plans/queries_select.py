"""Registered fit-decision queries: constant columns (P2), grouped folds (M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.select import column_variance, group_folds
from ..sources.telemetry import events_telemetry, lineitem_telemetry
from .oracle_sql import TEL_EVENTS, TEL_LINEITEM
from .registry import query

EV_COLS = ["unit_id", "time_cycles", "op_setting_1", "sensor_1", "sensor_2", "sensor_3"]


@query("constant_columns", sql=f"""WITH {TEL_EVENTS},
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM tel" for c in EV_COLS)})
SELECT column_name, round(var_pop(value), 6) AS variance, round(max(value) - min(value), 6) AS value_range,
       coalesce(var_pop(value) <= 0 OR max(value) - min(value) = 0, TRUE) AS constant
FROM l GROUP BY column_name""")
def q_constant(spark, sf):
    out = column_variance(events_telemetry(spark, sf), EV_COLS)
    return out.select("column_name", F.round("variance", 6).alias("variance"),
                      F.round("value_range", 6).alias("value_range"), "constant")


@query("group_folds", sql=f"""WITH {TEL_LINEITEM},
c AS (SELECT unit_id, count(*) AS n FROM tel GROUP BY unit_id),
r AS (SELECT unit_id, row_number() OVER (ORDER BY n DESC, unit_id) AS rk FROM c)
SELECT unit_id, CAST(CASE WHEN (rk - 1) % 8 < 4 THEN (rk - 1) % 8 ELSE 7 - (rk - 1) % 8 END AS INTEGER) AS fold
FROM r""")
def q_folds(spark, sf):
    return group_folds(lineitem_telemetry(spark, sf), 4)
