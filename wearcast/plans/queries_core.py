"""Core registered queries: sources, labels, re-basing, flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.label import add_rul
from ..operators.rebase import rebase
from ..operators.sequence import number_rows
from ..schema import CYCLE, RUL_CAP, UNIT
from ..sources.telemetry import events_telemetry, lineitem_telemetry
from .health import health_features
from .oracle_sql import TEL_EVENTS, TEL_LINEITEM, r6, rebased
from .registry import query


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# --- S1/W3/W4: telemetry adapters ------------------------------------------

@query("telemetry_events", sql=f"""WITH {TEL_EVENTS}
SELECT CAST(row_number() OVER (ORDER BY unit_id, time_cycles) AS BIGINT) AS id, * FROM tel""")
def q_telemetry_events(spark: SparkSession, sf: str) -> DataFrame:
    tel = events_telemetry(spark, sf)
    return number_rows(tel, [], [UNIT, CYCLE], out="id").select("id", *tel.columns)


@query("telemetry_lineitem", sql=f"WITH {TEL_LINEITEM} SELECT * FROM tel")
def q_telemetry_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return lineitem_telemetry(spark, sf)


# --- W1/X1: capped RUL label ---------------------------------------------------

@query("rul_label_capped", sql=f"""WITH {TEL_LINEITEM}
SELECT unit_id, time_cycles,
       CAST(least(max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles, 135) AS DOUBLE) AS rul
FROM tel""")
def q_rul_label(spark: SparkSession, sf: str) -> DataFrame:
    tel = lineitem_telemetry(spark, sf).select(UNIT, CYCLE)
    return add_rul(tel, cap=RUL_CAP)


# --- A1/F1/J1: re-base on the first 10 cycles ----------------------------------

_LI_SENSORS = ["sensor_1", "sensor_2", "sensor_3", "sensor_4"]


@query("rebase_first_cycles", sql=f"""WITH {TEL_LINEITEM},
{rebased(_LI_SENSORS)}
SELECT unit_id, time_cycles, {", ".join(r6(s, s) for s in _LI_SENSORS)} FROM reb""")
def q_rebase(spark: SparkSession, sf: str) -> DataFrame:
    return _round(rebase(lineitem_telemetry(spark, sf), _LI_SENSORS))


# --- Flagship: health features per unit (W1, J1, W2, T2, A8, X11) -------------

_EV_SENSORS = ["sensor_1", "sensor_2", "sensor_3"]
_FLAG_SQL = f"""WITH {TEL_EVENTS},
life AS (SELECT unit_id, max(time_cycles) AS life FROM tel GROUP BY unit_id),
test AS (SELECT t.*, CAST(l.life - t.time_cycles AS DOUBLE) AS rul
         FROM tel t JOIN life l ON t.unit_id = l.unit_id WHERE t.time_cycles * 10 <= l.life * 6),
{rebased(_EV_SENSORS, src="test", carry="t.rul")},
win AS (SELECT unit_id, time_cycles, rul,
               {", ".join(f"avg({s}) OVER w AS {s}__mean" for s in _EV_SENSORS)},
               count(*) OVER w AS n
        FROM reb WINDOW w AS (PARTITION BY unit_id ORDER BY time_cycles
                              ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
last AS (SELECT unit_id, max(time_cycles) AS time_cycles,
                {", ".join(f"arg_max({s}__mean, time_cycles) AS {s}__mean" for s in _EV_SENSORS)},
                arg_max(rul, time_cycles) AS rul
         FROM win WHERE n = 5 GROUP BY unit_id)
SELECT unit_id, time_cycles, {", ".join(r6(f"{s}__mean", f"{s}__mean") for s in _EV_SENSORS)}, rul,
       CASE WHEN rul < 50 THEN 'Critical' WHEN rul < 100 THEN 'Warning' ELSE 'Good' END AS status
FROM last"""


@query("flagship_health", sql=_FLAG_SQL)
def q_flagship(spark: SparkSession, sf: str) -> DataFrame:
    return health_features(events_telemetry(spark, sf))
