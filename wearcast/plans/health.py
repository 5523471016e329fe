"""Flagship: health features per unit.

telemetry -> scoring view (60 % of each life, true RUL) -> re-base on the
first 10 cycles -> 5-row rolling means -> last full window per unit ->
health status from the RUL. One lazy plan; the per-unit tables (life,
baseline) are partial aggregates joined back by unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import health_status
from ..operators.rebase import rebase
from ..operators.rolling import dense_index, last_per_unit, rolling
from ..schema import CYCLE, RUL, SHORT_WINDOW, UNIT, sensor_columns
from ..sources.telemetry import truncate_lives


def short_means(df: DataFrame, sensors: list[str], width: int = SHORT_WINDOW,
                dense: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """5-row rolling mean per sensor, keyed by (unit, last cycle of the window)."""
    idx = dense_index(df, dense=dense)
    out = rolling(idx, width, lambda w: {f"{s}__mean": F.avg(s).over(w) for s in sensors})
    return out.select(UNIT, CYCLE, *carry, *[f"{s}__mean" for s in sensors])


def health_features(telemetry: DataFrame, dense: bool = True, digits: int | None = 6) -> DataFrame:
    sensors = sensor_columns(telemetry.columns)
    scoring = truncate_lives(telemetry)
    based = rebase(scoring, sensors)
    feats = short_means(based, sensors, dense=dense, carry=(RUL,))
    last = last_per_unit(feats, skip_nulls=False)
    cols = [F.col(UNIT), F.col(CYCLE)]
    for s in sensors:
        c = F.col(f"{s}__mean")
        cols.append((F.round(c, digits) if digits is not None else c).alias(f"{s}__mean"))
    cols += [F.col(RUL), health_status(RUL).alias("status")]
    return last.select(*cols)
