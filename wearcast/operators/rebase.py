"""Re-basing sensors to each unit's early life."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import BASELINE_CYCLES, CYCLE, UNIT, sensor_columns


def baseline_means(df: DataFrame, sensors: list[str], n_first: int = BASELINE_CYCLES,
                   unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """A1: mean of each sensor over cycles ``<= n_first`` per unit (F1 split)."""
    return (df.where(F.col(cycle) <= n_first)
              .groupBy(unit)
              .agg(*[F.avg(s).alias(f"{s}__base") for s in sensors]))


def rebase(df: DataFrame, sensors: list[str] | None = None, n_first: int = BASELINE_CYCLES,
           unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """Keep cycles ``> n_first`` and subtract the unit's baseline mean.

    Left join: a unit with no cycle ``<= n_first`` gets null sensors; a unit
    with only early cycles has no rows left. The baseline table has one row
    per unit, is built by a partial aggregate, and is broadcast by AQE when
    small (sort-merge with skew splitting otherwise).
    """
    if sensors is None:
        sensors = sensor_columns(df.columns)
    sensors = [s for s in sensors if s in df.columns]
    if not sensors:
        return df.where(F.col(cycle) > n_first)
    base = baseline_means(df, sensors, n_first, unit, cycle)
    kept = df.where(F.col(cycle) > n_first).join(base, on=unit, how="left")
    return kept.select(
        *[(F.col(c) - F.col(f"{c}__base")).alias(c) if c in sensors else F.col(c)
          for c in df.columns])
