"""Per-unit labels: remaining useful life (W1) and true RUL per engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CYCLE, RUL, UNIT


def unit_life(df: DataFrame, unit: str = UNIT, cycle: str = CYCLE, out: str = "_life") -> DataFrame:
    """One row per unit with its last cycle (partial aggregate, skew-safe)."""
    return df.groupBy(unit).agg(F.max(cycle).alias(out))


def add_rul(df: DataFrame, cap: float | None = None, unit: str = UNIT, cycle: str = CYCLE,
            out: str = RUL) -> DataFrame:
    """``rul = max(cycle of unit) - cycle``, capped at ``cap`` when given.

    A falsy cap (None or 0) means no cap. The per-unit maximum comes from an
    aggregate joined back on the unit (AQE broadcasts it when small).
    """
    life = unit_life(df, unit, cycle)
    rul = (F.col("_life") - F.col(cycle)).cast("double")
    if cap:
        rul = F.least(rul, F.lit(float(cap)))
    return df.join(life, on=unit, how="inner").withColumn(out, rul).drop("_life")


def true_rul(df: DataFrame, unit: str = UNIT, cycle: str = CYCLE, rul: str = RUL) -> DataFrame | None:
    """Last non-null ``rul`` per unit by cycle; None when there is no rul column."""
    if rul not in df.columns:
        return None
    return (df.where(F.col(rul).isNotNull())
              .groupBy(unit)
              .agg(F.max_by(F.col(rul), F.col(cycle)).cast("double").alias("true_rul")))
