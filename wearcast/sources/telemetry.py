"""Telemetry-shaped inputs built from the given tables.

Two adapters turn the driver's tables into machine telemetry (unit, cycle,
sensors). Cycle numbers are a per-unit row number, computed with the
skew-safe numbering (one machine may hold a large share of all rows).
NaN becomes null once, here at the source.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import number_rows
from ..schema import CYCLE, RUL, UNIT


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


# Tie-break order for lineitem rows of one supplier: ship date, order line,
# then every other column, so equal keys stay reproducible.
LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def events_telemetry(spark: SparkSession, sf_dir: str,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Adapter A: one user = one machine; value, hour and a constant sensor.

    ``keep`` carries source columns along (e.g. ``ts``, ``event_id``).
    """
    ev = read_table(spark, sf_dir, "events").select(
        *dict.fromkeys(["user_id", "ts", "event_id", "value", *keep]))
    ev = number_rows(ev, ["user_id"], ["ts", "event_id"], out=CYCLE)
    return ev.select(
        *keep,
        F.col("user_id").cast("long").alias(UNIT),
        F.col(CYCLE).cast("long").alias(CYCLE),
        F.dayofmonth("ts").cast("double").alias("op_setting_1"),
        nan_to_null(F.col("value").cast("double")).alias("sensor_1"),
        F.hour("ts").cast("double").alias("sensor_2"),
        F.lit(1.0).cast("double").alias("sensor_3"),
    )


def lineitem_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: one supplier = one machine; four numeric sensors."""
    li = read_table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER, "l_suppkey")
    li = number_rows(li, ["l_suppkey"], LINEITEM_ORDER, out=CYCLE)
    return li.select(
        F.col("l_suppkey").cast("long").alias(UNIT),
        F.col(CYCLE).cast("long").alias(CYCLE),
        nan_to_null(F.col("l_quantity").cast("double")).alias("sensor_1"),
        nan_to_null(F.col("l_extendedprice").cast("double")).alias("sensor_2"),
        nan_to_null(F.col("l_discount").cast("double")).alias("sensor_3"),
        nan_to_null(F.col("l_tax").cast("double")).alias("sensor_4"),
    )


def truncate_lives(df: DataFrame, fraction_num: int = 6, fraction_den: int = 10,
                   unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """Scoring-time view: every unit cut at 60 % of its life, ``rul`` = cycles left.

    Uses integer arithmetic (``cycle * 10 <= life * 6``) so both engines agree.
    """
    life = df.groupBy(unit).agg(F.max(cycle).alias("_life"))
    return (df.join(life, on=unit, how="inner")
              .where(F.col(cycle) * fraction_den <= F.col("_life") * fraction_num)
              .withColumn(RUL, (F.col("_life") - F.col(cycle)).cast("double"))
              .drop("_life"))


def with_nulls_every(df: DataFrame, column: str, key: Column, every: int = 4) -> DataFrame:
    """Quality-drift fixture: null ``column`` where ``key % every = 0``."""
    return df.withColumn(column, F.when(key % every == 0, F.lit(None).cast("double"))
                                  .otherwise(F.col(column)))
