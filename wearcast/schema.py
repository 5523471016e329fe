"""Telemetry data model: key names, canonical column order, types."""

from __future__ import annotations

from pyspark.sql import types as T

UNIT = "unit_id"
CYCLE = "time_cycles"
RUL = "rul"
KEYS = [UNIT, CYCLE]

# Fixed values (must equal the reference): the raw-upload field names by
# position and the canonical 31-column table order.
RAW_FIELDS = (
    ["unit_id", "time_cycles", "op_setting_1", "op_setting_2", "op_setting_3"]
    + [f"sensor_{i}" for i in range(1, 22)]
)
CANONICAL = (
    ["id"] + RAW_FIELDS + ["rul", "data_type", "dataset", "created_at"]
)
# Columns dropped before re-basing.
META_DROP = ["rul", "data_type", "dataset", "created_at"]
# Defaults stamped on an uploaded batch.
UPLOAD_DATA_TYPE = "test"
UPLOAD_DATASET = "FD001"

# Labels and windows (fixed values of the reference pipeline).
RUL_CAP = 135
BASELINE_CYCLES = 10
LONG_WINDOW = 20
SHORT_WINDOW = 5
VALID_RUL_LOW = 6      # validation keeps 6 < rul < 135
LONG_FDR = 0.001
SHORT_FDR = 0.0002
PCA_COMPONENTS = 20
CV_FOLDS = 4

INT_COLS = {"id", "unit_id", "time_cycles"}


def telemetry_type(name: str) -> T.DataType:
    if name in INT_COLS:
        return T.LongType()
    if name in ("data_type", "dataset"):
        return T.StringType()
    if name == "created_at":
        return T.TimestampType()
    return T.DoubleType()


def telemetry_schema(columns=CANONICAL) -> T.StructType:
    return T.StructType([T.StructField(c, telemetry_type(c), True) for c in columns])


def sensor_columns(columns) -> list[str]:
    """Columns featurised, re-based and drift-tested: names starting 'sensor'."""
    return [c for c in columns if c.startswith("sensor")]


def setting_columns(columns) -> list[str]:
    return [c for c in columns if c.startswith("op_setting_")]
