"""Sinks: stage tables (K1), small result tables (K3), drift report (K4),
reference profile (K5). Everything lands in Parquet (CSV as an option)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..operators.drift import report_json


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """K1/K3: write a stage or result table (header on for CSV)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_report(parts: dict[str, DataFrame], path: str) -> str:
    """K4: the drift report as one JSON document."""
    report_json(parts).coalesce(1).write.mode("overwrite").text(path)
    return path


def save_reference(profile: DataFrame, fleet: DataFrame, counts: DataFrame, path: str) -> str:
    """K5: reference profile (per feature), fleet shape (one row) and value counts,
    from which PSI bins and KS follow without the reference rows."""
    counts.write.mode("overwrite").parquet(os.path.join(path, "counts"))
    profile.write.mode("overwrite").parquet(os.path.join(path, "profile"))
    fleet.write.mode("overwrite").parquet(os.path.join(path, "fleet"))
    return path


def load_reference(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The stored reference, or None when it does not exist (first run).

    Only a missing path maps to first-run; other read errors propagate.
    """
    try:
        prof = spark.read.parquet(os.path.join(path, "profile"))
        fleet = spark.read.parquet(os.path.join(path, "fleet"))
        counts = spark.read.parquet(os.path.join(path, "counts"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    return prof, fleet, counts
