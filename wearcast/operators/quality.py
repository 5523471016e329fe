"""Data-quality and pipeline metrics.

Metric rows are ``(ts, stage, metric, labels map<string,string>, value)``
appended to a Parquet table in the shared folder; stage timings are rows of
the same table, summarised by grouped aggregates.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import sensor_columns

METRIC_SCHEMA = "ts timestamp, stage string, metric string, labels map<string,string>, value double"
# Fixed values (must equal the reference): stage-duration histogram bounds
# (seconds) and the pipeline time limit.
DURATION_BOUNDS = [1.0, 5.0, 10.0, 30.0, 60.0, 300.0, 600.0, 1800.0, 3600.0]
SLA_SECONDS = 1800.0


def ingestion_quality(df: DataFrame, dataset_type: str) -> DataFrame:
    """Rows, columns, quality = 1 - nulls / (rows x columns), sensor missing percent."""
    cols = df.columns
    sensors = sensor_columns(cols)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"_n{i}") for i, c in enumerate(cols)]
    r = df.agg(*aggs)
    nulls = sum((F.col(f"_n{i}") for i in range(len(cols))), F.lit(0))
    snulls = sum((F.col(f"_n{cols.index(s)}") for s in sensors), F.lit(0))
    cells = F.col("rows") * F.lit(len(cols))
    return r.select(F.lit(dataset_type).alias("dataset_type"), "rows",
                    F.lit(len(cols)).cast("long").alias("columns"),
                    (F.lit(1.0) - F.try_divide(nulls.cast("double"), cells.cast("double"))).alias("quality_score"),
                    (F.try_divide(snulls.cast("double"), (F.col("rows") * F.lit(max(len(sensors), 1))).cast("double"))
                     * 100.0).alias("sensor_missing_pct"))


def transformation_metrics(before: DataFrame, after: DataFrame, manual_dropped: list[str]) -> DataFrame:
    """Row reduction ratio and dropped-column counts per reason (true counts)."""
    gone = [c for c in before.columns if c not in after.columns]
    manual = [c for c in gone if c in manual_dropped]
    low_var = [c for c in gone if c not in manual_dropped]
    nb = before.agg(F.count(F.lit(1)).alias("rows_before"))
    na = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return (nb.withColumn("_k", F.lit(1)).join(na.withColumn("_k", F.lit(1)), "_k")
              .select("rows_before", "rows_after",
                      F.try_divide(F.col("rows_after").cast("double"), F.col("rows_before").cast("double"))
                       .alias("reduction_ratio"),
                      F.lit(len(manual)).cast("long").alias("dropped_manual"),
                      F.lit(len(low_var)).cast("long").alias("dropped_low_variance")))


def feature_metrics(spark: SparkSession, long_cols: int, short_cols: int, final_cols: int,
                    input_cols: int) -> DataFrame:
    """Feature counts and selection ratio (schema sizes)."""
    return spark.createDataFrame(
        [(long_cols, short_cols, final_cols, final_cols / input_cols if input_cols else 1.0)],
        "long_term long, short_term long, final long, selection_ratio double")


class MetricsTable:
    """K8: append-only metric rows in a Parquet table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, stage: str, metric: str, value: float, **labels: str) -> None:
        row = [(datetime.now(timezone.utc).replace(tzinfo=None), stage, metric,
                {k: str(v) for k, v in labels.items()}, float(value))]
        self.spark.createDataFrame(row, METRIC_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def record_frame(self, stage: str, df: DataFrame) -> None:
        """Every numeric column of a one-row metrics frame becomes a metric row."""
        nums = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "long", "integer")]
        long = df.select(*[F.col(c).cast("double").alias(c) for c in nums]).unpivot([], nums, "metric", "value")
        (long.select(F.current_timestamp().alias("ts"), F.lit(stage).alias("stage"), "metric",
                     F.create_map().cast("map<string,string>").alias("labels"), "value")
             .write.mode("append").parquet(self.path))

    def record_rows(self, stage: str, rows: list[tuple[str, dict[str, str], float]]) -> None:
        """Many metric rows (``metric_rows``) in one write."""
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        if rows:
            self.spark.createDataFrame([(now, stage, m, labels, float(v)) for m, labels, v in rows], METRIC_SCHEMA) \
                .coalesce(1).write.mode("append").parquet(self.path)

    @contextmanager
    def stage(self, name: str):
        """Times a stage; records duration and status (the error is re-raised, not masked)."""
        t = time.time()
        status = "success"
        try:
            yield
        except Exception:
            status = "failure"
            raise
        finally:
            self.record(name, "stage_duration_seconds", time.time() - t, status=status)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def stage_summary(metrics: DataFrame) -> DataFrame:
    """Per (stage, status) executions, total and cumulative duration buckets."""
    d = metrics.where(F.col("metric") == "stage_duration_seconds") \
               .select("stage", F.col("labels")["status"].alias("status"), F.col("value").alias("d"))
    aggs = [F.count(F.lit(1)).alias("executions"), F.sum("d").alias("total_seconds")]
    aggs += [F.count_if(F.col("d") <= b).alias(f"le_{int(b)}") for b in DURATION_BOUNDS]
    return d.groupBy("stage", "status").agg(*aggs)


def sla_flag(metrics: DataFrame, stage: str = "model_prediction") -> DataFrame:
    """Last run of ``stage`` within the time limit."""
    d = metrics.where((F.col("metric") == "stage_duration_seconds") & (F.col("stage") == stage))
    return d.agg(F.max_by("value", "ts").alias("last_seconds")) \
            .select("last_seconds", (F.col("last_seconds") < SLA_SECONDS).alias("within_sla"))
