"""ST2: drift per event-time window against a stored reference profile.

``withWatermark`` + tumbling ``window()`` aggregation of per-sensor counts,
nulls, min, max, sum and the PSI bin counts (bins from the reference
edges, joined as a static broadcast). Windows are emitted in update mode:
every micro-batch appends the windows it changed to a Parquet table with its
batch number, and the last version of each window is the result, so the
newest windows are there before the watermark passes them. PSI and flags are
computed from that table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators.drift import PSI_BINS, bin_index, psi_edges

#: Days that one trigger of the replay finds.
DAYS = 7


def replay_events(spark: SparkSession, sf_dir: str, folder: str, days: int = DAYS) -> DataFrame:
    """The events table ``staged`` by runs of ``days`` days, numbered ``_days`` in event-time order."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return staged(ev.withColumn("_days", F.floor(F.unix_date(F.to_date("ts")) / days)), "_days", folder)


def events_sensor_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Streaming events as sensor readings (value, hour) from the files in ``folder``."""
    schema = spark.read.parquet(folder).schema
    src = spark.readStream.schema(schema).parquet(folder)
    # event time must be TIMESTAMP for the watermark (session clock is UTC)
    return src.select(F.col("ts").cast("timestamp").alias("ts"),
                      F.col("value").cast("double").alias("sensor_1"),
                      F.hour("ts").cast("double").alias("sensor_2"))


def windowed_counts(stream: DataFrame, profile: DataFrame, features: list[str], ts: str = "ts",
                    window: str = "1 day", watermark: str = "1 day", bins: int = PSI_BINS) -> DataFrame:
    """Long (feature, value) stream -> per (window, feature) counts and bin counts."""
    long = stream.select(ts, *features).unpivot([ts], features, "feature", "value")
    edges = F.broadcast(psi_edges(profile))
    binned = long.join(edges, "feature").withColumn("bin", bin_index("value", "lo", "hi", bins))
    aggs = [F.count(F.lit(1)).alias("rows"), F.count("value").alias("n"),
            F.min("value").alias("min"), F.max("value").alias("max"), F.sum("value").alias("sum")]
    aggs += [F.count_if(F.col("bin") == k).alias(f"b{k}") for k in range(bins)]
    return (binned.withWatermark(ts, watermark)
                  .groupBy(F.window(ts, window).alias("w"), "feature").agg(*aggs))


def window_verdicts(counts: DataFrame, profile: DataFrame, ref_bins: DataFrame,
                    bins: int = PSI_BINS) -> DataFrame:
    """PSI, mean shift, missing-rate change and range flags per (window, feature).

    ``ref_bins`` holds the reference share per (feature, bin) (batch D2 shares).
    """
    ref_wide = (ref_bins.groupBy("feature").pivot("bin", list(range(bins))).agg(F.first("r"))
                        .select("feature", *[F.col(str(k)).alias(f"r{k}") for k in range(bins)]))
    psi = F.abs(sum(X.psi_term(F.col(f"r{k}"), F.try_divide(F.col(f"b{k}"), F.col("n")))
                    for k in range(bins)))
    prof = F.broadcast(profile.select("feature", F.col("mean").alias("ref_mean"),
                                      F.col("std").alias("ref_std"), F.col("min").alias("ref_min"),
                                      F.col("max").alias("ref_max"),
                                      F.col("missing_rate").alias("ref_missing")))
    lo, hi = X.tolerance_bounds("ref_min", "ref_max")
    out = (counts.join(F.broadcast(ref_wide), "feature").join(prof, "feature")
                 .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         "feature", "rows", "n", psi.alias("psi_score"),
                         X.normalised_diff(F.try_divide(F.col("sum"), F.col("n")), "ref_mean", "ref_std")
                          .alias("mean_drift"),
                         (F.lit(1.0) - F.try_divide(F.col("n"), F.col("rows"))).alias("missing_rate"),
                         ((F.col("min") < lo) | (F.col("max") > hi)).alias("range_drift"),
                         "ref_missing"))
    return out.withColumn("drift_detected",
                          X.feature_drift_flag("psi_score", "mean_drift")
                          | (F.abs(F.col("missing_rate") - F.col("ref_missing")) > X.MISSING_RATE_DRIFT)
                          | F.col("range_drift"))


def reference_bin_shares(ref: DataFrame, profile: DataFrame, features: list[str],
                         bins: int = PSI_BINS) -> DataFrame:
    """Reference share per (feature, bin), zero shares kept (floored in the PSI term)."""
    from ..operators.drift import long_form
    edges = F.broadcast(psi_edges(profile))
    b = long_form(ref, features).where(F.col("value").isNotNull()).join(edges, "feature") \
        .select("feature", bin_index("value", "lo", "hi", bins).alias("bin"))
    tot = b.groupBy("feature").agg(F.count(F.lit(1)).alias("t"))
    cnt = b.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("k"))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(cnt, ["feature", "bin"], "left").join(tot, "feature")
                .select("feature", "bin", (F.coalesce(F.col("k"), F.lit(0)) / F.col("t")).alias("r")))


def staged(df: DataFrame, part: str, folder: str) -> DataFrame:
    """``df`` written in one job as one folder per value of ``part``, whatever share of the rows a value has."""
    df.hint("rebalance", part).write.partitionBy(part).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def replay(parts: DataFrame, part: str, folder: str, trigger: Callable[[], DataFrame]) -> DataFrame:
    """Append the parts of a ``staged`` table to the stream's ``folder`` in ascending order and run ``trigger`` after each
    (it starts the stream: the folder is there from the first part on).

    A trigger finds one part and no more, whatever time stamps the store gives to files and in
    whatever order it lists them; state goes on from the trigger's checkpoint. Returns the last result.
    """
    values = [r[0] for r in parts.select(part).distinct().collect()]
    for v in sorted(values, key=lambda v: (v is not None, v)) or [None]:   # an empty table is one empty part
        parts.where(F.col(part).eqNullSafe(v)).drop(part).write.mode("append").parquet(folder)
        out = trigger()
    return out


def late_rows(spark: SparkSession, folder: str, counted: DataFrame, ts: str = "ts", window: str = "1 day") -> DataFrame:
    """Side count of the watermark: per window the rows the source sent, those counted, and those that came too late.

    ``counted`` is the last version of ``windowed_counts``, whose features all count every row.
    """
    sent = spark.read.parquet(folder).groupBy(F.window(F.col(ts).cast("timestamp"), window).alias("w")).agg(F.count(F.lit(1)).alias("sent"))
    kept = counted.groupBy("w").agg(F.max("rows").alias("kept"))
    return sent.join(kept, "w", "left").select(F.col("w.start").alias("window_start"), "sent", F.coalesce("kept", F.lit(0).cast("long")).alias("counted"),
                                               (F.col("sent") - F.coalesce("kept", F.lit(0))).alias("late"))


def run_updates(df: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Drive an update-mode plan into a Parquet table of versions; returns the last version of each key."""
    def write(batch: DataFrame, number: int) -> None:
        # a batch run again, after a failure before its commit, replaces its own versions
        batch.write.mode("overwrite").parquet(f"{path}/_batch={number}")

    q = (df.writeStream.foreachBatch(write).outputMode("update")
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    versions = df.sparkSession.read.parquet(path)
    rest = [c for c in df.columns if c not in keys]
    versions = versions.withColumn("_batch", F.col("_batch").cast("long"))
    last = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_v"))
    return last.select(*keys, *[F.col(f"_v.`{c}`").alias(c) for c in rest])
