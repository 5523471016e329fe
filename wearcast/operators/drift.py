"""Reference profile and drift detection.

All sensors are handled in one long-form pass: ``unpivot`` to
(feature, value), then grouped aggregates keyed by feature. Tables keyed by
feature have one row per column of the input, so their size is bounded by
the schema and they are broadcast explicitly.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..schema import CYCLE, UNIT, sensor_columns
from ..session import shared_path
from .sequence import cumulative_sum

PSI_BINS = 10


def long_form(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) rows; nulls kept (they count as missing)."""
    return df.select(*[F.col(f).cast("double").alias(f) for f in features]) \
             .unpivot([], features, "feature", "value")


def _one(df: DataFrame) -> DataFrame:
    """Tag a one-row table with a constant key for an equi-join with another."""
    return df.withColumn("_k", F.lit(1))


# --- A2/A4/F4: reference statistics --------------------------------------------

def reference_profile(ref: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Per feature: mean, sample sd, min, max over non-null values; missing rate; count."""
    features = features or sensor_columns(ref.columns)
    return (long_form(ref, features).groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg(F.col("value").isNull().cast("double")).alias("missing_rate"),
        F.count("value").alias("n")))


def fleet_shape(df: DataFrame, unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """A3: mean over units of the last cycle, distinct units, overall last cycle."""
    per_unit = df.groupBy(unit).agg(F.max(cycle).alias("_last"))
    return per_unit.agg(F.avg("_last").cast("double").alias("avg_cycles_per_unit"),
                        F.count(F.lit(1)).alias("total_units"),
                        F.max("_last").cast("long").alias("total_cycles"))


def hashed_sample(df: DataFrame, rows: int = 5000, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """O2 option: reproducible sample of ``rows`` rows by hash order (top-k, no driver pass)."""
    key = key or df.columns
    return df.orderBy(F.xxhash64(F.lit(seed), *key)).limit(rows)


# --- A5/D2: PSI -----------------------------------------------------------------

def bin_index(value, lo, hi, bins: int = PSI_BINS):
    """Equal-width bin of ``value`` over [lo, hi] like a NumPy histogram.

    Last bin closed; values outside the range get null. Edges are
    ``lo + k * (hi - lo) / bins``, and the index is corrected against them.
    """
    v, lo, hi = [F.col(c) if isinstance(c, str) else c for c in (value, lo, hi)]
    step = (hi - lo) / bins
    raw = F.floor((v - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int")
    raw = F.least(raw, F.lit(bins - 1))
    lower = lo + raw.cast("double") * step
    upper = F.when(raw == bins - 1, hi).otherwise(lo + (raw + 1).cast("double") * step)
    idx = (F.when(v < lower, raw - 1)
            .when((v >= upper) & (raw != bins - 1), raw + 1)
            .otherwise(raw))
    return F.when((v >= lo) & (v <= hi), idx)


def psi_edges(profile: DataFrame) -> DataFrame:
    """Reference range per feature; a constant feature is widened to +-0.5."""
    same = F.col("min") == F.col("max")
    return profile.select("feature",
                          F.when(same, F.col("min") - 0.5).otherwise(F.col("min")).alias("lo"),
                          F.when(same, F.col("max") + 0.5).otherwise(F.col("max")).alias("hi"))


def value_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, n): how often each value occurs, nulls included; one partial aggregate.

    Profile checks, bins and distribution functions all follow from it, so a stored
    reference needs no second look at its rows.
    """
    return long_form(df, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def psi_from_counts(ref: DataFrame, cur: DataFrame, profile: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """``|sum (c - r) ln(c / r)|`` over reference-range bins, zero share -> 1e-4."""
    edges = F.broadcast(psi_edges(profile))

    def counts(df: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        binned = (df.where(F.col("value").isNotNull()).join(edges, "feature")
                    .select("feature", bin_index("value", "lo", "hi", bins).alias("bin"), "n"))
        per_bin = binned.groupBy("feature", "bin").agg(F.sum("n").alias(f"c_{side}"))
        return per_bin.where(F.col("bin").isNotNull()), per_bin.groupBy("feature").agg(F.sum(f"c_{side}").alias(f"n_{side}"))

    rb, rn = counts(ref, "ref")
    cb, cn = counts(cur, "cur")
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    shares = (grid.join(rb, ["feature", "bin"], "left").join(cb, ["feature", "bin"], "left")
                  .join(F.broadcast(rn), "feature").join(F.broadcast(cn), "feature")
                  .select("feature",
                          (F.coalesce(F.col("c_ref"), F.lit(0)) / F.col("n_ref")).alias("r"),
                          (F.coalesce(F.col("c_cur"), F.lit(0)) / F.col("n_cur")).alias("c")))
    return shares.groupBy("feature").agg(F.abs(F.sum(X.psi_term("r", "c"))).alias("psi_score"))


def psi(ref: DataFrame, cur: DataFrame, features: list[str], profile: DataFrame | None = None,
        bins: int = PSI_BINS) -> DataFrame:
    """D2 of two tables of readings."""
    profile = profile if profile is not None else reference_profile(ref, features)
    return psi_from_counts(value_counts(ref, features), value_counts(cur, features), profile, bins)


# --- D1/W5: two-sample KS -------------------------------------------------------

def _kolmogorov_sf(lam):
    """Asymptotic P(K > lam) = 2 sum (-1)^(k-1) exp(-2 k^2 lam^2), 100 terms, clipped to [0, 1]."""
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                        lambda acc, k: acc + F.pow(F.lit(-1.0), (k - 1).cast("double"))
                        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(terms * 2.0, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(ref: DataFrame, cur: DataFrame, features: list[str]) -> DataFrame:
    """D1 of two tables of readings."""
    return ks_from_counts(value_counts(ref, features), value_counts(cur, features))


def ks_from_counts(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """KS statistic ``max |F_ref - F_cur|`` per feature and an asymptotic p-value.

    Empirical CDFs are running sums over distinct values (skew-safe ``cumulative_sum``).
    """
    r = ref.where(F.col("value").isNotNull()).select("feature", "value", F.col("n").alias("cr"), F.lit(0).cast("long").alias("cc"))
    c = cur.where(F.col("value").isNotNull()).select("feature", "value", F.lit(0).cast("long").alias("cr"), F.col("n").alias("cc"))
    per_val = r.unionByName(c).groupBy("feature", "value").agg(
        F.sum("cr").cast("long").alias("cr"), F.sum("cc").cast("long").alias("cc"))
    cum = cumulative_sum(per_val, ["feature"], ["value"], ["cr", "cc"])
    tot = per_val.groupBy("feature").agg(F.sum("cr").alias("n_ref"), F.sum("cc").alias("n_cur"))
    d = (cum.join(F.broadcast(tot), "feature")
            .groupBy("feature", "n_ref", "n_cur")
            .agg(F.max(F.abs(F.try_divide(F.col("cr_cum"), F.col("n_ref"))
                             - F.try_divide(F.col("cc_cum"), F.col("n_cur"))))
                 .alias("ks_statistic")))
    en = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")))
    lam = (en + 0.12 + F.lit(0.11) / en) * F.col("ks_statistic")
    return d.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)) \
            .select("feature", "ks_statistic", _kolmogorov_sf(lam).alias("ks_p_value"))


# --- D3/D4: per-feature drift ---------------------------------------------------

def feature_drift(ref: DataFrame, cur: DataFrame, features: list[str] | None = None,
                  profile: DataFrame | None = None, with_ks: bool = True) -> DataFrame:
    """D4 detail rows of two tables of readings.

    Features missing from the profile or empty on either side are skipped.
    """
    features = features or [f for f in sensor_columns(cur.columns) if f in ref.columns]
    profile = profile if profile is not None else reference_profile(ref, features)
    return feature_drift_from_counts(value_counts(ref, features), value_counts(cur, features), profile, with_ks)


def feature_drift_from_counts(ref: DataFrame, cur: DataFrame, profile: DataFrame, with_ks: bool = True) -> DataFrame:
    """D4 detail rows: KS, PSI, mean shift, means and the drift flag per feature."""
    prof = F.broadcast(profile.where(F.col("n") > 0)
                       .select("feature", F.col("mean").alias("reference_mean"),
                               F.coalesce(F.col("std"), F.lit(float("nan"))).alias("_ref_std")))
    some = cur.where(F.col("value").isNotNull())
    cur_stats = some.groupBy("feature").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("current_mean"))
    out = (cur_stats.join(prof, "feature").join(psi_from_counts(ref, cur, profile), "feature")
           .withColumn("mean_drift", X.normalised_diff("current_mean", "reference_mean", "_ref_std")))
    if with_ks:
        out = out.join(ks_from_counts(ref, cur), "feature")
    else:
        out = out.withColumn("ks_statistic", F.lit(None).cast("double")) \
                 .withColumn("ks_p_value", F.lit(None).cast("double"))
    return out.select("feature", "ks_statistic", "ks_p_value", "psi_score", "mean_drift",
                      "reference_mean", "current_mean",
                      X.feature_drift_flag("psi_score", "mean_drift").alias("drift_detected"))


# --- D5/D6: quality issues ------------------------------------------------------

def quality_issues(cur: DataFrame, profile: DataFrame, tol: float = X.RANGE_TOLERANCE,
                   relative_to: str = "value") -> DataFrame:
    """D5/D6 of a table of readings; features without a profile are skipped."""
    return quality_issues_from_counts(value_counts(cur, sensor_columns(cur.columns)), profile, tol, relative_to)


def quality_issues_from_counts(cur: DataFrame, profile: DataFrame, tol: float = X.RANGE_TOLERANCE,
                               relative_to: str = "value") -> DataFrame:
    """Missing-rate change > 0.2 and current range outside the tolerance band.

    Rows: issue, reference array, current array, drift_detected (always true).
    """
    stats = cur.groupBy("feature").agg(
        (F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("cur_missing"),
        F.min("value").alias("cur_min"), F.max("value").alias("cur_max"))
    j = stats.join(F.broadcast(profile), "feature")
    miss = j.where(F.abs(F.col("cur_missing") - F.col("missing_rate")) > X.MISSING_RATE_DRIFT).select(
        F.concat(F.col("feature"), F.lit("_missing_rate")).alias("issue"),
        F.array(F.col("missing_rate")).alias("reference"),
        F.array(F.col("cur_missing")).alias("current"))
    lo, hi = X.tolerance_bounds("min", "max", tol, relative_to)
    rng = j.where((F.col("cur_min") < lo) | (F.col("cur_max") > hi)).select(
        F.concat(F.col("feature"), F.lit("_range")).alias("issue"),
        F.array(F.col("min"), F.col("max")).alias("reference"),
        F.array(F.col("cur_min"), F.col("cur_max")).alias("current"))
    return miss.unionByName(rng).withColumn("drift_detected", F.lit(True))


# --- D7: temporal drift ---------------------------------------------------------

def temporal_drift(cur: DataFrame, ref_fleet: DataFrame) -> DataFrame:
    """Relative change of mean life length; drift when > 0.5."""
    cf = fleet_shape(cur).select(F.col("avg_cycles_per_unit").alias("current_avg_cycles"))
    rf = ref_fleet.select(F.col("avg_cycles_per_unit").alias("reference_avg_cycles"))
    return (_one(rf).join(_one(cf), "_k").drop("_k")
              .withColumn("cycle_drift_ratio",
                          X.relative_diff("current_avg_cycles", "reference_avg_cycles"))
              .withColumn("temporal_drift", F.col("cycle_drift_ratio") > X.LIFE_LENGTH_DRIFT))


# --- D8/D9: verdict -------------------------------------------------------------

def drift_summary(detail: DataFrame, issues: DataFrame, temporal: DataFrame) -> DataFrame:
    """One row: flags, counts, percentage and the recommendation."""
    d = detail.agg(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("data_drift"),
                   F.count(F.lit(1)).alias("features_analyzed"),
                   F.count_if("drift_detected").alias("features_with_drift"),
                   F.avg("psi_score").alias("mean_psi"))
    q = issues.agg((F.count(F.lit(1)) > 0).alias("quality_drift"))
    t = temporal.agg(F.coalesce(F.bool_or("temporal_drift"), F.lit(False)).alias("temporal_drift"))
    s = _one(d).join(_one(q), "_k").join(_one(t), "_k")  # one-row tables
    overall = F.col("data_drift") | F.col("quality_drift") | F.col("temporal_drift")
    return s.drop("_k").select(
        "data_drift", "quality_drift", "temporal_drift", overall.alias("overall_drift"),
        "features_analyzed", "features_with_drift",
        F.when(F.col("features_analyzed") > 0,
               F.col("features_with_drift") / F.col("features_analyzed") * 100.0)
         .otherwise(F.lit(0.0)).alias("drift_percentage"),
        F.least(F.lit(1.0), F.coalesce(F.col("mean_psi"), F.lit(0.0))).alias("drift_severity"),
        F.when(overall, F.lit("retrain")).otherwise(F.lit("proceed_with_prediction"))
         .alias("recommendation"))


def with_unreadable(summary: DataFrame, bad_rows: int) -> DataFrame:
    """Input that could not be read is quality drift and leads to retraining, whatever the readable rows say."""
    return summary.withColumns({"quality_drift": F.lit(True), "overall_drift": F.lit(True), "recommendation": F.lit("retrain"),
                                "unreadable_rows": F.lit(bad_rows).cast("long")})


def first_run_report(spark) -> DataFrame:
    """No reference profile -> drift, retrain."""
    return spark.createDataFrame(
        [(datetime.now(timezone.utc).replace(tzinfo=None), True, True, True, "retrain",
          "first run: no stored reference, train before scoring")],
        "ts timestamp, first_run boolean, data_drift boolean, overall_drift boolean, "
        "recommendation string, reason string")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """A small table written to the shared folder and read back, so it is computed once."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def detect_drift(ref_profile: DataFrame | None, ref_fleet: DataFrame | None, ref: DataFrame | None,
                 cur: DataFrame, ref_counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """D8 end to end: detail, issues, temporal, summary (or the first-run form).

    The reference is its stored profile, fleet shape and value counts; ``ref`` rows are
    only needed where the counts are not given. The current readings are scanned once for
    their value counts and once for the fleet shape.
    """
    if ref_profile is None or (ref is None and ref_counts is None):
        return {"summary": first_run_report(cur.sparkSession)}
    features = sensor_columns(cur.columns)
    counts = materialise(value_counts(cur, features), "drift-counts")
    if ref_counts is None:
        ref_counts = materialise(value_counts(ref, [f for f in features if f in ref.columns]), "drift-counts")
    detail = materialise(feature_drift_from_counts(ref_counts, counts, ref_profile), "drift-detail")
    issues = quality_issues_from_counts(counts, ref_profile)
    temporal = temporal_drift(cur, ref_fleet)
    summary = drift_summary(detail, issues, temporal)
    return {"detail": detail, "issues": issues, "temporal": temporal, "summary": summary}


def report_json(parts: dict[str, DataFrame]) -> DataFrame:
    """The report as one JSON document: summary, feature drifts, quality issues,
    temporal drift and the thresholds used."""
    summary = parts["summary"]
    doc = summary.select(F.current_timestamp().alias("timestamp"), F.struct(*summary.columns).alias("summary"))
    for key, name in (("detail", "feature_drifts"), ("issues", "quality_drifts")):
        if parts.get(key) is not None:
            df, by = parts[key], "feature" if key == "detail" else "issue"
            one = df.agg(F.map_from_entries(F.collect_list(F.struct(
                by, F.struct(*[c for c in df.columns if c != by])))).alias(name))
            doc = _one(doc).join(_one(one), "_k").drop("_k")
    if parts.get("temporal") is not None:
        t = parts["temporal"]
        doc = _one(doc).join(_one(t.select(F.struct(*t.columns).alias("temporal_drift"))), "_k").drop("_k")
        doc = doc.withColumn("thresholds", F.create_map(
            F.lit("psi"), F.lit(X.PSI_DRIFT), F.lit("mean_shift"), F.lit(X.MEAN_SHIFT_DRIFT),
            F.lit("missing_rate"), F.lit(X.MISSING_RATE_DRIFT), F.lit("life_length"), F.lit(X.LIFE_LENGTH_DRIFT)))
    return doc.select(F.to_json(F.struct(*doc.columns)).alias("report"))
