"""Benchmark the headline stages; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each stage is executed fully (noop sink); all stages run once on sf0.001
first (warm JVM and generated-code cache), then are timed at the target
scale in wall-clock seconds. Row and window counts are reported for windows/second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wearcast.ml import stages as S  # noqa: E402
from wearcast.ml import train as T  # noqa: E402
from wearcast.ml.score import score  # noqa: E402
from wearcast.operators import drift as D  # noqa: E402
from wearcast.operators.features import join_feature_sets, long_features, short_features  # noqa: E402
from wearcast.operators.rebase import rebase  # noqa: E402
from wearcast.plans import registry  # noqa: E402
from wearcast.session import get_session  # noqa: E402
from wearcast.sources.telemetry import events_telemetry, lineitem_telemetry, truncate_lives  # noqa: E402


def run(build) -> float:
    """Seconds to build a plan, with the jobs that building starts, and to run it."""
    t = time.time()
    build().write.format("noop").mode("overwrite").save()
    return time.time() - t


def stages(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    """Run every headline stage once on ``sf_dir``; wall-clock seconds per stage."""
    q = registry.queries()
    times: dict[str, float] = {}
    counts: dict[str, int] = {}

    t = time.time()
    tel_b = lineitem_telemetry(spark, sf_dir).persist()
    counts["telemetry_rows"] = tel_b.count()
    tel_a = events_telemetry(spark, sf_dir, keep=("ts",)).persist()
    counts["events_rows"] = tel_a.count()
    times["ingest"] = time.time() - t

    t = time.time()
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ref, cur = tel_a.where(F.col("ts") < split).drop("ts"), tel_a.where(F.col("ts") >= split).drop("ts")
    prof = D.reference_profile(ref).persist()
    parts = D.detect_drift(prof, D.fleet_shape(ref), ref, cur)
    parts["summary"].collect()
    times["drift"] = time.time() - t

    t = time.time()
    reb = rebase(tel_b).persist()
    counts["preprocessed_rows"] = reb.count()
    times["transform"] = time.time() - t

    times["features_long"] = run(lambda: long_features(reb, dense=True))
    counts["long_windows"] = int(reb.groupBy("unit_id")
                                 .agg(F.greatest(F.count("*") - 19, F.lit(0)).alias("w"))
                                 .agg(F.sum("w")).first()[0])
    times["features_short"] = run(lambda: short_features(reb, dense=True))

    # a machine of 21 sensors, as in the reference's telemetry: the four sensors scaled, for a tenth of the units
    wide = reb.where(F.col("unit_id") % 10 == 0).select("unit_id", "time_cycles", *[(F.col(f"sensor_{i % 4 + 1}") * (i + 1)).alias(f"sensor_{i}") for i in range(1, 22)])
    times["features_21_sensors"] = run(lambda: long_features(wide, dense=True))

    # fit the feature pipelines, tune the boosted half of the grid over four folds, refit, score the 60 % view
    t = time.time()
    tel = tel_a.drop("ts")
    pre = S.preprocessor().fit(tel)
    x = pre.transform(tel).persist()
    lm, sm = S.long_pipeline(dense=True).fit(x), S.short_pipeline(dense=True).fit(x)
    feats = join_feature_sets(lm.transform(x), sm.transform(x)).persist()
    counts["training_rows"] = feats.count()
    times["fit_features"] = time.time() - t
    t = time.time()
    data, inputs = T.training_set(feats)
    res = T.tune(spark, T.with_folds(data), inputs, T.trial_configs()[:4])
    times["train"] = time.time() - t
    art = {"preprocessor": pre, "long_pipeline": lm, "short_pipeline": sm, "model": res["model"], "inputs": inputs}
    times["predict"] = run(lambda: score(truncate_lives(tel).drop("rul"), art))
    for name in ("flagship_health", "eval_metrics", "drift_feature_report", "window_kernels_long"):
        times[name] = run(lambda: q[name](spark, sf_dir))
    for df in (tel_a, tel_b, prof, reb, x, feats):
        df.unpersist()
    return times, counts


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app="wearcast-bench", shuffle_partitions=cpus * 2)
    # warm-up: the same stages on the smallest data (JVM, generated-code cache)
    t = time.time()
    stages(spark, "/root/testdata/sf0.001")
    warmup = time.time() - t
    times, counts = stages(spark, sf_dir)

    total = sum(times.values())
    sensors = 4
    out = {
        "metric": "stage_seconds_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": counts,
        "long_windows_per_sec": round(counts["long_windows"] / times["features_long"], 1),
        "long_sensor_windows_per_sec": round(counts["long_windows"] * sensors / times["features_long"], 1),
        "warmup_sec": round(warmup, 3),
        "cpus": cpus,
        "driver_memory": spark.conf.get("spark.driver.memory", "n/a"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
