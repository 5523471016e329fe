"""ST1 equals the batch operators; unordered chunks, late rows, nulls and all windows of ST2."""

import math
import os
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearcast.operators.features import extract_features, short_features
from wearcast.operators.rebase import rebase
from wearcast.plans import queries_stream
from wearcast.session import shared_path
from wearcast.sources.telemetry import events_telemetry
from wearcast.streaming.drift_stream import run_updates
from wearcast.streaming.unit_state import advance, arrival_range, fresh, score_stream, stream_unit_features

SF = "/root/testdata/sf0.001"
SCHEMA = "unit_id long, time_cycles long, sensor_1 double, sensor_2 double"


def _batch_means(df):
    based = rebase(df, ["sensor_1", "sensor_2"])
    short = {(r["unit_id"], r["time_cycles"]): r for r in short_features(based, ["sensor_1", "sensor_2"]).collect()}
    long = {(r["unit_id"], r["time_cycles"]): r for r in extract_features(based, ["sensor_1", "sensor_2"], 20, {"mean": None}).collect()}
    return {k: (short[k]["sensor_1__mean"], short[k]["sensor_2__mean"], r["sensor_1__mean"], r["sensor_2__mean"]) for k, r in long.items()}


def test_stream_equals_batch(spark):
    rows = [(u, c, float((u * 7 + c * 3) % 11), float(c % 4)) for u in (1, 2) for c in range(1, 61)]
    df = spark.createDataFrame(rows, SCHEMA)
    tag = uuid.uuid4().hex[:8]
    src = shared_path(spark, f"t-st1-{tag}")
    for p in range(4):  # files appended in arrival order
        df.where(F.floor((F.col("time_cycles") - 1) / 15) == p).withColumn("_p", F.lit(p)) \
          .write.mode("append").partitionBy("_p").parquet(src)
    # a late row (cycle 3 of unit 1 again) in a later file
    spark.createDataFrame([(1, 3, 99.0, 99.0)], SCHEMA).withColumn("_p", F.lit(9)) \
        .write.mode("append").partitionBy("_p").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 4).parquet(src)
    feats = stream_unit_features(stream, ["sensor_1", "sensor_2"])
    paths = shared_path(spark, f"t-st1-out-{tag}"), shared_path(spark, f"t-st1-ck-{tag}")

    def doubled(f):
        return f.withColumn("predicted_rul", F.col("sensor_1__mean") * 2)

    out = score_stream(feats, doubled, *paths)
    got = {(r["unit_id"], r["time_cycles"]): r for r in out.collect()}
    want = _batch_means(df)
    assert len(got) == len(want) == 2 * 31
    for k, w in want.items():
        g = got[k]
        assert (g["sensor_1__mean"], g["sensor_2__mean"], g["sensor_1__long_mean"], g["sensor_2__long_mean"]) == pytest.approx(w)
        assert g["predicted_rul"] == pytest.approx(2 * g["sensor_1__mean"])
    before = sorted(map(repr, out.collect()))
    # the last batch run again, as after a failure before its commit, replaces its own rows
    commits = os.path.join(paths[1].removeprefix("file:"), "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    again = score_stream(feats, doubled, *paths)
    assert sorted(map(repr, again.select(*out.columns).collect())) == before


def test_state_expires_after_its_time_to_live(spark):
    rows = [(1, c, float(c), 1.0) for c in range(1, 61)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for ttl in (None, 1):
        tag = uuid.uuid4().hex[:8]
        src, table, ckpt = (shared_path(spark, f"t-ttl-{d}-{tag}") for d in ("src", "out", "ck"))
        for lo, hi in ((0, 30), (30, 60)):
            df.where((F.col("time_cycles") > lo) & (F.col("time_cycles") <= hi)).coalesce(1).write.mode("append").parquet(src)
            stream = spark.readStream.schema(df.schema).parquet(src)
            out = score_stream(stream_unit_features(stream, ["sensor_1", "sensor_2"], ttl_ms=ttl), lambda f: f, table, ckpt, {"once": True})
        found[ttl] = {r["time_cycles"]: r["sensor_1__long_mean"] for r in out.collect()}
    assert sorted(found[None]) == list(range(30, 61)) and None not in found[None].values()
    # forgotten after the first half: no baseline and no earlier rows
    assert sorted(found[1]) == [30] + list(range(50, 61)) and {found[1][c] for c in range(50, 61)} == {None}



def test_unordered_chunks_and_nulls():
    rng = np.random.default_rng(0)
    full = pd.DataFrame({"unit_id": 1, "time_cycles": np.arange(1, 61), "sensor_1": rng.normal(size=60), "sensor_2": rng.normal(size=60)})
    full.loc[[2, 30, 31], "sensor_1"] = np.nan
    full.loc[:9, "sensor_2"] = np.nan                                   # no baseline at all
    sensors = ["sensor_1", "sensor_2"]
    state, whole = advance(fresh(2), full, sensors)
    _, parts = advance(fresh(2), full.sample(frac=1, random_state=1), sensors)
    pd.testing.assert_frame_equal(whole, parts)
    assert len(whole) == 31
    base = full["sensor_1"][:10].mean()
    assert whole["sensor_1__long_mean"].iloc[0] == pytest.approx((full["sensor_1"][10:30] - base).mean())
    assert whole["sensor_2__long_mean"].isna().all() and (whole["late_rows"] == 0).all()
    # the same rows again are late; new ones go on from the state
    state, none = advance(state, full, sensors)
    assert not len(none) and state[:2] == (60, 60)
    more = pd.DataFrame({"unit_id": 1, "time_cycles": [61], "sensor_1": [1.0], "sensor_2": [math.nan]})
    _, again = advance(state, more, sensors)
    assert again["time_cycles"].tolist() == [61] and again["late_rows"].tolist() == [60]
    # cut anywhere, the pieces give what the whole gives
    at, out = fresh(2), []
    for k in range(0, 60, 7):
        at, some = advance(at, full[k:k + 7], sensors)
        out.append(some)
    pd.testing.assert_frame_equal(pd.concat(out, ignore_index=True), whole)


def test_registered_replay_carries_state(spark, monkeypatch):
    seen, stopped = [], []

    def run(df, predict, path, checkpoint):
        out = score_stream(df, predict, path, checkpoint)
        seen.append(checkpoint)
        stopped.append(out.count())
        return out

    monkeypatch.setattr(queries_stream, "score_stream", run)
    got = queries_stream.q_st1(spark, SF).collect()
    batches = [f for f in os.listdir(os.path.join(seen[0], "commits")) if f.isdigit()]
    assert len(set(seen)) == 1 and len(batches) == len(seen) == 3 and stopped[0] < stopped[1] < stopped[2] == len(got)
    tel = events_telemetry(spark, SF)
    want = {(r["unit_id"], r["time_cycles"]) for r in extract_features(rebase(tel, ["sensor_1"]), ["sensor_1"], 20, {"mean": None}).collect()}
    assert {(r["unit_id"], r["time_cycles"]) for r in got} == want and {r["late_rows"] for r in got} == {0}


def test_arrival_ranges_bound_a_unit(spark):
    r = [(x["id"], x["r"]) for x in spark.range(1, 300_000).select("id", arrival_range(F.col("id")).alias("r")).orderBy("id").collect()]
    assert all(b - a in (0, 1) for (_, a), (_, b) in zip(r, r[1:])) and r[0][1] == 0
    many = pd.Series([b for _, b in r]).value_counts()
    assert many.max() == 1 << 16 and many[0] == 31 and many[1] == 32


def test_updates_keep_last_version(spark):
    tag = uuid.uuid4().hex[:8]
    src = shared_path(spark, f"t-upd-{tag}")
    for p in range(3):
        spark.createDataFrame([("a", p + 1.0), ("b", 1.0)], "k string, v double").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k string, v double").option("maxFilesPerTrigger", 1).parquet(src)
    counts = stream.groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    out = run_updates(counts, ["k"], shared_path(spark, f"t-upd-out-{tag}"), shared_path(spark, f"t-upd-ck-{tag}"))
    assert sorted(map(tuple, out.collect())) == [("a", 6.0, 3), ("b", 3.0, 3)]


def test_days_arrive_in_event_time_order(spark, monkeypatch, tmp_path):
    """More days than one trigger holds: every day is there with all its rows."""
    n = 40
    spark.range(n * 5).select(
        F.col("id").alias("event_id"), F.col("id").alias("user_id"), (F.col("id") % 7).cast("double").alias("value"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 40 as int), cast(id % 24 as int))").alias("ts"),
    ).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    monkeypatch.setattr(queries_stream, "run_updates", lambda df, keys, path, checkpoint: (seen.append(checkpoint), run_updates(df, keys, path, checkpoint))[1])
    out = queries_stream.q_st2(spark, str(tmp_path)).collect()
    assert len(seen) > 3 and len(set(seen)) == 1
    assert len(out) == 2 * n and {r["rows"] for r in out} == {5} and len({r["window_start"] for r in out}) == n


def test_a_batch_run_again_changes_nothing(spark):
    tag = uuid.uuid4().hex[:8]
    src, out, ckpt = (shared_path(spark, f"t-again-{d}-{tag}") for d in ("src", "out", "ck"))
    for p in range(2):
        spark.createDataFrame([("a", p + 1.0)], "k string, v double").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k string, v double").parquet(src)
        counts = stream.groupBy("k").agg(F.sum("v").alias("total"))
        got = run_updates(counts, ["k"], out, ckpt)
    before = got.collect()
    commits = os.path.join(ckpt.removeprefix("file:"), "commits")
    for f in ("1", ".1.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    assert run_updates(counts, ["k"], out, ckpt).collect() == before == [("a", 3.0)]
    assert spark.read.parquet(out).count() == 2


def test_unit_step_works_on_arrays(monkeypatch):
    """a unit's step keeps late, repeated, unsorted and null rows as before, and builds no table of its own."""
    from wearcast.streaming import unit_state as U
    rng = np.random.default_rng(4)
    cycle = np.r_[rng.permutation(np.arange(1, 41)), 7, 7, 30]
    values = rng.random((len(cycle), 2))
    values[5, 0] = np.nan
    frame = pd.DataFrame({"time_cycles": cycle, "a": values[:, 0], "b": values[:, 1]})
    (last, late, *_), table = U.advance(U.fresh(2), frame, ["a", "b"])
    tables = []
    monkeypatch.setattr(U.pd, "DataFrame", lambda *a, **k: tables.append(1))
    state, at, means = U.step(U.fresh(2), cycle, values, 10, 5, 20)
    assert not tables and (last, late) == state[:2] == (40, 3)
    assert at.tolist() == table["time_cycles"].tolist() == list(range(30, 41))
    first = {}
    for c, v in zip(cycle.tolist(), values):
        first.setdefault(c, v)
    based = np.array([first[c] for c in range(11, 41)]) - np.nanmean([first[c] for c in range(1, 11)], axis=0)
    want = [np.r_[np.nanmean(based[k - 4:k + 1], axis=0), np.nanmean(based[k - 19:k + 1], axis=0)] for k in range(19, 30)]
    np.testing.assert_allclose(means, want)
