"""Operator edge cases on hand-made frames (FIXTURES §3) and oracle agreement."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearcast.operators import drift as D
from wearcast.operators import evaluate as E
from wearcast.operators.label import add_rul
from wearcast.operators.rebase import rebase
from wearcast.operators.rolling import last_per_unit
from wearcast.operators.select import group_folds
from wearcast.operators.sequence import cumulative_sum, number_rows
from wearcast.sources.files import TooManyFieldsError, parse_whitespace_lines

SCHEMA = "unit_id long, time_cycles long, sensor_1 double"


def _plain(df, by, order):
    return df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def test_number_rows_equals_plain_window(spark):
    rows = [(u, c, float(c % 7)) for u in (0, 1, 2, None) for c in range(-40, 9000 if u == 0 else 30)]
    df = spark.createDataFrame(rows, SCHEMA)
    for by, order in ((["unit_id"], ["time_cycles"]), ([], ["unit_id", "time_cycles"])):
        a = number_rows(df, by, order, out="r")
        assert sorted(map(repr, a.collect())) == sorted(map(repr, _plain(df, by, order).collect()))


def test_number_rows_by_other_types(spark):
    rows = [(i % 2, float(x), str(x), f"2024-01-{i % 28 + 1:02d} 0{i % 10}:00:00") for i, x in enumerate(
        [0.0, -0.5, 1e300, -1e300, 3.25, 3.2500001, float("inf"), float("-inf"), float("nan"), 1e-300, 5.0, 4.0, 7.5, 641.82, 641.83] * 1)]
    df = spark.createDataFrame(rows + [(0, None, None, None)], "g long, x double, s string, t string").withColumn("t", F.col("t").cast("timestamp"))
    for c in ("x", "s", "t"):
        a = number_rows(df, ["g"], [c, *[k for k in ("x", "s") if k != c]], out="r")
        assert sorted(map(repr, a.collect())) == sorted(map(repr, _plain(df, ["g"], [c, *[k for k in ("x", "s") if k != c]]).collect())), c


def test_numbering_starts_no_job(spark):
    df = spark.range(100).select(F.col("id").alias("unit_id"), F.col("id").alias("time_cycles"))
    spark.sparkContext.setJobGroup("numbering", "numbering")
    number_rows(df, ["unit_id"], ["time_cycles"])
    number_rows(df, [], ["unit_id", "time_cycles"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("numbering")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert number_rows(df.limit(0), [], ["unit_id"]).count() == 0


def test_numbering_with_clashing_column_names(spark):
    names = "_n _row _rank _before _l0 _l1 _s_v _in_v _to_v _p_g _up_v _neg".split()
    rows = [(u, c, float(c), *range(100 * u + c, 100 * u + c + len(names))) for u in (0, 1) for c in range(50)]
    df = spark.createDataFrame(rows, ["g", "o", "v", *names])
    for by, order in ((["g"], ["o"]), ([], ["g", "o"]), (["_n"], ["_row", "o"]), ([], ["_n", "_l0"])):
        a = number_rows(df, by, order, out="r")
        assert sorted(map(repr, a.collect())) == sorted(map(repr, _plain(df, by, order).collect())), (by, order)
        b = cumulative_sum(df, by, order, ["v", "_n"])
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        c = df.withColumn("v_cum", F.sum("v").over(w)).withColumn("_n_cum", F.sum("_n").over(w))
        assert sorted(map(repr, b.collect())) == sorted(map(repr, c.collect())), (by, order)


def test_folds_are_dealt_in_snake_order(spark):
    sizes = {1: 9, 2: 30, 3: 4, 4: 12, 5: 7, 6: 30, 7: 1, 8: 15, 9: 2}
    df = spark.createDataFrame([(u, c) for u, n in sizes.items() for c in range(n)], "unit_id long, time_cycles long")
    order = sorted(sizes, key=lambda u: (-sizes[u], u))
    want = {u: (i % 8 if i % 8 < 4 else 7 - i % 8) for i, u in enumerate(order)}
    assert {r["unit_id"]: r["fold"] for r in group_folds(df).collect()} == want


def test_cumulative_sum_equals_plain_window(spark):
    rows = [(u, v / 8 - 20, v % 3) for u in range(2) for v in range(300)]
    df = spark.createDataFrame(rows, "g long, v double, c long")
    a = cumulative_sum(df, ["g"], ["v"], ["c"])
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    b = df.withColumn("c_cum", F.sum("c").over(w))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rebase_edge_units(spark):
    rows = [(1, c, 1.0) for c in range(11, 20)] + [(2, c, 2.0) for c in range(1, 9)] + \
           [(3, c, float(c)) for c in range(1, 30)]
    out = rebase(spark.createDataFrame(rows, SCHEMA), ["sensor_1"]).collect()
    by_unit = {}
    for r in out:
        by_unit.setdefault(r["unit_id"], []).append(r)
    assert all(r["sensor_1"] is None for r in by_unit[1])   # no baseline cycles
    assert 2 not in by_unit                                 # only early cycles
    assert len(by_unit[3]) == 19
    assert by_unit[3][0]["sensor_1"] == pytest.approx(11 - 5.5)


def test_rul_cap(spark):
    df = spark.createDataFrame([(1, c) for c in range(1, 201)], "unit_id long, time_cycles long")
    r = {x["time_cycles"]: x["rul"] for x in add_rul(df, cap=135).collect()}
    assert r[1] == 135.0 and r[200] == 0.0 and r[100] == 100.0


def test_last_per_unit_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None)], SCHEMA)
    r = last_per_unit(df).first()
    assert r["time_cycles"] == 2 and r["sensor_1"] == 5.0


def test_psi_identity_and_edges(spark):
    ref = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "sensor_1 double")
    const = spark.createDataFrame([(3.0,)] * 5, "sensor_1 double")
    assert D.psi(ref, ref, ["sensor_1"]).first()["psi_score"] == pytest.approx(0.0)
    assert D.psi(const, const, ["sensor_1"]).first()["psi_score"] == pytest.approx(0.0)
    # value equal to the top edge lands in the last bin
    b = ref.select(D.bin_index(F.col("sensor_1"), F.lit(0.0), F.lit(10.0)).alias("b")).collect()
    assert b[-1]["b"] == 9
    # all current values outside the range: every current share floors to 1e-4
    out = spark.createDataFrame([(100.0,)] * 4, "sensor_1 double")
    expected = abs(sum((1e-4 - r) * math.log(1e-4 / r) for r in [2 / 11] + [1 / 11] * 9))
    assert D.psi(ref, out, ["sensor_1"]).first()["psi_score"] == pytest.approx(expected)


def test_negative_min_range_flag(spark):
    df = spark.createDataFrame([(-10.0,), (5.0,)], "sensor_1 double")
    issues = D.quality_issues(df, D.reference_profile(df, ["sensor_1"])).collect()
    assert [r["issue"] for r in issues] == ["sensor_1_range"]


def test_first_run(spark):
    cur = spark.createDataFrame([(1, 1, 1.0)], SCHEMA)
    s = D.detect_drift(None, None, None, cur)["summary"].first()
    assert s["overall_drift"] and s["recommendation"] == "retrain"


def test_zero_truth_and_missing_truth(spark):
    pred = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 7.0)], "engine_id long, predicted_rul double")
    truth = spark.createDataFrame([(1, 0.0), (2, 10.0)], "engine_id long, true_rul double")
    tab = {r["engine_id"]: r for r in E.prediction_table(pred, truth).collect()}
    assert math.isinf(tab[1]["percentage_error"]) and tab[3]["error"] is None
    m = E.evaluation_metrics(pred, truth).first()
    assert m["n_engines"] == 2 and m["mape"] == pytest.approx(0.5)


def test_whitespace_upload(spark):
    lines = spark.createDataFrame([("  1  2 0.5\t1.0 ",), ("1 3 x 2",), ("",)], "value string")
    out = parse_whitespace_lines(lines).collect()
    assert out[0]["unit_id"] == "1" and out[0]["op_setting_2"] == "1.0" and len(out) == 2
    wide = spark.createDataFrame([(" ".join(["1"] * 27),)], "value string")
    with pytest.raises(TooManyFieldsError):
        parse_whitespace_lines(wide)


def test_entry_smoke(spark):
    import __spark_entry__ as E2
    df = E2.entry(spark)
    assert df.count() > 0
    assert "status" in df.columns
