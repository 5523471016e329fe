"""Registered feature-extraction queries: long-window kernels (T1-T16, T18,
T19), short-window means, their join (J2), and ADF (rows-only check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.kernels import LONG_CALCULATORS
from ..operators.features import extract_features, join_feature_sets, short_features
from ..operators.rebase import rebase
from ..sources.telemetry import events_telemetry
from .oracle_sql import TEL_EVENTS, rebased
from .registry import query

SENS = ["sensor_1", "sensor_2", "sensor_3"]
SQL_CALC = {k: v for k, v in LONG_CALCULATORS.items() if k != "augmented_dickey_fuller"}


def _round_all(df, digits: int = 6):
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _sig(c):
    """Six significant digits by decimal text, the same in both engines; numerical noise around 0 is 0.

    The factor moves exact decimal ties (inputs have one decimal) clearly to one side.
    """
    return F.when(F.abs(c) < 1e-6, 0.0).otherwise(F.format_string("%.5e", c * 1.00000013).try_cast("double"))


def _kernel_sql(sensors: list[str], width: int = 20) -> str:
    """DuckDB SQL written from the definitions on list values, in stages: windows as lists,
    mean and variance, autocorrelations, spectrum, spectral moments, then one column per
    sensor and kernel. Partial autocorrelations come from determinants of the Yule-Walker
    equations, the trend from centred sums; nothing is rendered from the implementation."""
    n = width

    def total(last: int, term: str) -> str:
        return f"list_sum(list_transform(range(1, {last + 1}), lambda i: {term}))"

    sums = {f"r{k}": f"CASE WHEN v > 1e-8 THEN {total(n - k, f'(x[i] - m) * (x[i + {k}] - m)')} / (v * {n - k}) END" for k in range(4)}
    spectrum = {f"a{k}": f"sqrt(pow({total(n, f'x[i] * cos(2 * pi() * (i - 1) * {k} / {n})')}, 2) + pow({total(n, f'x[i] * sin(2 * pi() * (i - 1) * {k} / {n})')}, 2))"
                for k in range(n // 2 + 1)}
    whole = " + ".join(f"a{k}" for k in range(n // 2 + 1))
    raw = {f"f{e}": f"({' + '.join(f'a{k} * {k ** e}' for k in range(n // 2 + 1))}) / nullif({whole}, 0)" for e in (1, 2, 3, 4)}
    mid, sxx = (n + 1) / 2, sum((j - (n - 1) / 2) ** 2 for j in range(n))
    kernels = {
        "mean_change": f"(x[{n}] - x[1]) / {n - 1}", "mean": "m", "standard_deviation": "sqrt(v)",
        "root_mean_square": f"sqrt({total(n, 'x[i] * x[i]')} / {n})", "maximum": "list_max(x)", "minimum": "list_min(x)",
    }
    for name in ("maximum", "minimum"):
        best = f"list_{name[:3]}(x)"
        kernels[f"first_location_of_{name}"] = f"(list_position(x, {best}) - 1) / {n}.0"
        kernels[f"last_location_of_{name}"] = f"({n + 1} - list_position(list_reverse(x), {best})) / {n}.0"
    for k in (1, 2, 3):
        rows = n - 2 * k
        kernels[f"time_reversal_asymmetry_statistic__lag_{k}"] = f"{total(rows, f'pow(x[i + {2 * k}], 2) * x[i + {k}] - x[i + {k}] * pow(x[i], 2)')} / {rows}"
        kernels[f"c3__lag_{k}"] = f"{total(rows, f'x[i] * x[i + {k}] * x[i + {2 * k}]')} / {rows}"
    kernels["cid_ce__normalize_False"] = f"sqrt({total(n - 1, 'pow(x[i + 1] - x[i], 2)')})"
    kernels["cid_ce__normalize_True"] = f"CASE WHEN v = 0 THEN 0 ELSE sqrt({total(n - 1, 'pow(x[i + 1] - x[i], 2)')}) / sqrt(v) END"
    for k in range(4):
        kernels[f"autocorrelation__lag_{k}"] = f"r{k}"
    one = "nullif(1 - r1 * r1, 0)"
    kernels["partial_autocorrelation__lag_0"] = "1.0"
    kernels["partial_autocorrelation__lag_1"] = "r1"
    kernels["partial_autocorrelation__lag_2"] = f"(r2 - r1 * r1) / {one}"
    kernels["partial_autocorrelation__lag_3"] = f"CASE WHEN {one} IS NOT NULL THEN (pow(r1, 3) - r1 * r2 * (2 - r2) + r3 * (1 - r1 * r1)) / nullif(1 - r2 * r2 - 2 * r1 * r1 * (1 - r2), 0) END"
    sxy = total(n, f"(i - {mid}) * (x[i] - m)")
    kernels['linear_trend__attr_"slope"'] = f"{sxy} / {sxx}"
    kernels['linear_trend__attr_"intercept"'] = f"m - {sxy} / {sxx} * {(n - 1) / 2}"
    kernels['linear_trend__attr_"stderr"'] = f"sqrt(greatest(0, {n} * v - pow({sxy}, 2) / {sxx}) / {sxx} / {n - 2})"
    for k in range(n // 2 + 1):
        kernels[f'fft_coefficient__attr_"abs"__coeff_{k}'] = f"a{k}"
    spread = "(f2 - f1 * f1)"
    kernels['fft_aggregated__aggtype_"centroid"'] = "f1"
    kernels['fft_aggregated__aggtype_"variance"'] = spread
    kernels['fft_aggregated__aggtype_"skew"'] = f"CASE WHEN {spread} >= 0.5 THEN (f3 - 3 * f1 * {spread} - pow(f1, 3)) / pow({spread}, 1.5) END"
    kernels['fft_aggregated__aggtype_"kurtosis"'] = f"CASE WHEN {spread} >= 0.5 THEN (f4 - 4 * f1 * f3 + 6 * f2 * f1 * f1 - 3 * f1) / pow({spread}, 2) END"

    def stage(cols: dict[str, str]) -> str:
        return ", ".join(f"{e} AS {c}" for c, e in cols.items())

    windows = " UNION ALL ".join(
        f"SELECT unit_id, time_cycles, '{s}' AS sensor, list({s}) OVER (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS x FROM reb" for s in sensors)
    named = {name: f"k{i}" for i, name in enumerate(kernels)}
    wide = ", ".join(f"max({k}) FILTER (sensor = '{s}') AS {_q(f'{s}__{name}')}" for s in sensors for name, k in named.items())
    final = ", ".join(f"CASE WHEN abs({e}) < 1e-6 THEN 0.0 ELSE CAST(printf('%.5e', ({e}) * 1.00000013) AS DOUBLE) END AS {named[name]}" for name, e in kernels.items())
    return f"""WITH {TEL_EVENTS},
{rebased(sensors)},
win AS ({windows}),
s1 AS (SELECT *, list_sum(x) / {n} AS m FROM win WHERE len(x) = {n}),
s2 AS (SELECT *, {total(n, "pow(x[i] - m, 2)")} / {n} AS v FROM s1),
s3 AS (SELECT *, {stage(sums)}, {stage(spectrum)} FROM s2),
s4 AS (SELECT *, {stage(raw)} FROM s3),
s5 AS (SELECT unit_id, time_cycles, sensor, {final} FROM s4)
SELECT unit_id, time_cycles, {wide} FROM s5 GROUP BY unit_id, time_cycles"""


@query("window_kernels_long", sql=_kernel_sql(SENS))
def q_kernels(spark, sf):
    reb = rebase(events_telemetry(spark, sf), SENS)
    out = extract_features(reb, SENS, 20, SQL_CALC, dense=True)
    return out.select(*[_sig(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in out.schema.fields])


@query("window_mean_short", sql=f"""WITH {TEL_EVENTS}, {rebased(SENS)}
SELECT unit_id, time_cycles, {", ".join(f'round(avg({s}) OVER w, 6) AS "{s}__mean"' for s in SENS)}
FROM reb WINDOW w AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
QUALIFY count(*) OVER w = 5""")
def q_short(spark, sf):
    reb = rebase(events_telemetry(spark, sf), SENS)
    return _round_all(short_features(reb, SENS, dense=True))


@query("window_adf")
def q_adf(spark, sf):
    reb = rebase(events_telemetry(spark, sf), SENS)
    calc = {"augmented_dickey_fuller": LONG_CALCULATORS["augmented_dickey_fuller"]}
    return _round_all(extract_features(reb, SENS, 20, calc, dense=True))


@query("feature_sets_joined", sql=f"""WITH {TEL_EVENTS}, {rebased(SENS)},
lw AS (SELECT unit_id, time_cycles FROM reb QUALIFY count(*) OVER (PARTITION BY unit_id ORDER BY time_cycles
       ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20),
sw AS (SELECT unit_id, time_cycles, {", ".join(f'avg({s}) OVER w AS "{s}__mean"' for s in SENS)},
       count(*) OVER w AS n FROM reb
       WINDOW w AS (PARTITION BY unit_id ORDER BY time_cycles ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT lw.unit_id, lw.time_cycles, {", ".join(f'round(sw."{s}__mean", 6) AS "{s}__mean"' for s in SENS)}
FROM lw JOIN sw ON lw.unit_id = sw.unit_id AND lw.time_cycles = sw.time_cycles WHERE sw.n = 5""")
def q_joined(spark, sf):
    reb = rebase(events_telemetry(spark, sf), SENS)
    lw = extract_features(reb, SENS, 20, {"mean": None}, dense=True).select("unit_id", "time_cycles")
    return _round_all(join_feature_sets(lw, short_features(reb, SENS, dense=True)))
