"""ST1: per-unit streaming state: features of every full window, and predictions from them.

A ``StatefulProcessor`` (``transformWithStateInPandas``) keeps per unit a typed value, ``life``
(last cycle seen, late rows, and per sensor the sum and count of the non-null baseline values:
cycles up to ``n_first``, frozen at the first later cycle), and a typed list, ``recent``, of the
last ``long - 1`` re-based rows. All rows of a unit's micro-batch are sorted together, whatever
chunks they arrive in; a replay that triggers on each ``arrival_range`` in turn bounds them. Once
``long`` re-based rows exist, each new cycle emits the means of the short and the long window per
sensor. Rows at or below the last cycle of an earlier batch (or repeated in one) are late: they
are counted, reported with the unit's next row, and dropped. A null value is left out of means,
as in the batch operators; a sensor without a baseline stays null. Both states expire ``ttl_ms``
after a unit's last row, if given.

``score_stream`` applies a model to the features in ``foreachBatch``; a batch's rows replace what
an earlier try of the same batch wrote.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..schema import BASELINE_CYCLES, CYCLE, LONG_WINDOW, SHORT_WINDOW, UNIT

LIFE = "last_cycle long, late long, frozen boolean, base_sum array<double>, base_n array<long>"
RECENT = "x array<double>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arrival_range(cycle: Column) -> Column:
    """Number of a cycle's range in arrival order: 0 to 31, doubling up to 2**16, then 2**16 cycles each.

    A unit has at most 2**16 rows in a range however long it lives, and lives of a few
    dozen cycles already cross several ranges.
    """
    return F.when(cycle < 1 << 16, F.greatest(F.length(F.bin(F.greatest(cycle, F.lit(0)))) - 5, F.lit(0)).cast("long")) \
            .otherwise(11 + F.shiftright(cycle.cast("long"), 16))


def output_columns(sensors: list[str]) -> list[str]:
    return [UNIT, CYCLE, *[f"{s}__mean" for s in sensors], *[f"{s}__long_mean" for s in sensors], "late_rows"]


def _out_schema(sensors: list[str]) -> str:
    return ", ".join(f"{c} {'long' if c in (UNIT, CYCLE, 'late_rows') else 'double'}" for c in output_columns(sensors))


def window_means(rows: np.ndarray, width: int) -> np.ndarray:
    """Means over the last ``width`` rows at every row with that many, nulls left out."""
    ok = ~np.isnan(rows)
    total = np.vstack([np.zeros((1, rows.shape[1])), np.cumsum(np.where(ok, rows, 0.0), axis=0)])
    many = np.vstack([np.zeros((1, rows.shape[1])), np.cumsum(ok, axis=0)])
    n = many[width:] - many[:-width]
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n > 0, (total[width:] - total[:-width]) / n, np.nan)


def fresh(k: int) -> tuple:
    """State of a unit never seen: last cycle, late rows, frozen, baseline sums and counts, recent rows."""
    return -(1 << 62), 0, False, np.zeros(k), np.zeros(k, np.int64), np.zeros((0, k))


def advance(state: tuple, batch: pd.DataFrame, sensors: list[str], n_first: int = BASELINE_CYCLES,
            short: int = SHORT_WINDOW, long: int = LONG_WINDOW) -> tuple[tuple, pd.DataFrame]:
    """The unit's next state, and a row per new full window: cycle, means, late rows so far."""
    state, cycle, means = step(state, *readings(batch, sensors), n_first, short, long)
    return state, pd.DataFrame({CYCLE: cycle, **dict(zip(output_columns(sensors)[2:-1], means.T)), "late_rows": np.int64(state[1])})


def readings(batch: pd.DataFrame, sensors: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cycles and (rows, sensors) values of a batch."""
    return batch[CYCLE].to_numpy(), np.stack([batch[s].to_numpy(float, na_value=np.nan) for s in sensors], axis=1)


def step(state: tuple, cycle: np.ndarray, values: np.ndarray, n_first: int, short: int, long: int) -> tuple[tuple, np.ndarray, np.ndarray]:
    """The unit's next state, and the cycles and (short, long) means of its new full windows: one call a unit and batch, on arrays."""
    last, late, frozen, base_sum, base_n, recent = state
    order = np.argsort(cycle, kind="stable")
    cycle = cycle[order]
    new = cycle > last
    new[1:] &= cycle[1:] != cycle[:-1]
    late += len(cycle) - int(new.sum())
    cycle, values = cycle[new].astype(np.int64), values[order[new]]
    early = cycle <= n_first if not frozen else np.zeros(len(cycle), bool)
    ok = ~np.isnan(values[early])
    base_sum, base_n = base_sum + np.where(ok, values[early], 0.0).sum(0), base_n + ok.sum(0)
    with np.errstate(invalid="ignore", divide="ignore"):
        rows = values[~early] - np.where(base_n > 0, base_sum / base_n, np.nan)
    frozen = frozen or bool((~early).any())
    series = np.concatenate([recent, rows])
    if len(cycle):
        last = int(cycle[-1])
    full = min(len(rows), max(0, len(series) - long + 1))
    means = np.hstack([window_means(series, w)[-full:] for w in (short, long)]) if full else np.zeros((0, 2 * values.shape[1]))
    return (last, int(late), frozen, base_sum, base_n, series[max(0, len(series) - (long - 1)):]), cycle[~early][-full:] if full else np.zeros(0, np.int64), means


class UnitProcessor(StatefulProcessor):
    """``advance`` over typed state of each unit."""

    def __init__(self, sensors: list[str], n_first: int, short: int, long: int, ttl_ms: int | None):
        self.sensors, self.sizes, self.ttl = list(sensors), (n_first, short, long), ttl_ms

    def init(self, handle) -> None:
        self.life = handle.getValueState("life", LIFE, ttlDurationMs=self.ttl)
        self.recent = handle.getListState("recent", RECENT, ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        state = fresh(len(self.sensors))
        known = self.life.get()   # None for a new unit
        if known is not None:
            last, late, frozen, base_sum, base_n = known
            kept = [r[0] for r in self.recent.get()]   # None becomes NaN
            state = (last, late, frozen, np.array(base_sum, float), np.array(base_n, np.int64), np.array(kept, float).reshape(-1, len(self.sensors)))
        parts = [readings(b, self.sensors) for b in rows]
        cycle, values = parts[0] if len(parts) == 1 else (np.concatenate(x) for x in zip(*parts))
        (last, late, frozen, base_sum, base_n, recent), cycle, means = step(state, cycle, values, *self.sizes)
        self.life.update((last, late, frozen, base_sum.tolist(), base_n.tolist()))
        whole = not np.isnan(recent).any()
        self.recent.put([(r,) if whole else ([None if v != v else v for v in r],) for r in recent.tolist()])
        if len(cycle):
            names = output_columns(self.sensors)
            yield pd.DataFrame({UNIT: key[0], CYCLE: cycle, **dict(zip(names[2:-1], means.T)), "late_rows": np.int64(late)}, columns=names)

    def close(self) -> None:
        pass


def stream_unit_features(stream: DataFrame, sensors: list[str], n_first: int = BASELINE_CYCLES,
                         short: int = SHORT_WINDOW, long: int = LONG_WINDOW, ttl_ms: int | None = None) -> DataFrame:
    """Keyed by unit; one row per new full long window: unit, cycle, short and long means, late rows so far."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)   # typed state needs it
    return (stream.select(UNIT, CYCLE, *sensors).groupBy(UNIT)
                  .transformWithStateInPandas(UnitProcessor(sensors, n_first, short, long, ttl_ms), _out_schema(sensors),
                                              "append", "ProcessingTime" if ttl_ms else "None"))


def score_stream(features: DataFrame, predict: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 trigger: dict | None = None) -> DataFrame:
    """Score all available features into the table at ``path`` (columns of ``predict``'s result and the batch number).

    ``predict`` maps a batch's features to its rows. Each batch has a folder of its own that a
    repeated batch replaces, so a rerun after a failure changes nothing. Features with a time to
    live need another trigger than available-now, which would go on starting batches for them.
    """
    def write(batch: DataFrame, number: int) -> None:
        predict(batch).write.mode("overwrite").parquet(f"{path}/_batch={number}")

    q = (features.writeStream.foreachBatch(write).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination()
    return features.sparkSession.read.parquet(path)
