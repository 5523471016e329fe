"""Shared SQL fragments for the DuckDB oracle (ANSI SQL over the given tables)."""

# Adapter A: events -> telemetry.
TEL_EVENTS = """tel AS (
  SELECT CAST(user_id AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS time_cycles,
         CAST(day(ts) AS DOUBLE) AS op_setting_1,
         CAST(value AS DOUBLE) AS sensor_1,
         CAST(hour(ts) AS DOUBLE) AS sensor_2,
         CAST(1.0 AS DOUBLE) AS sensor_3
  FROM events)"""

# Adapter B: lineitem -> telemetry.
TEL_LINEITEM = """tel AS (
  SELECT CAST(l_suppkey AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey,
              l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus) AS BIGINT) AS time_cycles,
         CAST(l_quantity AS DOUBLE) AS sensor_1,
         CAST(l_extendedprice AS DOUBLE) AS sensor_2,
         CAST(l_discount AS DOUBLE) AS sensor_3,
         CAST(l_tax AS DOUBLE) AS sensor_4
  FROM lineitem)"""


def rebased(sensors: list[str], src: str = "tel", n_first: int = 10, carry: str = "") -> str:
    """CTEs ``base`` and ``reb``: keep cycles > n, subtract the unit's early mean."""
    avgs = ", ".join(f"avg({s}) AS {s}__b" for s in sensors)
    subs = ", ".join(f"t.{s} - b.{s}__b AS {s}" for s in sensors)
    extra = f", {carry}" if carry else ""
    return f"""base AS (SELECT unit_id, {avgs} FROM {src} WHERE time_cycles <= {n_first} GROUP BY unit_id),
reb AS (SELECT t.unit_id, t.time_cycles{extra}, {subs}
        FROM {src} t LEFT JOIN base b ON t.unit_id = b.unit_id WHERE t.time_cycles > {n_first})"""


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"
