"""Upload path (S3, P4, P5, P6, X9): whitespace text lines derived from
lineitem are parsed by position, conformed to the canonical order, coerced
to numbers (bad text -> null) and null-filled with column medians."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.conform import conform, fill_medians
from ..sources.files import parse_whitespace_lines
from ..sources.telemetry import read_table
from .registry import query

# lineitem -> text: suppkey, linenumber, quantity, extendedprice, discount, tax, returnflag
_TEXT_SQL = """SELECT '  ' || CAST(l_suppkey AS VARCHAR) || ' ' || CAST(l_linenumber AS VARCHAR) || '   '
       || CAST(l_quantity AS VARCHAR) || chr(9) || CAST(l_extendedprice AS VARCHAR) || ' '
       || CAST(l_discount AS VARCHAR) || ' ' || CAST(l_tax AS VARCHAR) || ' ' || l_returnflag || ' ' AS value
FROM lineitem"""


@query("upload_parse_conform", sql=f"""WITH lines AS ({_TEXT_SQL}),
p AS (SELECT regexp_split_to_array(trim(regexp_replace(value, '[\\t ]+', ' ', 'g')), ' ') AS a FROM lines),
c AS (SELECT TRY_CAST(a[1] AS DOUBLE) AS unit_id, TRY_CAST(a[2] AS DOUBLE) AS time_cycles,
             TRY_CAST(a[3] AS DOUBLE) AS op_setting_1, TRY_CAST(a[4] AS DOUBLE) AS op_setting_2,
             TRY_CAST(a[5] AS DOUBLE) AS op_setting_3, TRY_CAST(a[6] AS DOUBLE) AS sensor_1,
             TRY_CAST(a[7] AS DOUBLE) AS sensor_2 FROM p)
SELECT unit_id, time_cycles, op_setting_1, op_setting_2, op_setting_3, sensor_1,
       coalesce(sensor_2, (SELECT coalesce(median(sensor_2), 0.0) FROM c)) AS sensor_2,
       CAST(NULL AS DOUBLE) AS rul, 'test' AS data_type, 'FD001' AS dataset FROM c""")
def q_upload(spark, sf):
    return fill_medians(conform(parse_whitespace_lines(_upload_text(spark, sf))))


def _upload_text(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(F.concat(F.lit("  "), F.col("l_suppkey").cast("string"), F.lit(" "),
                              F.col("l_linenumber").cast("string"), F.lit("   "),
                              F.col("l_quantity").cast("string"), F.lit("\t"),
                              F.col("l_extendedprice").cast("string"), F.lit(" "),
                              F.col("l_discount").cast("string"), F.lit(" "),
                              F.col("l_tax").cast("string"), F.lit(" "), F.col("l_returnflag"),
                              F.lit(" ")).alias("value"))


@query("upload_numbered", sql=f"""WITH lines AS ({_TEXT_SQL}),
p AS (SELECT regexp_split_to_array(trim(regexp_replace(value, '[\\t ]+', ' ', 'g')), ' ') AS a FROM lines),
c AS (SELECT TRY_CAST(a[1] AS DOUBLE) AS unit_id, TRY_CAST(a[2] AS DOUBLE) AS time_cycles,
             TRY_CAST(a[3] AS DOUBLE) AS op_setting_1, TRY_CAST(a[4] AS DOUBLE) AS op_setting_2,
             TRY_CAST(a[5] AS DOUBLE) AS op_setting_3, TRY_CAST(a[6] AS DOUBLE) AS sensor_1,
             TRY_CAST(a[7] AS DOUBLE) AS sensor_2 FROM p)
SELECT row_number() OVER (ORDER BY unit_id NULLS FIRST, time_cycles NULLS FIRST, op_setting_1 NULLS FIRST, op_setting_2 NULLS FIRST,
                          op_setting_3 NULLS FIRST, sensor_1 NULLS FIRST, sensor_2 NULLS FIRST) AS id, *,
       CAST(NULL AS DOUBLE) AS rul, 'test' AS data_type, 'FD001' AS dataset FROM c""")
def q_numbered(spark, sf):
    """P5: the conformed upload with its ``id``, before filling."""
    return conform(parse_whitespace_lines(_upload_text(spark, sf)), with_id=True)


@query("csv_stage_table", sql="""WITH tel AS (
  SELECT CAST(l_suppkey AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey,
              l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus) AS BIGINT) AS time_cycles,
         CAST(l_quantity AS DOUBLE) AS sensor_1, CAST(l_extendedprice AS DOUBLE) AS sensor_2,
         CAST(l_discount AS DOUBLE) AS sensor_3, CAST(l_tax AS DOUBLE) AS sensor_4
  FROM lineitem)
SELECT * FROM tel""")
def q_csv(spark, sf):
    """K1 + S2: the telemetry stage table written as CSV and read back with a fixed schema."""
    import uuid
    from ..schema import telemetry_schema
    from ..session import shared_path
    from ..sinks.tables import write_table
    from ..sources.files import read_csv_table
    from ..sources.telemetry import lineitem_telemetry
    tel = lineitem_telemetry(spark, sf)
    path = write_table(tel, shared_path(spark, f"csv-{uuid.uuid4().hex[:8]}"), fmt="csv")
    return read_csv_table(spark, path, schema=telemetry_schema(tel.columns))
