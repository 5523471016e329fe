"""Table sources: database scan (S1), CSV (S2), whitespace text upload (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_FIELDS, telemetry_schema


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                    partition_column: str = "unit_id", lower: int | None = None,
                    upper: int | None = None, num_partitions: int = 64) -> DataFrame:
    """Full table scan over JDBC, split into ranges of ``partition_column``.

    Filters and projections applied later are pushed into the database
    query by Catalyst. Without bounds a single connection reads the table.
    """
    props = dict(properties or {})
    if lower is not None and upper is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """CSV with header and a fixed schema (no inference pass)."""
    schema = schema or telemetry_schema(columns) if (schema or columns) else None
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def read_quarantined(spark: SparkSession, path: str, folder: str, schema: T.StructType | None = None,
                     header: bool = True) -> tuple[DataFrame, int]:
    """CSV rows that fit the schema, and the number of those that do not.

    One pass over the files writes all rows to ``folder``/rows and counts the broken ones: lines
    with too few or too many fields, or with a field that is no value of its column. Those are
    kept with their file in ``folder``/quarantine, and are not in the result.
    """
    schema = schema or telemetry_schema()
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .schema(wide).csv(path).withColumn("_file", F.input_file_name()))
    seen = Observation()
    raw.observe(seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("bad")).write.mode("overwrite").parquet(f"{folder}/rows")
    stored = spark.read.parquet(f"{folder}/rows")
    bad = int(seen.get["bad"] or 0)
    if bad:
        stored.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), F.col("_file").alias("file")).write.mode("overwrite").parquet(f"{folder}/quarantine")
    return stored.where(F.col(CORRUPT).isNull()).select(*schema.fieldNames()), bad


class TooManyFieldsError(ValueError):
    pass


def parse_whitespace_lines(lines: DataFrame, value_col: str = "value",
                           max_fields: int = len(RAW_FIELDS), check: bool = True) -> DataFrame:
    """S3: split each line on runs of blanks, name fields by position.

    Leading/trailing blanks are ignored, blank lines skipped. Only as many
    columns as the widest line are produced (names from the raw field list).
    More than ``max_fields`` fields is an error. Values stay text here;
    ``coerce_numeric`` (P6) turns them into numbers.
    """
    parts = F.split(F.trim(F.regexp_replace(F.col(value_col), r"[\t ]+", " ")), " ")
    rows = (lines.where(F.length(F.trim(F.col(value_col))) > 0)
                 .select(parts.alias("_parts")))
    width = rows.agg(F.max(F.size("_parts")).alias("w")).first()["w"] or 0
    if check and width > max_fields:
        raise TooManyFieldsError(
            f"line has {width} fields, at most {max_fields} are allowed")
    names = RAW_FIELDS[:width]
    return rows.select(*[F.get(F.col("_parts"), i).alias(n) for i, n in enumerate(names)])


def read_whitespace_text(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    return parse_whitespace_lines(spark.read.text(path), check=check)
