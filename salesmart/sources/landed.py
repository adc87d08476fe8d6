"""Readers for landed inputs: report responses, rates, config tables,
outlet responses (SRC-1, SRC-2, SRC-3, SRC-5).

Responses are read with explicit schemas (no inference pass over the data).
Report rows should be landed as JSON lines, one record per line, so that
Spark splits a large file over many tasks; a response kept as one document
(``{"data": [...]}``) is read with ``multiLine`` and exploded, which puts
each document in one task and is only meant for documents of bounded size.
Landing folders named ``source=<address>/chunk_from=<date>/`` expose the
source and request chunk as partition columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators.weather import WEATHER_FIELDS


def report_fields_schema(fields: list[str]) -> T.StructType:
    """All-text raw schema for the source's field names (dotted names kept)."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def read_report_lines(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """SRC-1, JSON-lines landing: one report record per line."""
    return spark.read.schema(report_fields_schema(fields)).json(path)


def read_report_records(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1, JSON-lines landing with fields that are not known beforehand.

    One row per line that is not blank: ``record`` (field name -> text, null if
    the line is not one JSON object), ``_raw`` (the line), ``_file`` and the
    folder columns. Nothing of a line is lost: what the mart does not know is
    still in ``record``, and a line that does not parse is still in ``_raw``.
    """
    lines = spark.read.text(path)
    folders = [F.col(c).cast("string").alias(c) for c in lines.columns if c != "value"]
    text = F.btrim("value", F.lit(" \t\n\x0b\f\r"))
    # the pattern is left for lines that end in another line separator
    whole = text.startswith("{") & (text.endswith("}") | F.col("value").rlike(r"\}\s*$"))
    return lines.where(text != F.lit("")).select(
        F.when(whole, F.from_json("value", "map<string,string>")).alias("record"), F.col("value").alias("_raw"),
        F.col("_metadata.file_path").alias("_file"), *folders)


def read_report_documents(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """SRC-1, document landing: the ``data`` array of each response, one row per record."""
    schema = T.StructType([T.StructField("data", T.ArrayType(report_fields_schema(fields)), True)])
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.select(F.explode("data").alias("r")).select(*[F.col("r").getField(f).alias(f) for f in fields])


def with_landing_metadata(df: DataFrame) -> DataFrame:
    """Source and chunk from ``source=``/``chunk_from=`` folders, if present."""
    cols = df.columns
    out = df
    if "source" in cols:
        out = out.withColumnRenamed("source", "_source")
    for edge in ("chunk_from", "chunk_to"):
        if edge in cols:
            out = out.withColumn(f"_{edge}", F.col(edge).cast("date")).drop(edge)
    return out


RATES_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("rub", T.DecimalType(12, 6), True),
    T.StructField("gel", T.DecimalType(12, 6), True),
    T.StructField("amd", T.DecimalType(12, 6), True),
    T.StructField("kgs", T.DecimalType(12, 6), True),
])


def read_rates(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-2: the wide daily rate table. The load window's date filter is
    applied by the conversion and reaches this scan."""
    reader = spark.read
    if fmt != "parquet":
        reader = reader.schema(RATES_SCHEMA).option("header", True)
    return reader.format(fmt).load(path)


def read_config_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-5: tasks, sources, targets, templates or categories as landed tables."""
    return spark.read.format(fmt).load(path)


ORG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("code", T.StringType()), T.StructField("restaurantAddress", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("inn", T.StringType()),
    T.StructField("currencyIsoName", T.StringType()), T.StructField("deliveryServiceType", T.StringType()),
    T.StructField("version", T.StringType()),
])


def read_outlet_responses(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """SRC-3: ``{"organizations": [...]}`` responses -> one row per outlet, with the folder columns.

    ``lines``: one response per line, so large files are split over tasks; else
    each file is one response. What does not parse gives no outlets.
    """
    schema = T.StructType([T.StructField("organizations", T.ArrayType(ORG_SCHEMA), True)])
    docs = spark.read.schema(schema).option("multiLine", not lines).json(path)
    return docs.select(*[c for c in docs.columns if c != "organizations"], F.explode("organizations").alias("o")).select(
        *[c for c in docs.columns if c != "organizations"], "o.*")


_DAILY_VARS = tuple(WEATHER_FIELDS)
_DAILY = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))]
                      + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in _DAILY_VARS])
WEATHER_SCHEMA = T.StructType([T.StructField("daily", _DAILY, True)])


def read_weather_responses(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4 input: one weather response per document; folder partitions
    (e.g. ``cluster=``/``part=``) identify the request."""
    return spark.read.schema(WEATHER_SCHEMA).option("multiLine", True).json(path)
