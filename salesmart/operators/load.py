"""The load of landed report lines into a mart (SRC-1, OP-1..OP-8, OP-10..OP-12, SNK-1..4, DML-1, AGG-8).

Landed records are renamed, projected to the mart, coerced, filled and
converted in one pass that is written once (staged), each line with what became
of it. Everything else reads the stage: the rows that fit replace the source
chunks they came for, the others go to the rejects with their raw text, and
the summary and the unknown fields are aggregates over it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import fx, mart, normalize
from salesmart.session import work_dir

CHUNK_FROM, CHUNK_TO = "_chunk_from", "_chunk_to"
METADATA = ["chunk_from", "chunk_to"]


@dataclass(frozen=True)
class LoadReport:
    """``totals`` were observed while the lines were staged; the frames read the stage."""
    stage: str
    totals: dict
    summary: DataFrame
    unknown: DataFrame
    ranges: int = 0
    partitions: int = 0


def prepared(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed records (``record``, ``source``, ``_raw``, ``_file``) as typed mart rows with ``error`` and ``_unknown``."""
    named = normalize.project_records(records, schema, F.col("source"), METADATA, keep=["_raw", "_file"])
    named = named.withColumns({f"_{m}": F.expr(f"try_cast({m} AS DATE)") for m in METADATA}).drop(*METADATA)
    typed = normalize.fill_defaults(normalize.coerce_to_schema(named, schema), schema)
    error = F.when(F.col("_malformed"), F.lit(normalize.MALFORMED)).otherwise(normalize.reject_reason(schema))
    return typed.withColumn("error", error).drop("_malformed")


def _base_schema(spec: mart.MartSpec) -> T.StructType:
    return T.StructType([f for f in spec.schema.fields if not f.name.endswith(fx.BASE_SUFFIX)])


def stage_landed(spark: SparkSession, records: DataFrame, spec: mart.MartSpec, measures: list[str], rates_wide: DataFrame,
                 date_from: dt.date, date_to: dt.date, params: fx.FxParams = fx.FxParams(),
                 connection_currency: str | None = None) -> LoadReport:
    """The one pass over the landing: every line typed, converted and judged, written once and reported on."""
    rows = prepared(records, _base_schema(spec))
    pairs = fx.base_pairs(measures, spec.schema.fieldNames())
    if pairs:
        rows = fx.convert(spark, rows, rates_wide, spec.date_field, [m for m, _ in pairs], date_from, date_to, params,
                          connection_currency, chunk_col=CHUNK_FROM, chunk_end_col=CHUNK_TO)
    # only the rejects need their text again
    rows = rows.withColumn("_raw", F.when(F.col("error").isNotNull(), F.col("_raw")))
    stage, seen = work_dir(spark, "load"), Observation("load")
    rows.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("error").isNull()).alias("inserted"),
                 F.count_if(F.col("error") != normalize.MALFORMED).alias("rejected"),
                 F.count_if(F.col("error") == normalize.MALFORMED).alias("malformed"),
                 F.coalesce(F.sum(F.size("_unknown")), F.lit(0)).alias("unknown_values")).write.parquet(stage, compression="zstd")
    staged = spark.read.schema(rows.schema).parquet(stage)
    return LoadReport(stage, seen.get, normalize.load_summary(staged, pairs), normalize.unknown_fields(staged))


def load_landed(spark: SparkSession, records: DataFrame, spec: mart.MartSpec, measures: list[str], rates_wide: DataFrame,
                date_from: dt.date, date_to: dt.date, rejects_path: str | None = None,
                params: fx.FxParams = fx.FxParams(), connection_currency: str | None = None) -> LoadReport:
    """Load one set of landed records into an existing mart; a second run of the same lines changes nothing.

    Lines that do not parse or do not fit go to a folder of their own per load
    window, with raw text and file, and replace what an earlier run of the window wrote.
    """
    report = stage_landed(spark, records, spec, measures, rates_wide, date_from, date_to, params, connection_currency)
    if rejects_path:
        columns = [*_base_schema(spec).fieldNames(), "error", CHUNK_FROM, CHUNK_TO, "_raw", "_file"]
        bad = spark.read.parquet(report.stage).where("error IS NOT NULL").select(*columns)
        normalize.write_rejects(bad, f"{rejects_path}/{date_from}_{date_to}", mode="overwrite")
    done = mart.replace_range(spark, spec, None, date_from, date_to, params.chunk_days, CHUNK_FROM, CHUNK_TO, staged=report.stage)
    return replace(report, **done)
