"""From landed report rows to mart rows (OP-1..OP-8, SNK-4).

Renaming and projection act on the schema, so they cost nothing per row.
Coercion is driven by the mart schema: each column gets the built-in
expression for its type. Rows that cannot enter the mart are split off
with one predicate in the same pass; there is no row-by-row retry.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions import coerce as C
from salesmart.functions.names import normalise_name, normalise_name_col, with_scheme_col

# Fixed value: text written into empty text columns of the mart ("not set").
DEFAULT_TEXT = "не задана"
# Fixed value: stands between the names of a record while they are normalised together.
NAME_END = "\x01"
# error of a landed line that is not one JSON object
MALFORMED = "malformed record"


def normalise_columns(raw: DataFrame) -> DataFrame:
    """OP-1: rename ``.``/``-`` to ``_``; on a name collision the last column wins."""
    chosen: dict[str, str] = {}
    for name in raw.columns:
        chosen[normalise_name(name)] = name
    return raw.selectExpr(*[f"{C.quote(src)} AS {C.quote(dst)}" for dst, src in chosen.items()])


def dropped_fields(raw: DataFrame, schema: T.StructType, keep_prefix: str = "_") -> list[str]:
    """SET-3 / OP-2 report: source names whose normalised name has no mart column."""
    names = set(schema.fieldNames())
    return [c for c in raw.columns
            if not c.startswith(keep_prefix) and normalise_name(c) not in names]


def dropped_fields_of_records(records: DataFrame, map_col: str, schema: T.StructType) -> DataFrame:
    """OP-2 report over map-shaped records whose key sets vary by row.

    Distinct keys are found with a partial aggregate before the shuffle, so
    only (key, count) pairs per partition move; the mart column list is a
    tiny broadcast side of the anti-join.
    """
    spark = records.sparkSession
    mart = spark.createDataFrame([(c,) for c in schema.fieldNames()], "column_name string")
    keys = (records.select(F.explode(F.map_keys(F.col(map_col))).alias("field_name"))
            .groupBy("field_name").agg(F.count(F.lit(1)).alias("n_rows")))
    return keys.join(F.broadcast(mart), normalise_name_col(keys.field_name) == mart.column_name, "left_anti")


def project_to_schema(df: DataFrame, schema: T.StructType, source_url: Column | str | None = None,
                      keep: list[str] | None = None) -> DataFrame:
    """OP-2 + OP-3: keep mart columns present in the input, set ``url``.

    ``url`` is the configured address of the source (scheme defaulted to
    ``http://``) and overrides any ``url`` field of the input.
    """
    present = [f.name for f in schema.fields if f.name in df.columns and f.name != "url"]
    cols = [F.col(c) for c in present]
    if source_url is not None:
        url = F.lit(source_url) if isinstance(source_url, str) else source_url
        cols.append(with_scheme_col(url).alias("url"))
    for k in keep or []:
        cols.append(F.col(k))
    return df.select(*cols)


def project_records(records: DataFrame, schema: T.StructType, source_url: Column, known: list[str] | None = None,
                    record: str = "record", keep: list[str] | None = None) -> DataFrame:
    """OP-1 + OP-2 + OP-3 on records whose fields vary by row.

    Names are normalised once a row; where two names of a record come out the
    same, the last one wins. ``_unknown`` lists the source names that have no
    mart column and are not among ``known`` (landing metadata); ``keep`` passes columns through.
    """
    names = [f.name for f in schema.fields if f.name != "url"]
    expected = F.array(*[F.lit(n) for n in [*schema.fieldNames(), *(known or [])]])
    split = records.select(
        *[F.col(c) for c in keep or []], with_scheme_col(source_url).alias("url"),
        F.reverse(F.map_keys(record)).alias("_keys"), F.reverse(F.map_values(record)).alias("_values"))
    split = split.withColumn("_joined", F.split(F.replace(F.replace(F.array_join("_keys", NAME_END), F.lit("."), F.lit("_")), F.lit("-"), F.lit("_")), NAME_END))
    # all names of a record at once; one by one where a name holds the separator, and for a record without names
    split = split.withColumn("_names", F.when(F.size("_joined") == F.size("_keys"), F.col("_joined")).otherwise(F.transform("_keys", normalise_name_col)))
    split = split.withColumn("_new", F.array_except("_names", expected))
    new = F.array_distinct(F.reverse(F.filter("_keys", lambda k, i: F.array_contains("_new", F.get("_names", i)))))
    split = split.withColumn("_unknown", F.when(F.size("_new") > 0, new).otherwise(F.array().cast("array<string>")))
    found = [F.try_element_at("_values", F.nullif(F.array_position("_names", F.lit(n)).cast("int"), F.lit(0))).alias(n) for n in [*names, *(known or [])]]
    return split.select(*found, "url", "_unknown", F.col("_names").isNull().alias("_malformed"), *(keep or []))


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dtype, T.NumericType):
        return "number"
    return "string"


def coerce_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """OP-4..OP-7: typed values per mart column; failures become null."""
    types = {f.name: f.dataType for f in schema.fields}
    out = []
    for name in df.columns:
        if name in types and name != "url":
            dtype = types[name]
            kind = _kind(dtype)
            expr = C.coerce_sql(name, kind)
            if kind == "number":
                expr = f"CAST({expr} AS {dtype.simpleString()})"
            out.append(f"{expr} AS {C.quote(name)}")
        else:
            out.append(C.quote(name))
    return df.selectExpr(*out)


def string_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def fill_defaults(df: DataFrame, schema: T.StructType, value: str = DEFAULT_TEXT) -> DataFrame:
    """OP-8: every text column of the mart, null or absent -> ``value``."""
    strings = set(string_columns(schema))
    lit = "'" + value.replace("'", "''") + "'"
    out = [f"coalesce({C.quote(c)}, {lit}) AS {C.quote(c)}" if c in strings else C.quote(c) for c in df.columns]
    missing = [f"{lit} AS {C.quote(c)}" for c in string_columns(schema) if c not in df.columns]
    return df.selectExpr(*out, *missing)


def reject_reason(schema: T.StructType) -> Column:
    """Why a row cannot enter the mart: the first non-nullable column that is null."""
    reason = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        if not f.nullable:
            reason = F.when(F.col(f.name).isNull(), F.lit(f"null in non-nullable column {f.name}")).otherwise(reason)
    return reason


def split_rejects(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """SNK-4: (rows that fit, rejected rows with ``error``) from one tagged frame."""
    present = [f for f in schema.fields if f.name in df.columns]
    tagged = df.withColumn("error", reject_reason(T.StructType(present)))
    good = tagged.where(F.col("error").isNull()).drop("error")
    bad = tagged.where(F.col("error").isNotNull())
    return good, bad


def load_summary(staged: DataFrame, pairs: list[tuple[str, str]], source_col: str = "url", chunk_col: str = "_chunk_from") -> DataFrame:
    """AGG-8: per source and chunk, what became of the landed lines.

    ``staged`` holds every line of a load with its ``error`` and ``_unknown``
    names; ``pairs`` are measures and their converted copies. Lines that do not
    parse have no chunk. rows_in = inserted + rejected + malformed.
    """
    lost = [F.count_if(F.col(m).isNotNull() & F.col(converted).isNull()) for m, converted in pairs] or [F.lit(0)]
    return staged.groupBy(source_col, F.col(chunk_col).alias("chunk_from")).agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("error").isNull()).alias("inserted"),
        F.count_if(F.col("error") != MALFORMED).alias("rejected"), F.count_if(F.col("error") == MALFORMED).alias("malformed"),
        functools.reduce(operator.add, lost).alias("unconverted"), F.sum(F.size("_unknown")).alias("unknown_values"))


def unknown_fields(staged: DataFrame) -> DataFrame:
    """OP-2 report of a load: every field name without a mart column, with its number of records and sources."""
    return staged.select("url", F.explode("_unknown").alias("field_name")).groupBy("field_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("url").alias("n_sources"))


def write_rejects(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """SNK-4 sink: rejected record, error, chunk, raw text and file as JSON lines.

    ``record`` is null where the line did not parse; ``_raw`` and ``_file`` are taken over if they are there.
    """
    own = ("error", "_chunk_from", "_chunk_to", "_raw", "_file", "_unknown")
    record = F.to_json(F.struct(*[c for c in rejects.columns if c not in own]))
    origin = [F.col(c).alias(c[1:]) for c in ("_raw", "_file") if c in rejects.columns]
    out = rejects.select(
        F.when(F.col("error") != MALFORMED, record).alias("record"), "error",
        F.concat_ws(" – ", F.col("_chunk_from").cast("string"), F.col("_chunk_to").cast("string")).alias("chunk"), *origin)
    out.write.mode(mode).json(path, compression="gzip")


def landed_to_mart_rows(raw: DataFrame, schema: T.StructType, source_url: Column | str,
                        keep: list[str] | None = None) -> DataFrame:
    """OP-1 -> OP-2/3 -> OP-4..7 as one projection chain."""
    named = normalise_columns(raw)
    projected = project_to_schema(named, schema, source_url, keep)
    return coerce_to_schema(projected, schema)
