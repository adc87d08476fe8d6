"""A stored table that keeps the latest version of each key (SNK-5, DML-2), merged when it is read.

Every sync adds one folder of rows, dealt into buckets by key, and rewrites
nothing. Readers take the latest version of each key over a bucket's base and
the syncs since; buckets without later syncs are read as they are. Compaction
writes a new base for the buckets with enough syncs and leaves the others' files alone.

    <path>/sync/v=<n>/bucket=<b>/    rows of sync n, ``_gone`` marks deleted keys
    <path>/base/v=<n>/bucket=<b>/    what bucket b held after all syncs up to n

A folder counts once Spark's success marker is there, so a run that failed
leaves the table as it was. A later sync wins over an earlier one where the
given version columns tie, so every sync is safe to run again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators.latest import latest_by_key
from salesmart.operators.mart import _delete_path, _fs, _names

BUCKETS = 64


@dataclass(frozen=True)
class KeyedTable:
    path: str
    schema: T.StructType
    key: tuple[str, ...]
    version: tuple[str, ...] = ()  # columns that order the versions of a key, before the number of the sync
    buckets: int = BUCKETS

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType()), T.StructField("_sync", T.LongType())])


def _numbers(spark: SparkSession, table: KeyedTable, kind: str) -> list[int]:
    folder = f"{table.path}/{kind}"
    return sorted(int(n.removeprefix("v=")) for n in _names(spark, folder) if n.startswith("v=") and "_SUCCESS" in _names(spark, f"{folder}/{n}"))


def _folders(spark: SparkSession, table: KeyedTable, kind: str) -> dict[int, list[int]]:
    """Bucket -> versions of the complete folders that hold it. As many entries as there are bucket folders."""
    out: dict[int, list[int]] = {}
    for n in _numbers(spark, table, kind):
        for name in _names(spark, f"{table.path}/{kind}/v={n}"):
            if name.startswith("bucket="):
                out.setdefault(int(name.removeprefix("bucket=")), []).append(n)
    return out


def _live(spark: SparkSession, table: KeyedTable) -> dict[int, tuple[int, list[int]]]:
    """Bucket -> (version of its base or 0, syncs since)."""
    bases, syncs = _folders(spark, table, "base"), _folders(spark, table, "sync")
    return {b: (base := max(bases.get(b, [0])), [n for n in syncs.get(b, []) if n > base]) for b in sorted({*bases, *syncs})}


def _next(spark: SparkSession, table: KeyedTable) -> int:
    folders = [n for kind in ("base", "sync") for n in _names(spark, f"{table.path}/{kind}") if n.startswith("v=")]
    return max((int(n.removeprefix("v=")) for n in folders), default=0) + 1


def _bucket(table: KeyedTable):
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in table.key]), F.lit(table.buckets)).cast("int").alias("bucket")


def _write(rows: DataFrame, table: KeyedTable, kind: str, number: int) -> None:
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{table.path}/{kind}/v={number}")


def sync(spark: SparkSession, table: KeyedTable, rows: DataFrame, gone: DataFrame | None = None) -> int:
    """SNK-5: add the rows as the next sync, and mark the keys of ``gone`` as deleted; the sync's number."""
    number = _next(spark, table)
    new = rows.select(*table.schema.fieldNames(), F.lit(False).alias("_gone"))
    if gone is not None:
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields if f.name not in table.key]
        new = new.unionByName(gone.select(*table.key, *rest, F.lit(True).alias("_gone")))
    _write(new.select("*", F.lit(number).cast("long").alias("_sync"), _bucket(table)), table, "sync", number)
    return number


def _read(spark: SparkSession, table: KeyedTable, folders: list[tuple[str, int, int]]) -> DataFrame:
    paths = [f"{table.path}/{kind}/v={n}/bucket={b}" for kind, n, b in folders]
    stored = table.stored
    if not paths:
        return spark.createDataFrame([], T.StructType([*stored.fields, T.StructField("bucket", T.IntegerType())]))
    rows = spark.read.schema(T.StructType([*stored.fields, T.StructField("v", T.LongType()), T.StructField("bucket", T.IntegerType())]))
    parts = [rows.option("basePath", f"{table.path}/{kind}").parquet(*own) for kind in ("base", "sync")
             if (own := [p for p, f in zip(paths, folders, strict=True) if f[0] == kind])]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.drop("v")


def _merged(spark: SparkSession, table: KeyedTable, live: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """One row per key of the given buckets, deleted keys included."""
    folders = [("base", base, b) for b, (base, _) in live.items() if base] + [("sync", n, b) for b, (_, later) in live.items() for n in later]
    # the key decides the bucket, so carrying it in the key costs nothing
    return latest_by_key(_read(spark, table, folders), [*table.key, "bucket"], [*table.version, "_sync"])


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The latest version of every key that is not deleted."""
    live = _live(spark, table)
    settled = [("base", base, b) for b, (base, later) in live.items() if not later]
    open_buckets = {b: x for b, x in live.items() if x[1]}
    rows = _read(spark, table, settled)
    if open_buckets:
        rows = rows.unionByName(_merged(spark, table, open_buckets))
    return rows.where("NOT _gone").select(*table.schema.fieldNames())


def compact(spark: SparkSession, table: KeyedTable, min_syncs: int = 1) -> list[int]:
    """A new base for the buckets with at least ``min_syncs`` syncs since theirs; the buckets rewritten.

    Deleted keys stay in a base as marks while versions are ordered by columns
    (a late version of them must still lose); else they go.
    """
    due = {b: x for b, x in _live(spark, table).items() if len(x[1]) >= min_syncs}
    if due:
        rows = _merged(spark, table, due)
        _write(rows if table.version else rows.where("NOT _gone"), table, "base", _next(spark, table))
    return sorted(due)


def clean(spark: SparkSession, table: KeyedTable) -> int:
    """Delete the bucket folders that no reader takes any more; how many. Not beside running readers."""
    live = _live(spark, table)
    stale = [(kind, n, b) for kind in ("base", "sync") for b, versions in _folders(spark, table, kind).items() for n in versions
             if (n < live[b][0] if kind == "base" else n <= live[b][0])]
    for kind, n, b in stale:
        _delete_path(spark, f"{table.path}/{kind}/v={n}/bucket={b}")
    return len(stale)


def refresh(spark: SparkSession, table: KeyedTable, new: DataFrame, date_from: dt.date, date_to: dt.date,
            entity: str = "org_id", day: str = "date") -> int:
    """DML-2 + JOIN-10 on the stored table: entities with new rows in the range lose their stored rows of the
    range and get the new ones. What is written is the range alone: new rows, and marks for keys that are gone."""
    inside = new.where(F.col(day).between(F.lit(date_from), F.lit(date_to)))
    refreshed = inside.select(F.col(entity).alias("_entity")).distinct()
    stored = read(spark, table).where(F.col(day).between(F.lit(date_from), F.lit(date_to)))
    keys = list(table.key)
    gone = stored.join(refreshed, stored[entity] == refreshed["_entity"], "left_semi").select(*keys).join(inside.select(*keys).distinct(), keys, "left_anti")
    return sync(spark, table, inside, gone)
