"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan ``<data_dir>/<name>.parquet``; ``columns`` prunes the read schema."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df.repartition(_spread[name]) if name in _spread else df


# Tables whose scans are dealt over so many tasks; none unless asked for.
_spread: dict[str, int] = {}


def spread_scans(tasks: int, names: tuple[str, ...] = ("lineitem", "orders", "events")) -> None:
    """Deal the scans of the named tables round-robin over ``tasks`` tasks from now on.

    For files of one row group, which one task reads however large they are;
    0 turns it off. Never decided by size.
    """
    for name in names:
        _spread.pop(name, None)
        if tasks:
            _spread[name] = tasks
