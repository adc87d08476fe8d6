"""Places of rows within groups, and texts of ordered numbers, without a task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import partitions, written

_IN_TASK = (1 << 33) - 1


def dealt_by_range(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in ranges of ``keys`` (nulls first), sorted within each: a hot first key spreads over the later ones."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    return rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows with ``place`` (from 0, within the group by ``order``, nulls first) and ``size`` (of the group).

    Rows are dealt by range of (group, order), so a group that holds a third of
    all rows is many tasks. What they exchange is one row per task and group:
    how many of the group's rows the task holds. ``rows`` should be a stored
    table, since finding the ranges reads it once more.
    """
    sorted_rows = written(dealt_by_range(rows, [group, *order]).select(
        "*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)).alias("_line")), name)
    runs = sorted_rows.groupBy("_task", F.col(group).alias("_group")).agg(F.min("_line").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("_task").alias("_run_task"), "_group", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
                       F.sum("_rows").over(whole).alias("size"))
    same = (sorted_rows["_task"] == runs["_run_task"]) & sorted_rows[group].eqNullSafe(runs["_group"])
    return sorted_rows.join(runs, same).select(
        *rows.columns, (F.col("_line") - F.col("_first") + F.col("_before")).alias("place"), "size")
