"""Date windows (WIN-1..WIN-5).

Every window is computed from an explicit ``as_of`` date, never from the
clock, so a re-run of a job gives the same ranges.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# source address with the scheme defaulted to http:// (OP-3)
WITH_SCHEME_SQL = "CASE WHEN {0} RLIKE '^https?://' THEN {0} ELSE concat('http://', {0}) END"


def task_window(tasks: DataFrame, as_of: dt.date) -> DataFrame:
    """WIN-1: ``[as_of - days_offset_start, as_of - days_offset_end]`` per task."""
    return tasks.selectExpr("*", f"date_sub(DATE'{as_of}', days_offset_start) AS date_from",
                            f"date_sub(DATE'{as_of}', days_offset_end) AS date_to")


def chunks_of(date_from: Column, date_to: Column, chunk_days: int) -> Column:
    """WIN-2 per row: array of (chunk_from, chunk_to) structs, last one clipped."""
    if chunk_days < 1:
        raise ValueError("chunk_days must be at least 1")
    starts = F.sequence(date_from, date_to, F.expr(f"INTERVAL {chunk_days} DAYS"))
    return F.transform(starts, lambda s: F.struct(
        s.alias("chunk_from"), F.least(F.date_add(s, chunk_days - 1), date_to).alias("chunk_to")))


def explode_chunks(df: DataFrame, chunk_days: int, date_from: str = "date_from",
                   date_to: str = "date_to") -> DataFrame:
    """WIN-2: one row per chunk of each row's window (empty when from > to)."""
    arr = F.when(F.col(date_from) <= F.col(date_to), chunks_of(F.col(date_from), F.col(date_to), chunk_days))
    return df.select("*", F.inline_outer(F.coalesce(arr, F.array().cast("array<struct<chunk_from:date,chunk_to:date>>")))) \
        .where(F.col("chunk_from").isNotNull())


def split_at(as_of: dt.date, date_from: dt.date, date_to: dt.date) -> list[tuple[str, dt.date, dt.date]]:
    """WIN-3: history part up to yesterday, forecast part from today on."""
    parts = []
    yesterday = as_of - dt.timedelta(days=1)
    if date_from <= yesterday:
        parts.append(("history", date_from, min(date_to, yesterday)))
    if date_to >= as_of:
        parts.append(("forecast", max(date_from, as_of), date_to))
    return parts


def weather_window(as_of: dt.date, days_back: int = 30, days_ahead: int = 7) -> tuple[dt.date, dt.date]:
    """WIN-4: ``[as_of - back, as_of + ahead]``."""
    return as_of - dt.timedelta(days=days_back), as_of + dt.timedelta(days=days_ahead)


def task_configs(tasks: DataFrame, sources: DataFrame, targets: DataFrame, templates: DataFrame,
                 active_only: bool = True) -> DataFrame:
    """JOIN-6: task -> source, target, template by id; any miss -> no config."""
    t = tasks.where("is_active") if active_only else tasks
    s = sources.selectExpr("id AS _sid", f"{WITH_SCHEME_SQL.format('api_url')} AS source_url",
                           "currency AS source_currency")
    g = targets.selectExpr("id AS _gid")
    p = templates.selectExpr("id AS _pid", "name AS template_name")
    return (t.join(s, t.source_id == s._sid).join(g, t.target_id == g._gid).join(p, t.template_id == p._pid)
            .drop("_sid", "_gid", "_pid"))


def coverage(configs: DataFrame, as_of: dt.date) -> DataFrame:
    """WIN-5: (source_url, day, n_tasks) of every day that a task's window covers.

    An interval sweep: a window adds one where it begins and takes it away the
    day after it ends. These events are summed per source and day, so what is
    ordered afterwards is at most one row per source and calendar day, however
    many tasks there are; running sums give how many windows are open, and the
    stretches between events their days.
    """
    w = task_window(configs, as_of).where("date_from <= date_to")
    events = w.selectExpr("source_url", "inline(array(struct(date_from AS at, 1 AS step), struct(date_add(date_to, 1) AS at, -1 AS step)))")
    steps = events.groupBy("source_url", "at").agg(F.sum("step").alias("step"))
    open_windows = steps.selectExpr(
        "source_url", "at", "sum(step) OVER (PARTITION BY source_url ORDER BY at) AS n_tasks",
        "lead(at) OVER (PARTITION BY source_url ORDER BY at) AS until")
    return open_windows.where("n_tasks > 0").selectExpr(
        "source_url", "explode(sequence(at, date_sub(until, 1))) AS day", "n_tasks")


def rows_in_task_windows(configs: DataFrame, rows: DataFrame, as_of: dt.date, date_field: str, url_col: str = "url") -> DataFrame:
    """WIN-5: the rows that at least one task's window covers, each once, with ``n_tasks``, the number of windows.

    Rows meet the coverage table by (source, day), so a busy source is spread
    over its days and the result is never larger than the rows. The earliest
    and latest offset of all tasks (one small aggregate) bound the fact scan.
    """
    if url_col not in rows.columns or date_field not in rows.columns:
        raise ValueError(f"rows need the columns {url_col} and {date_field}")
    span = configs.where("days_offset_start >= days_offset_end").agg(F.max("days_offset_start"), F.min("days_offset_end")).first()
    if span[0] is None:
        return rows.where("false").withColumn("n_tasks", F.lit(None).cast("bigint"))
    lo, hi = (as_of - dt.timedelta(days=d) for d in span)
    covered = coverage(configs, as_of).selectExpr("source_url AS _source_url", "day AS _day", "n_tasks")
    inside = rows.where(F.col(date_field).between(F.lit(lo), F.lit(hi)))
    return inside.join(covered, (inside[url_col] == covered["_source_url"]) & (inside[date_field] == covered["_day"])).drop("_source_url", "_day")


def task_rows(configs: DataFrame, rows: DataFrame, as_of: dt.date, date_field: str, url_col: str = "url") -> DataFrame:
    """WIN-5: every active task with each row of its window, and ``n_tasks``, the number of tasks that get the row.

    The rows in no window go first. A window is laid out in its days, so tasks
    and rows meet by (source, day) in an ordinary join: what is held at a time
    is at most one source's day. The result is as large as all loads together.
    """
    inside = rows_in_task_windows(configs, rows, as_of, date_field, url_col)
    days = task_window(configs, as_of).where("date_from <= date_to").selectExpr(
        "id AS task_id", "source_url AS _source_url", "explode(sequence(date_from, date_to)) AS _day")
    joined = inside.join(days, (inside[url_col] == days["_source_url"]) & (inside[date_field] == days["_day"]))
    return joined.select("task_id", *inside.columns)
