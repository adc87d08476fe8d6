"""Outlet reference and daily weather (SRC-3, SRC-4, OP-9, OP-13, WIN-3,
SET-1, JOIN-7, JOIN-10, DML-2, AGG-11, SNK-5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.windows import split_at, weather_window

# Daily variables of the weather response -> weather table columns.
WEATHER_FIELDS = {
    "temperature_2m_mean": "temp_avg",
    "temperature_2m_min": "temp_min",
    "temperature_2m_max": "temp_max",
    "precipitation_sum": "precipitation_mm",
    "cloud_cover_mean": "cloud_cover_pct",
    "wind_speed_10m_max": "wind_speed_ms",
}

# Fixed value: currency of an outlet that reports none.
DEFAULT_OUTLET_CURRENCY = "RUB"


def _coord(name: str) -> str:
    # a missing or zero coordinate means "unknown"
    return f"CASE WHEN {name} IS NULL OR {name} = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST({name} AS DOUBLE) END"


def outlet_reference(orgs: DataFrame, api_key: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """OP-9 + OP-13: outlet records with the service's defaults applied.

    ``api_key`` names the column holding the connection's key; its first
    eight characters are kept as a hint. ``keep`` passes further columns through.
    """
    cols = [
        "id AS org_id",
        "trim(coalesce(name, '')) AS org_name",
        "coalesce(CAST(code AS STRING), '') AS org_code",
        "trim(coalesce(restaurantAddress, '')) AS address",
        "trim(coalesce(country, '')) AS country",
        f"{_coord('latitude')} AS lat",
        f"{_coord('longitude')} AS lon",
        "coalesce(CAST(inn AS STRING), '') AS inn",
        f"coalesce(nullif(currencyIsoName, ''), '{DEFAULT_OUTLET_CURRENCY}') AS currency",
        "coalesce(deliveryServiceType, '') AS delivery_type",
        "coalesce(CAST(version AS STRING), '') AS pos_version",
    ]
    if api_key is not None:
        cols.append(f"concat(substring(`{api_key}`, 1, 8), '...') AS api_key_hint")
    return orgs.selectExpr(*cols, *(keep or []))


def outlet_summary(ref: DataFrame, group_col: str) -> DataFrame:
    """AGG-9: outlets per group, those with both coordinates, distinct points."""
    return ref.groupBy(group_col).agg(
        F.expr("count(1)").alias("outlets"),
        F.expr("count_if(lat IS NOT NULL AND lon IS NOT NULL)").alias("with_coordinates"),
        F.expr("count(DISTINCT lat, lon)").alias("distinct_points"))


def explode_weather(responses: DataFrame, keys: list[str], daily_col: str = "daily") -> DataFrame:
    """SRC-4: parallel daily arrays -> one row per day.

    A response whose variable array is shorter than ``time`` (or absent
    while ``time`` has more than one day) is rejected whole; longer arrays
    are cut to ``time``. Arrays are positional, so rows come from a
    ``posexplode`` of ``time`` and ``element_at`` on the others.
    """
    d = daily_col
    ok = " AND ".join(
        f"(CASE WHEN {d}.{v} IS NULL THEN size({d}.time) <= 1 ELSE size({d}.{v}) >= size({d}.time) END)"
        for v in WEATHER_FIELDS)
    exploded = responses.where(ok).selectExpr(*keys, d, f"posexplode({d}.time) AS (_i, _day)")
    cols = ["to_date(_day) AS date"] + [
        f"CAST(CASE WHEN {d}.{v} IS NULL THEN NULL ELSE element_at({d}.{v}, _i + 1) END AS DOUBLE) AS {name}"
        for v, name in WEATHER_FIELDS.items()]
    return exploded.selectExpr(*keys, *cols)


def cluster_requests(clustered: DataFrame, group_col: str, label_col: str = "city_cluster") -> DataFrame:
    """AGG-11: one weather request per (group, cluster label).

    Clusters that share a label share the request of the cluster created
    first (smallest visit order of its first member), placed at that
    cluster's centroid; outlets keep their own cluster coordinates.
    """
    return clustered.groupBy(group_col, label_col).agg(
        F.expr("min_by(struct(lat, lon), first_seq)").alias("_p")) \
        .selectExpr(group_col, label_col, "_p.lat AS req_lat", "_p.lon AS req_lon")


def weather_for_outlets(weather: DataFrame, outlet_clusters: DataFrame, key: list[str]) -> DataFrame:
    """JOIN-7 + AGG-11: each weather row of a cluster key, for every outlet of it.

    Outlets keep their own name and coordinates; equal cluster keys share
    one weather series.
    """
    return weather.join(outlet_clusters, key)


def replace_weather(old: DataFrame, new: DataFrame, date_from: dt.date, date_to: dt.date,
                    org_col: str = "org_id") -> DataFrame:
    """DML-2 + JOIN-10: drop old rows of the outlets that got new data within
    the range, then add the new rows of the range. Outlets whose cluster
    returned no data keep their old rows. New rows outside the range are not
    taken, so a (date, outlet) has one row if it had one on each side."""
    in_range = F.col("date").between(F.lit(date_from), F.lit(date_to))
    new = new.where(in_range)
    refreshed = new.select(F.col(org_col).alias("_org")).distinct()
    survivors = old.join(refreshed, (old[org_col] == refreshed["_org"]) & in_range, "left_anti")
    return survivors.unionByName(new, allowMissingColumns=True)


def request_windows(clusters: DataFrame, as_of: dt.date, days_back: int = 30, days_ahead: int = 7) -> DataFrame:
    """WIN-3 + WIN-4: the weather requests of each cluster: history up to yesterday, forecast from today."""
    lo, hi = weather_window(as_of, days_back, days_ahead)
    parts = ", ".join(f"named_struct('part', '{p}', 'date_from', DATE'{a}', 'date_to', DATE'{b}')" for p, a, b in split_at(as_of, lo, hi))
    return clusters.selectExpr("*", f"inline(array({parts}))")
