"""Outlet geography: distance joins and cluster centroids (JOIN-8, AGG-4).

Distance joins meet through a grid. Latitudes form rows of equal height, and
every row has its own whole number of columns, as narrow as the distance
allows at the row's highest latitude, so columns wrap at the antimeridian and
rows near the poles have one column. All of it is arithmetic on the row's own
coordinates: nothing is computed over the data while the plan is built.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.geo import EARTH_RADIUS_KM, haversine_sql, km_per_degree_lat

RADIUS_KM = 5.0
# Rows are made 1% higher than the distance they must cover.
CELL_MARGIN = 1.01


def _row_sql(lat: str, row_deg: float) -> str:
    return f"CAST(floor({lat} / {row_deg!r}D) AS BIGINT)"


def _columns_sql(row: str, row_deg: float, km: float) -> str:
    """How many columns a row has: each at least ``km`` wide at the top of the row beyond it."""
    top = f"((greatest(abs({row}), abs({row} + 1)) + 1) * {row_deg!r}D)"
    half = math.sin(km / (2 * EARTH_RADIUS_KM))
    width = f"degrees(2 * asin(least(1.0D, {half!r}D / cos(radians({top})))))"
    return f"CASE WHEN {top} >= 89.0D THEN 1L ELSE greatest(1L, CAST(floor(360 / {width}) AS BIGINT)) END"


def _column_sql(lon: str, columns: str) -> str:
    return f"pmod(CAST(floor(({lon} + 180.0D) * {columns} / 360.0D) AS BIGINT), {columns})"


def stations_within(points: DataFrame, stations: DataFrame, radius_km: float = RADIUS_KM,
                    p_id: str = "org_id", s_id: str = "station_id") -> DataFrame:
    """JOIN-8: (point, station, distance_km) for stations within ``radius_km``.

    Stations are copied to the cells around their own in the three rows they
    can reach, points stay in their cell, so candidates meet through an
    equi-join on the cell and the exact haversine test runs only on them.
    """
    km = radius_km * CELL_MARGIN
    deg = km / km_per_degree_lat()
    p = points.selectExpr(p_id, "lat", "lon", f"{_row_sql('lat', deg)} AS _row") \
        .selectExpr("*", f"{_columns_sql('_row', deg, km)} AS _n").selectExpr("*", f"{_column_sql('lon', '_n')} AS _col").drop("_n")
    s = stations.selectExpr(s_id, "lat AS s_lat", "lon AS s_lon", f"explode(sequence({_row_sql('lat', deg)} - 1, {_row_sql('lat', deg)} + 1)) AS _row") \
        .selectExpr("*", f"{_columns_sql('_row', deg, km)} AS _n").selectExpr("*", f"{_column_sql('s_lon', '_n')} AS _own") \
        .selectExpr(s_id, "s_lat", "s_lon", "_row", "explode(array_distinct(array(pmod(_own - 1, _n), _own, pmod(_own + 1, _n)))) AS _col")
    d = haversine_sql("lat", "lon", "s_lat", "s_lon")
    return p.join(s, ["_row", "_col"]).selectExpr(p_id, s_id, f"{d} AS distance_km").where(f"distance_km <= {float(radius_km)!r}D")


def centroids(points: DataFrame, cluster_cols: list[str], order_col: str | None = None) -> DataFrame:
    """AGG-4: mean position per cluster, rounded to 6, its members and its first member's order."""
    first = [F.min(order_col).alias("first_seq")] if order_col else []
    return points.groupBy(*cluster_cols).agg(
        F.round(F.avg("lat"), 6).alias("c_lat"), F.round(F.avg("lon"), 6).alias("c_lon"),
        F.count(F.lit(1)).alias("members"), *first)
